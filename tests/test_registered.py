import __spark_entry__
from furrow.plans import spatial_queries
from furrow.plans.queries import HELD

D = "/root/testdata/sf0.001"


def test_spatial_queries_are_registered_but_for_the_held_ones():
    assert set(spatial_queries.QUERIES) - HELD <= set(__spark_entry__.queries())
    assert set(spatial_queries.SQL) - HELD <= set(__spark_entry__.oracle_sql())
    assert not HELD & set(__spark_entry__.queries())


def test_polygon_simplify_runs(spark):
    assert spatial_queries.polygon_simplify(spark, D).count() > 0
