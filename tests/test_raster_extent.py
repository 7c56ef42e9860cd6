from pyspark.sql import functions as F

from furrow.plans import spatial_queries

D = "/root/testdata/sf0.001"


def test_plants_outside_the_first_raster_are_kept(spark, tmp_path):
    moved = str(tmp_path)
    t = spark.read.parquet(f"{D}/pineapple_crops.parquet")
    t.withColumns({"geo_y": F.col("geo_y") + 4096, "geo_x": F.col("geo_x") + 8192}).write.parquet(f"{moved}/pineapple_crops.parquet")
    rows = lambda q, d: sorted(map(tuple, q(spark, d).collect()))
    was = rows(spatial_queries.window_neighbourhood, D)
    assert len(was) == spatial_queries.positions(spark, moved).count() > 0
    assert rows(spatial_queries.window_neighbourhood, moved) == was
    assert rows(spatial_queries.mask_resize, moved) == [(r - 2048, c + 4096) for r, c in rows(spatial_queries.mask_resize, D)]
