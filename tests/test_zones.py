from furrow.plans import spatial_queries

D = "/root/testdata/sf0.01"


def test_plants_of_every_zone_are_found(spark):
    zones = {r.zone_id for r in spark.read.parquet(f"{D}/boundary_zones.parquet").collect()}
    assert {r.zone_id for r in spatial_queries.point_in_polygon(spark, D).collect()} <= zones
    assert spatial_queries.point_in_polygon(spark, D).select("zone_id").distinct().count() > 2
    assert "IN (3, 7)" not in spatial_queries.SQL["point_in_polygon"]
