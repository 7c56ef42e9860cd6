import duckdb

from furrow.plans import spatial_queries

D = "/root/testdata/sf0.1"  # in the smaller tables no box meets the raster


def test_every_pixel_of_the_box_counts(spark):
    boxes = "SELECT DISTINCT plant_id, bbox_x, bbox_y, bbox_width, bbox_height FROM plants_with_ids WHERE sector_label IS DISTINCT FROM 'NOISE' AND mask_file IS NOT NULL"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW plants_with_ids AS FROM '{D}/plants_with_ids.parquet'; CREATE VIEW raw_index_grid AS FROM '{D}/raw_index_grid.parquet'")
    every = spatial_queries.SQL["canopy_pixel_aggregate"]  # all pixels one by one
    want = con.execute(f"SELECT plant_id, value, soil_fraction, canopy_px FROM ({every})").fetchall()
    found = [tuple(r) for r in spatial_queries.canopy_pixel_aggregate(spark, D).collect()]
    assert sorted(found) == sorted(want, key=lambda r: r[0])
    assert sum(r[3] for r in want) > 0
    area = dict(con.execute(f"SELECT plant_id, sum(greatest(bbox_width, 1) * greatest(bbox_height, 1)) FROM ({boxes}) GROUP BY plant_id").fetchall())
    n = spatial_queries._canopy(spark, D).groupBy("plant_id").sum("n").collect()
    assert {r[0]: r[1] for r in n} == area
