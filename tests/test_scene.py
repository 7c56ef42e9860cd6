from pyspark.sql import functions as F

from furrow.plans import spatial_queries

D = "/root/testdata/sf0.001"


def test_detections_below_the_first_scene_are_owned(spark, tmp_path):
    t = spark.read.parquet(f"{D}/detections.parquet")
    y, x = F.regexp_extract("image", r"tile_(\d+)_", 1).cast("int"), F.regexp_extract("image", r"_(\d+)\.png", 1).cast("int")
    t.withColumn("image", F.format_string("tile_%d_%d.png", y + 57600, x + 92160)).write.parquet(str(tmp_path / "detections.parquet"))
    centres = spatial_queries._centres(spark, str(tmp_path))
    assert spatial_queries.tile_ownership(spark, str(tmp_path)).count() == centres.count() > 0
    found = spatial_queries.tile_summary(spark, str(tmp_path)).agg(F.sum("detections")).first()[0]
    assert found == centres.where("confidence >= 0.25").count() > 0
