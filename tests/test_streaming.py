from datetime import datetime, timedelta

from pyspark.sql import functions as F

from furrow.streaming.ingest import append_to, arrivals, windowed_counts, without_repeats

SCHEMA = "plant_id string, sector string, created_at timestamp"


def test_repeats_are_dropped_and_windows_counted(spark, tmp_path):
    t = datetime(2024, 1, 1, 12)
    first = [("a", "S1", t), ("b", "S1", t), ("a", "S1", t), ("c", "S2", t + timedelta(days=1))]
    second = [("a", "S1", t + timedelta(hours=1)), ("d", "S2", t + timedelta(days=9)), ("e", "S2", t + timedelta(days=9))]
    path = str(tmp_path / "in")
    for rows in (first, second):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = arrivals(spark, path, SCHEMA, 1)
    append_to(without_repeats(stream, ["plant_id"], "created_at"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    got = [r.plant_id for r in spark.read.parquet(str(tmp_path / "out")).orderBy("plant_id").collect()]
    assert got == ["a", "b", "c", "d", "e"]
    # a restart goes on where it stopped
    append_to(without_repeats(stream, ["plant_id"], "created_at"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    append_to(windowed_counts(stream, "created_at", "sector"), str(tmp_path / "n"), str(tmp_path / "c2")).awaitTermination()
    n = {(r.sector, r.n) for r in spark.read.parquet(str(tmp_path / "n")).where(F.col("start") < "2024-01-03").collect()}
    assert ("S2", 1) in n and {s for s, _ in n} == {"S1", "S2"}
