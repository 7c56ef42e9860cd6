from datetime import datetime

from furrow.plans.crops import counting_rows


def test_the_latest_delivery_counts(spark):
    d = [datetime(2024, 1, i) for i in (1, 2, 3)]
    rows = [("a", d[0], 1, 1.0, "x"), ("a", d[2], None, 3.0, "z"), ("a", d[1], 2, 2.0, "y"), ("b", None, 5, None, "n"), ("b", d[0], 6, float("nan"), None), ("c", None, 7, 7.0, "c"), ("c", None, 7, 7.0, "c"), (None, d[0], 9, 9.0, "q")]
    df = spark.createDataFrame(rows, "plant_id string, created_at timestamp_ntz, n int, v double, t string")
    plain = {r.plant_id: (r.n, str(r.v)) for r in counting_rows(df, "n", "v").collect()}
    packed = {r.plant_id: (r.n, str(r.v), r.t) for r in counting_rows(df, "n", "v", "t").collect()}
    assert plain == {"a": (None, "3.0"), "b": (6, "nan"), "c": (7, "7.0")}
    assert packed == {"a": (None, "3.0", "z"), "b": (6, "nan", None), "c": (7, "7.0", "c")}
    assert counting_rows(df.limit(0), "n").count() == 0
