import numpy as np
from pyspark.sql import functions as F

from furrow.operators import models
from furrow.operators.boosting import fit_boosting
from furrow.operators.sectors import hdbscan


def test_boosted_trees_learn_and_are_the_same_each_time():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (2000, 4))
    y = np.where(x[:, 0] > 0.2, 2.0, -1.0) + x[:, 1] ** 2
    m = fit_boosting(x[:1500], y[:1500], trees=150)
    error = ((m.predict(x[1500:]) - y[1500:]) ** 2).mean()
    assert error < 0.05 * y.var()
    np.testing.assert_array_equal(m.predict(x), fit_boosting(x[:1500], y[:1500], trees=150).predict(x))
    flat = fit_boosting(np.ones((10, 2)), np.full(10, 3.0), trees=5)
    np.testing.assert_allclose(flat.predict(np.zeros((3, 2))), 3.0)


def test_gaps_are_filled_and_measured_rows_kept(spark):
    rng = np.random.default_rng(2)
    xy = rng.uniform(0, 40, (400, 2))
    rows = [(i, float(a), float(b), None if i % 10 == 0 else float(0.01 * a), None if i % 20 == 0 else float(0.02 * b), "NOISE" if i % 25 == 0 else "S01", None if i % 30 == 0 else "m.png") for i, (a, b) in enumerate(xy)]
    df = spark.createDataFrame(rows, "id int, x double, y double, ndvi double, ndre double, label string, mask string")
    made, r2 = models.impute_by_boosting(df, "id", "x", "y", ["ndvi", "ndre"], ["x", "y"], 2.0, "label", "mask", trees=60)
    got = {r.id: r for r in made.collect()}
    assert len(got) == 400 and min(r2.values()) > 0.5
    for i, a, b, v, e, label, mask in rows:
        r = got[i]
        if label != "NOISE" and v is None and mask is not None:
            assert r.source == "predicted" and abs(r.ndvi - 0.01 * a) < 0.1 and abs(r.ndre - 0.02 * b) < 0.2
        else:
            assert (r.ndvi, r.ndre) == (v, e) and r.source == ("measured" if label != "NOISE" and v is not None and e is not None else None)
    few, none = models.impute_by_boosting(df.where("id < 50"), "id", "x", "y", ["ndvi", "ndre"], ["x"], 2.0, "label", "mask")
    assert none == {} and few.where("source = 'predicted'").count() == 0


def test_isolation_forests_by_cohort(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], float(v), float(w)) for i, (v, w) in enumerate(rng.normal(0, 1, (600, 2)))]
    rows += [(1000, "a", 12.0, 12.0), (1001, "b", -12.0, 12.0), (1002, "few", 0.0, 0.0), (1003, "a", None, float("nan"))]
    s = models.isolation_scores(spark.createDataFrame(rows, "id int, c string, v double, w double"), "id", ["v", "w"], "c", trees=50)
    got = {r.id: r for r in models.outliers(s, 0.02, by_cohort=True).collect()}
    assert len(got) == len(rows) and got[1000].outlier and got[1001].outlier
    assert got[1002].score is None and not got[1002].outlier and got[1003].score is not None


def test_stage_forest_is_saved_and_loaded(spark, tmp_path):
    df = spark.range(300).select(F.col("id"), (F.col("id") / 1000).alias("area"), F.when(F.col("id") < 150, "Seedling").otherwise("Mature").alias("label"))
    model = models.train_stage_forest(df, ["area"], "label", trees=5, depth=3)
    models.save_stage_model(model, str(tmp_path / "m"), ["area"], (0.01, 0.02))
    again, features, gsd = models.load_stage_model(str(tmp_path / "m"))
    assert features == ["area"] and gsd == (0.01, 0.02)
    a, b = ([r.predicted_stage for r in models.predict_stage(m, df, features).orderBy("id").collect()] for m in (model, again))
    assert a == b and a[0] == "Seedling" and a[-1] == "Mature"


def test_density_finds_two_fields_and_noise():
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(0, 1, 60), rng.normal(30, 1, 60), [15.0, 200.0]]
    y = np.r_[rng.normal(0, 1, 60), rng.normal(0, 1, 60), [40.0, 0.0]]
    lab = hdbscan(x, y, 10)
    assert len(set(lab[:60]) - {-1}) == 1 and len(set(lab[60:120]) - {-1}) == 1 and lab[:60].max() != lab[60:120].max()
    assert (lab[:60] >= 0).mean() > 0.8 and (lab[120:] == -1).all()
    assert (hdbscan(x[:5], y[:5], 10) == -1).all()
