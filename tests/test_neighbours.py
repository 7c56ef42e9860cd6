import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.functions.indices import average_rank_score
from furrow.operators import models
from furrow.operators.mixture import GaussianMixture, first_mixture, packed_blocks, together
from furrow.operators.neighbours import k_nearest, near_means
from furrow.plans.health import rank_health


def brute(rows, k, value):
    """id -> mean of the value over the k nearest others that have it, ties by id."""
    has = [r for r in rows if r[value] is not None]
    out = {}
    for r in has:
        near = sorted((np.sqrt((r[1] - o[1]) * (r[1] - o[1]) + (r[2] - o[2]) * (r[2] - o[2])), o[0], o[value]) for o in has if o[0] != r[0])[:k]
        out[r[0]] = sum(v for _, _, v in near) / len(near)
    return out


def field(n=700):
    rng = np.random.default_rng(5)
    at = np.r_[rng.uniform(0, 40, (n, 2)), np.round(rng.uniform(0, 12, (n, 2))), rng.normal(300, 30, (60, 2)), [[9000.0, -9000.0]], np.ones((40, 2))]
    v, e = rng.uniform(0, 1, (2, len(at)))
    return [(f"p{i:04d}", float(x), float(y), None if i % 11 == 3 else float(v[i]), None if i % 7 == 2 or x > 250 and i % 3 else float(e[i])) for i, (x, y) in enumerate(at)]


@pytest.mark.parametrize("size", [60, 20_000])
def test_means_over_blocks_are_those_of_brute_force(spark, size):
    rows = field()
    extra = [("none", None, 1.0, 0.5, 0.5), ("blank", 1.0, 1.0, None, None)]
    df = spark.createDataFrame([*rows, *extra], "id string, x double, y double, v double, e double")
    got = {r.id: r for r in near_means(df, "id", "x", "y", ["v", "e"], 8, 2.0, size).collect()}
    assert len(got) == len(rows) + 2 and got["none"].v_near is None and got["blank"].v_near is None
    for c, i in (("v", 3), ("e", 4)):
        want = brute(rows, 8, i)
        assert {k for k, r in got.items() if r[f"{c}_near"] is not None} == set(want)
        for k, m in want.items():
            assert abs(got[k][f"{c}_near"] - m) < 1e-12


@pytest.mark.parametrize("rows", [[(f"p{i}", float(i % 3), 0.0, float(i), float(i)) for i in range(900)], [("a", 0.0, 0.0, 1.0, None), ("b", 5.0, 0.0, 2.0, 7.0)]])
def test_crowded_places_and_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "id string, x double, y double, v double, e double")
    got = {r.id: r.v_near for r in near_means(df, "id", "x", "y", ["v", "e"], 8, 2.0, 100).collect()}
    want = brute(rows, 8, 3)
    assert got.keys() == want.keys() and all(abs(got[k] - m) < 1e-12 for k, m in want.items())


def test_nearest_of_many_copies():
    x = np.r_[np.zeros(400), np.arange(1, 301)]
    d, at = k_nearest(x, np.zeros(700), 3)
    assert at[0].tolist() == [1, 2, 3] and at[399].tolist() == [0, 1, 2] and at[400].tolist() == [0, 1, 2] and at[500].tolist() == [499, 501, 498]
    assert d[400].tolist() == [1.0, 1.0, 1.0]


def test_ranks_average_ties_and_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 50.0), ("e", None), ("f", None)], "id string, v double")
    got = {r.id: r.s for r in average_rank_score(df, "v", "s").collect()}
    assert got == {"a": 25.0, "b": 62.5, "c": 62.5, "d": 100.0, "e": None, "f": None}
    keyed = df.withColumn("k", F.when(F.col("id") > "b", "x"))
    got = {r.id: r.s for r in average_rank_score(keyed, "v", "s", ["k"]).collect()}
    assert got == {"a": 50.0, "b": 100.0, "c": 50.0, "d": 100.0, "e": None, "f": None}


def test_forest_tables_give_the_walked_depths():
    rng = np.random.default_rng(6)
    forest = models.grow_forest(rng.normal(0, 1, (3000, 2)), 40)
    x = np.r_[rng.normal(0, 2, (500, 2)), np.stack([forest.cut[0, :50], forest.cut[1, :50]], 1)]
    np.testing.assert_array_equal(forest._looked_up(x), forest._walked(x))


def test_mixture_finds_its_parts(spark):
    rng = np.random.default_rng(7)
    x = np.r_[rng.normal((-3, 0), 0.5, (3000, 2)), rng.normal((3, 1), (1.0, 0.2), (1000, 2))]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(5)
    blocks = packed_blocks(df, ["a", "b"], np.zeros(2), np.ones(2))
    m, same = together([GaussianMixture(first_mixture(x[[0, 1, 2, -1, -2, -3]], 2), 60).fit(blocks) for _ in range(2)])
    np.testing.assert_array_equal(m.mean, same.mean)
    np.testing.assert_allclose(m.weight, [0.75, 0.25], atol=0.01)
    np.testing.assert_allclose(m.mean, [[-3, 0], [3, 1]], atol=0.1)
    np.testing.assert_allclose(np.sqrt(m.cov[1][[0, 1], [0, 1]]), [1.0, 0.2], atol=0.05)


def test_rank_health_sorts_no_row_by_neighbour_pairs(spark):
    """neighbours were pairs of a self-join, and the models' rows were joined back one by one."""
    rows = [(i, "S01", x, y, v, e) for i, x, y, v, e in field()]
    made = rank_health(spark.createDataFrame(rows, "plant_id string, sector_label string, x double, y double, ndvi double, ndre double"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "plant_id" not in "".join(x for x in plan.split("\n") if "Join" in x)
    got = {r.plant_id: r for r in made.collect()}
    want = brute(rows_of(rows), 8, 3)
    assert all(abs(got[k].ndvi_smooth - (0.7 * got[k].ndvi + 0.3 * m)) < 6e-4 for k, m in want.items())


def rows_of(rows):
    return [(i, x, y, v, e) for i, _, x, y, v, e in rows]
