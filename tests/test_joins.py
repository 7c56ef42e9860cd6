import numpy as np
import pytest

from furrow.functions.colours import NDRE, NDVI
from furrow.operators.joins import knn_join, nearest_within


@pytest.mark.parametrize("cell", [0.5, 50.0])
def test_neighbours_are_those_of_brute_force(spark, cell):
    rng = np.random.default_rng(1)
    at = np.r_[rng.normal(0, 2, (150, 2)), rng.normal(500, 1, (20, 2)), [[9000.0, -9000.0]], np.ones((12, 2))]
    rows = [(f"p{i:03d}", float(x), float(y), float(i)) for i, (x, y) in enumerate(at)]
    df = spark.createDataFrame([*rows, ("none", None, 1.0, 0.0), ("nan", float("nan"), 1.0, 0.0)], "id string, x double, y double, v double")
    got = {}
    for r in knn_join(df, df, 5, cell, value="v").collect():
        got.setdefault(r.id, {})[r["rank"]] = (r.other, r.v)
    assert len(got) == len(rows)
    for i, x, y, _ in rows:
        want = sorted((np.sqrt((x - a) * (x - a) + (y - b) * (y - b)), j, v) for j, a, b, v in rows if j != i)[:5]
        assert [got[i][k + 1] for k in range(5)] == [(j, v) for _, j, v in want]


def test_rounds_that_run_out_are_an_error(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("b", 1e6, 0.0), ("c", 2e6, 0.0)], "id string, x double, y double")
    with pytest.raises(RuntimeError):
        knn_join(df, df, 2, 1.0, most_rounds=1)


def test_nearest_within_radius_counts_the_edge(spark):
    a = spark.createDataFrame([("a", 0.0, 0.0), ("b", 5.0, 0.0)], "id string, x double, y double")
    b = spark.createDataFrame([("a", 0.0, 0.0), ("q", 0.5, 0.0), ("p", -0.5, 0.0)], "id string, x double, y double")
    assert [(r.id, r.other) for r in nearest_within(a, b, 0.5, exclude_self=True).collect()] == [("a", "p")]
    assert [(r.id, r.other) for r in nearest_within(a, b, 0.5).collect()] == [("a", "a")]


def test_palettes():
    assert (NDVI.rgb[0], NDVI.rgb[-1], NDVI.mid[0], NDVI.mid[-1]) == ((165, 0, 38), (0, 104, 55), -0.1, 0.95)
    assert (len(NDVI.rgb), len(NDRE.rgb), NDRE.mid[0], NDRE.mid[-1]) == (11, 10, -0.9, 0.9)
    assert NDVI.names[0] == "Bare soil (-0.2-0.0)"
