import time

import numpy as np
import pytest

from furrow.operators import sectors
from furrow.operators.near import kth_distance, reach_tree


def scenes():
    rng = np.random.default_rng(7)
    c, a = rng.uniform(0, 200, (6, 2)), rng.integers(0, 6, 500)
    yield "clusters", c[a, 0] + rng.normal(0, 1, 500) * (1 + a), c[a, 1] + rng.normal(0, 1, 500) * (1 + a)
    yield "lattice", *rng.integers(0, 15, (2, 400)).astype(float)
    yield "one place and a line", np.r_[np.zeros(150), rng.uniform(0, 1, 150)], np.r_[np.zeros(150), rng.uniform(0, 1e4, 150)]
    yield "two points", np.array([0.0, 3.0]), np.array([0.0, 4.0])


@pytest.mark.parametrize("name, x, y", list(scenes()))
@pytest.mark.parametrize("k", [1, 24])
def test_tree_weighs_as_much_as_that_of_all_pairs(name, x, y, k):
    k = min(k, len(x) - 1)
    d = np.sqrt((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2)
    core = np.partition(d, k, 1)[:, k]
    np.testing.assert_allclose(kth_distance(x, y, k), core, rtol=1e-12)
    m = np.maximum(d, np.maximum(core[:, None], core))
    best, inside, want = m[0].copy(), np.zeros(len(x), bool), []
    inside[0] = True
    for _ in range(len(x) - 1):
        best[inside] = np.inf
        j = int(best.argmin())
        want.append(best[j])
        inside[j] = True
        best = np.minimum(best, m[j])
    a, b, w = reach_tree(x, y, core)
    np.testing.assert_allclose(w, np.sort(want), rtol=1e-12)
    np.testing.assert_allclose(m[a, b], w, rtol=1e-12)


def test_density_of_many_points_is_quick():
    rng = np.random.default_rng(8)
    fields = rng.uniform(0, 3000, (60, 2))
    at = rng.integers(0, 60, 60_000)
    x, y = fields[at, 0] + rng.uniform(0, 20, 60_000), fields[at, 1] + rng.uniform(0, 20, 60_000)
    began = time.process_time()
    labels = sectors.hdbscan(x, y, 25)
    assert time.process_time() - began < 60  # all pairs took minutes
    assert (labels >= 0).mean() > 0.5


def test_nearest_distance_comes_with_the_sectors(spark):
    rng = np.random.default_rng(9)
    rows = [(f"p{i}", float(a), float(b), "one") for i, (a, b) in enumerate(rng.uniform(0, 20, (300, 2)))] + [("p0 again", 5.0, 5.0, "two")]
    df = spark.createDataFrame(rows, "id string, x double, y double, scene string")
    got = {r.id: r.nearest for r in sectors.density_sectors(df, "id", "x", "y", "scene", 10).collect()}
    assert got.pop("p0 again") is None
    want = sectors.spacing(df.where("scene = 'one'"), "id", "x", "y", 8, 2.0).first()["nearest"]
    assert abs(float(np.median([round(v, 6) for v in got.values()])) - want) < 1.1e-6
