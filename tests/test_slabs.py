import numpy as np
import pytest

from furrow.operators.slabs import containing_region, near_pairs


def brute(rows, radius, differ):
    ok = [r for r in rows if None not in r[:4] and all(np.isfinite(v) for v in r[1:4])]
    out = set()
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[0] != b[0] and np.hypot(a[1] - b[1], a[2] - b[2]) <= radius and abs(a[3] - b[3]) > differ:
                out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


# one slab; slabs; slabs cut into blocks; rows at one place, which no cut can part
@pytest.mark.parametrize("rows_per_slab,spot", [(20_000, 0), (50, 0), (10, 0), (10, 150)])
def test_pairs_are_those_of_brute_force(spark, rows_per_slab, spot):
    rng = np.random.default_rng(3)
    rows = [(f"p{i:04d}", float(x), float(y), float(v), 1) for i, (x, y, v) in enumerate(zip(rng.choice(np.arange(12), 400) + rng.normal(0, 0.05, 400), rng.normal(0, 3, 400), rng.uniform(0, 1, 400)))]
    rows += [(f"s{i:04d}", 5.0, 0.5, float(v), 1) for i, v in enumerate(rng.uniform(0, 1, spot))]
    rows += [(None, 0.0, 0.0, 0.1, 1), ("n1", None, 0.0, 0.1, 1), ("n2", 0.0, float("nan"), 0.1, 1), ("n3", 0.0, 0.0, None, 1), rows[0]]
    df = spark.createDataFrame(rows, "plant string, x double, y double, v double, slab int")
    got = [(r.a, r.b) for r in near_pairs(df, "plant", "x", "y", 0.2, "v", 0.3, rows_per_slab).collect()]
    want = brute(rows, 0.2, 0.3)
    assert set(got) == want and len(want) > 20
    assert near_pairs(df.limit(0), "plant", "x", "y", 0.2, "v", 0.3).count() == 0


def test_regions_by_broadcast_and_by_slab_agree(spark):
    rng = np.random.default_rng(4)
    zones = [(z, [[10.0 * z, 0.0], [10.0 * z + 8, 1.0], [10.0 * z + 9, 9.0], [10.0 * z + 1, 8.0]]) for z in range(9)] + [(9, None), (10, [[0.0, 0.0]])]
    zones = spark.createDataFrame(zones, "zone_id int, ring array<array<double>>")
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(-5, 100, 500), rng.uniform(-2, 12, 500)))] + [(600, None, 1.0), (601, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    found = [sorted((r.id, r.zone) for r in containing_region(df, "x", "y", zones, "zone_id", "ring", ["id"], most_edges=most).collect()) for most in (100_000, 5)]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert len({z for _, z in found[0]}) == 10 and dict(found[0])[600] is None
