import numpy as np

from furrow.operators.slabs import RegionSlabs


def test_smallest_region_where_regions_cross():
    rings = {1: [(0, 0), (10, 8), (10, 10), (0, 2)], 2: [(0, 8), (10, 0), (10, 2), (0, 10)], 3: [(0, 4), (10, 3), (10, 6), (0, 7)]}
    edges = np.array([(z, *p, *q) for z, r in rings.items() for p, q in zip(r, r[1:] + r[:1])], dtype=float)
    x, y = np.random.default_rng(1).uniform(0.01, 9.99, (2, 5000))
    want = np.full(len(x), np.nan)
    for z in sorted(rings, reverse=True):
        e = edges[edges[:, 0] == z]
        with np.errstate(divide="ignore", invalid="ignore"):
            at = e[:, 1] + (e[:, 3] - e[:, 1]) * (y[:, None] - e[:, 2]) / (e[:, 4] - e[:, 2])
        hit = ((e[:, 2] > y[:, None]) != (e[:, 4] > y[:, None])) & (x[:, None] < at)
        want[hit.sum(1) % 2 == 1] = z
    np.testing.assert_array_equal(RegionSlabs(edges).locate(x, y), want)
