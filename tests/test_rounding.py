import hashlib
import random

import numpy as np

from furrow.functions.geo import geo_hash
from furrow.functions.rounding import half_even, nearest


def _values():
    rng = random.Random(5)
    return [rng.choice([-1, 1]) * round(rng.uniform(0, 10 ** rng.randint(-3, 6)), rng.randint(0, 7)) for _ in range(20_000)] + [0.5105, 0.5125, 2.675, 406510.02575, 0.0, 1e17]


def test_nearest_is_pythons_rule(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "v double")
    for digits in (0, 2, 3, 4, 6):
        assert all(r.r == round(r.v, digits) for r in df.select("v", nearest("v", digits).alias("r")).collect())


def test_half_even_is_numpys_rule(spark):
    rows = spark.createDataFrame([(v,) for v in _values()], "v double").select("v", half_even("v", 3).alias("r")).collect()
    np.testing.assert_array_equal([r.r for r in rows], np.round([r.v for r in rows], 3))


def test_missing_values_stay(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double")
    got = [r[0] for r in df.select(nearest("v", 3)).collect()]
    assert got[0] is None and got[1] != got[1] and got[2] == float("inf")


def test_geo_hash_of_positions(spark):
    rng = random.Random(6)
    at = [(round(rng.uniform(4e5, 4.1e5), 6), round(rng.uniform(1.1e6, 1.2e6), 5)) for _ in range(20_000)] + [(406510.02575, 1100100.5)]
    for r in spark.createDataFrame(at, "x double, y double").select("x", "y", geo_hash("x", "y").alias("h")).collect():
        assert r.h == hashlib.md5(f"{round(r.x, 4)},{round(r.y, 4)}".encode()).hexdigest()[:6].upper()
