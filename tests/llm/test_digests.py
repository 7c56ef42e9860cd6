import numpy as np

from furrow.llm import digests
from furrow.llm.digests import build_digests, certified_quantiles, certify, merge_digests, quantiles, rank_bound

PROBS = [0.1, 0.5, 0.9]


def table(spark, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(1, int(d), float(v)) for d, v in zip(rng.integers(0, 5, 6000), rng.normal(size=6000))]  # a hot group
    rows += [(int(g), int(d), float(round(v, 1))) for g, d, v in zip(rng.integers(2, 60, 1500), rng.integers(0, 5, 1500), rng.normal(size=1500))]
    rows += [(None, 0, 1.0), (None, 1, 2.0), (2, 0, None), (2, 0, float("nan")), (2, 0, float("inf"))]
    return rows, spark.createDataFrame(rows, "g int, day int, v double").repartition(6)


def exact(rows):
    out = {}
    for g, _, v in rows:
        if v is not None and np.isfinite(v):
            out.setdefault(g, []).append(v)
    return out


def test_days_merge_to_one_digest_a_key(spark, monkeypatch):
    monkeypatch.setattr(digests, "BUFFER", 100)
    rows, df = table(spark)
    daily = merge_digests(build_digests(df, ["g", "day"], "v"), ["g", "day"])
    merged = merge_digests(daily, ["g"]).toPandas()
    for g, values in exact(rows).items():
        part = merged[merged["g"].isna() if g is None else merged["g"] == g]
        assert part["weight"].sum() == len(values)
        np.testing.assert_allclose((part["mean"] * part["weight"]).sum(), sum(values), atol=1e-6)
        assert len(part) <= 2 * 400  # not a part for every buffer of rows


def test_certified_estimates_keep_the_bound(spark):
    rows, df = table(spark)
    values = exact(rows)
    for delta in (400.0, 6.0):  # so coarse a digest that some keys must be counted exactly
        got = certified_quantiles(df, ["g"], "v", build_digests(df, ["g", "day"], "v", delta), PROBS, delta).collect()
        assert len(got) == len(values) * len(PROBS)
        for r in got:
            assert r.rank_error <= r.rank_bound and r.n == len(values[r.g])
            np.testing.assert_allclose(r.rank_bound, rank_bound(r.q, r.n, delta))
            if r.exact:
                np.testing.assert_allclose(r.estimate, np.quantile(values[r.g], r.q))


def test_exact_quantiles_have_no_error(spark):
    rows, df = table(spark)
    est = [(g, q, float(np.quantile(v, q))) for g, v in exact(rows).items() for q in PROBS]
    got = certify(df, ["g"], "v", spark.createDataFrame(est, "g int, q double, estimate double")).collect()
    assert len(got) == len(est) and all(r.rank_error == 0 for r in got)
    wrong = certify(df, ["g"], "v", spark.createDataFrame([(1, 0.5, 5.0)], "g int, q double, estimate double")).first()
    assert wrong.rank_error > 0.49


def test_nothing(spark):
    df = spark.createDataFrame([], "g int, day int, v double")
    assert quantiles(build_digests(df, ["g"], "v"), ["g"], PROBS).count() == 0
    assert certified_quantiles(df, ["g"], "v", build_digests(df, ["g"], "v"), PROBS).count() == 0
