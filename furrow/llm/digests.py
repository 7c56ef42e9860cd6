"""Mergeable percentiles: centroid digests per group, merged by re-clustering, certified by counting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import stage

#: Rows a task holds before it compresses them.
BUFFER = 200_000


def compress(code: np.ndarray, mean: np.ndarray, weight: np.ndarray, delta: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-cluster centroids of many groups at once: (code, mean, weight), sorted by code and mean.

    Inside a group, sorted by mean, centroids whose mid-quantiles q share the integer part of
    delta / (2 pi) * asin(2q - 1) become one. So a cluster spans at most about
    2 pi * sqrt(q (1 - q)) / delta of the ranks: wide in the middle, single values at both ends.
    """
    order = np.lexsort((mean, code))
    code, mean, weight = code[order], mean[order], weight[order]
    if not len(code):
        return code, mean, weight
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    size = np.diff(np.r_[start, len(code)])
    total = np.repeat(np.add.reduceat(weight, start), size)
    run = np.cumsum(weight)
    q = (run - weight / 2 - np.repeat(run[start] - weight[start], size)) / total
    bin_ = np.floor(delta / (2 * np.pi) * np.arcsin(np.clip(2 * q - 1, -1, 1)))
    cut = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (bin_[1:] != bin_[:-1])])
    w = np.add.reduceat(weight, cut)
    return code[cut], np.add.reduceat(mean * weight, cut) / w, w


def rank_bound(q: float | np.ndarray, n: float | np.ndarray, delta: float) -> float | np.ndarray:
    """The stated error of an estimate of quantile q, as a share of n: the widest cluster around q, and one rank."""
    return 2 * np.pi * np.sqrt(q * (1 - q)) / delta + 1 / np.maximum(n, 1)


def _flush(pdf: pd.DataFrame, keys: list[str], delta: float) -> pd.DataFrame:
    groups = pdf.groupby(keys, dropna=False, sort=False)
    code = groups.ngroup().to_numpy()
    first = pdf.loc[~pd.Series(code).duplicated().to_numpy(), keys].reset_index(drop=True)
    c, m, w = compress(code, pdf["mean"].to_numpy(), pdf["weight"].to_numpy(), delta)
    return first.iloc[c].reset_index(drop=True).assign(mean=m, weight=w)


def _whole_keys(it, keys: list[str], rows: int = BUFFER):
    """Frames of whole keys from a stream ordered by its keys; only a key's own rows can make a frame larger than ``rows``."""
    parts, held = [], 0
    for pdf in it:
        if pdf.empty:
            continue
        parts.append(pdf)
        held += len(pdf)
        if held > rows:
            both = pd.concat(parts, ignore_index=True)
            k = both[keys]
            last = k.iloc[-1]
            same = np.logical_and.reduce([(k[c] == last[c]).to_numpy(dtype=bool, na_value=False) | (k[c].isna() & pd.isna(last[c])).to_numpy() for c in keys])
            if not same.all():
                yield both[~same]
            parts = [both[same]]
            held = len(parts[0])
    if held:
        yield pd.concat(parts, ignore_index=True)


def build_digests(df: DataFrame, keys: list[str], value: str, delta: float = 400.0) -> DataFrame:
    """(keys, mean, weight): centroids of ``value`` for each key, made in each task without a shuffle.

    Null, NaN and infinite values are left out; a null key is a key. A key's digest may come in
    several parts; they need not be merged to be stored. Keys named mean or weight are not allowed.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & (F.abs(v) < float("inf"))).select(*keys, v.alias("mean"), F.lit(1.0).alias("weight"))

    def f(it):
        parts, held = [], 0
        for pdf in it:
            parts.append(pdf)
            held += len(pdf)
            if held > 2 * BUFFER:
                parts = [_flush(pd.concat(parts, ignore_index=True), keys, delta)]
                held = len(parts[0])
                if held > BUFFER:  # many small groups: pass them on, they are merged after the shuffle
                    yield parts[0]
                    parts, held = [], 0
        if held:
            yield _flush(pd.concat(parts, ignore_index=True), keys, delta)

    return rows.mapInPandas(f, rows.schema)


def _met(digests: DataFrame, keys: list[str], delta: float, spread: int) -> DataFrame:
    """The parts of each key in order in one task: at most spread * delta centroids of it, as they first meet in ``spread`` tasks."""
    rows = digests.select(*keys, "mean", "weight")
    merged = lambda it: (_flush(p, keys, delta) for p in _whole_keys(it, keys))
    part = rows.withColumn("_s", F.pmod(F.xxhash64(*keys, "mean"), F.lit(spread))).repartition("_s", *keys).sortWithinPartitions(*keys).drop("_s")
    return part.mapInPandas(merged, rows.schema).repartition(*keys).sortWithinPartitions(*keys)


def merge_digests(digests: DataFrame, keys: list[str], delta: float = 400.0, spread: int = 16) -> DataFrame:
    """Merge digests of partitions, days or groups into one a key (a subset of the keys they were built with).

    Two steps: parts of a key first meet in ``spread`` tasks, then their merged centroids in one, at most
    spread * delta of them; a hot key's parts never meet in one task unmerged. Rows come ordered by key and are merged when a
    key is complete, so each key has one digest, however many keys a task holds.
    """
    met = _met(digests, keys, delta, spread)
    return met.mapInPandas(lambda it: (_flush(p, keys, delta) for p in _whole_keys(it, keys)), met.schema)


def quantiles(digests: DataFrame, keys: list[str], probs: list[float], delta: float = 400.0, spread: int = 16) -> DataFrame:
    """(keys, n, q, estimate, rank_bound): each key's estimates from its digests, which are merged first as merge_digests does.

    Estimates interpolate between the centroids' mid-ranks; where every centroid is one value this is the linear
    interpolation between order statistics. rank_bound is the error they are stated with; certify proves it.
    """

    def estimates(pdf: pd.DataFrame):
        pdf = _flush(pdf, keys, delta)
        code = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
        order = np.lexsort((pdf["mean"].to_numpy(), code))
        code, mean, weight = code[order], pdf["mean"].to_numpy()[order], pdf["weight"].to_numpy()[order]
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        size = np.diff(np.r_[start, len(code)])
        run = np.cumsum(weight)
        at = run - weight / 2 - np.repeat(run[start] - weight[start], size)  # mid-ranks, from 0 in each group
        n = np.add.reduceat(weight, start)
        apart = n.max() + 2  # one group's ranks after the other's on a single line
        line = code * apart + at
        first = pdf[keys].iloc[order[start]]
        for q in probs:
            want = q * (n - 1) + 0.5
            hi = np.clip(np.searchsorted(line, np.arange(len(n)) * apart + want, "right"), start, start + size - 1)
            lo = np.clip(hi - 1, start, None)
            gap = at[hi] - at[lo]
            share = np.clip(np.divide(want - at[lo], gap, out=np.zeros(len(n)), where=gap > 0), 0, 1)
            yield first.assign(n=n.astype("int64"), q=q, estimate=mean[lo] + share * (mean[hi] - mean[lo]), rank_bound=rank_bound(q, n, delta))

    met = _met(digests, keys, delta, spread)
    fields = ", ".join(f"`{x}` {met.schema[x].dataType.simpleString()}" for x in keys)
    return met.mapInPandas(lambda it: (e for p in _whole_keys(it, keys) for e in estimates(p)), f"{fields}, n long, q double, estimate double, rank_bound double")


def certify(df: DataFrame, keys: list[str], value: str, estimates: DataFrame, spread: int = 8) -> DataFrame:
    """Add rank_below, rank_upto and rank_error to the estimates (keys, q, estimate, ...) by counting all rows once more.

    rank_below and rank_upto are the exact numbers of the key's values less than, and at most, the
    estimate. The quantile q lies from order statistic k = floor(q (n - 1)) + 1 to the next, so rank_error, how far k lies outside
    [rank_below, rank_upto] as a share of n, is a proof, not an expectation, and 0 for the exact quantile.
    The rows and the estimates meet by key and a hash of ``spread`` values, so a hot key's rows
    are counted in as many tasks, and partial counts are combined before the shuffle. Other columns of the estimates are kept.
    """
    rest = [c for c in estimates.columns if c not in (*keys, "n")]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & (F.abs(v) < float("inf"))).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], v.alias("_v"))
    rows = rows.groupBy(*[f"_k{i}" for i in range(len(keys))], "_v").agg(F.count(F.lit(1)).alias("_c"))
    rows = rows.withColumn("_s", F.pmod(F.xxhash64("_v"), F.lit(spread)))
    wide = estimates.groupBy(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)]).agg(F.collect_list(F.struct(*rest)).alias("_e"))  # one entry a probability asked for
    wide = wide.withColumn("_t", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(spread)])))
    on = F.col("_s") == F.col("_t")
    for i in range(len(keys)):
        on = on & F.col(f"_k{i}").eqNullSafe(F.col(f"_w{i}"))
    met = rows.join(wide, on).select(*[F.col(f"_w{i}").alias(k) for i, k in enumerate(keys)], "_v", "_c", F.explode("_e").alias("_e"))
    c = F.col("_c")
    counts = met.groupBy(*keys, *[F.col(f"_e.{x}").alias(x) for x in rest]).agg(
        F.sum(c).alias("n"), F.sum(F.when(F.col("_v") < F.col("_e.estimate"), c).otherwise(0)).alias("rank_below"), F.sum(F.when(F.col("_v") <= F.col("_e.estimate"), c).otherwise(0)).alias("rank_upto")
    )
    k = F.floor(F.col("q") * (F.col("n") - 1)) + 1
    return counts.withColumn("rank_error", F.greatest(F.col("rank_below") - k, k - F.col("rank_upto"), F.lit(0)) / F.col("n"))


def certified_quantiles(df: DataFrame, keys: list[str], value: str, digests: DataFrame, probs: list[float], delta: float = 400.0) -> DataFrame:
    """(keys, q, n, estimate, rank_bound, rank_below, rank_upto, rank_error, exact): no estimate misses its bound.

    Estimates come from the digests and are certified over ``df``. Keys with an estimate that misses rank_bound get
    exact percentiles over the histogram of their values (exact: true), which are certified likewise.
    """
    made = stage(certify(df, keys, value, quantiles(digests, keys, probs, delta)), "certified")
    missed = made.where("rank_error > rank_bound").select(*keys).distinct()
    v = F.col(value).cast("double")
    hist = df.where(v.isNotNull() & (F.abs(v) < float("inf"))).select(*keys, v.alias("_v"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    hist = hist.alias("a").join(missed.alias("b"), same, "left_semi").groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    exact = hist.groupBy(*keys).agg(F.sum("_c").alias("n"), F.percentile("_v", probs, F.col("_c")).alias("_p"))
    entry = F.explode(F.arrays_zip(F.array(*map(F.lit, probs)).alias("q"), F.col("_p").alias("estimate"))).alias("_e")
    bound = F.lit(2 * np.pi / delta) * F.sqrt(F.col("q") * (1 - F.col("q"))) + 1 / F.col("n")
    exact = exact.select(*keys, "n", entry).select(*keys, "n", "_e.q", "_e.estimate").withColumn("rank_bound", bound)
    kept = made.alias("a").join(missed.alias("b"), same, "left_anti").withColumn("exact", F.lit(False))
    return kept.unionByName(certify(df, keys, value, exact).withColumn("exact", F.lit(True)))
