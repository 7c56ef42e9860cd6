"""Top N within every group: sorted runs, bucketed by group, merged by a loser tree that skips to the next group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import stage


class LoserTree:
    """A tournament over runs: ``winner`` is the run whose key is smallest, ``replay`` puts in its next key.

    Inner node i holds the run that lost there; a replay climbs from the winner's leaf to the root,
    log2(runs) comparisons. An exhausted run has the key None and loses to all.
    """

    def __init__(self, keys: list):
        self.keys, n = list(keys), max(1, len(keys))
        self.size = 1 << (n - 1).bit_length()
        self.keys += [None] * (self.size - len(self.keys))
        self.losers = [0] * self.size
        won = [0] * self.size + list(range(self.size))
        for at in range(self.size - 1, 0, -1):
            a, b = won[2 * at], won[2 * at + 1]
            won[at], self.losers[at] = (a, b) if self.before(a, b) else (b, a)
        self.winner = won[1]

    def before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and x <= y)

    def replay(self, key) -> None:
        run = self.winner
        self.keys[run] = key
        at = (run + self.size) // 2
        while at:
            if not self.before(run, self.losers[at]):
                run, self.losers[at] = self.losers[at], run
            at //= 2
        self.winner = run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], n: int) -> list[tuple[int, int]]:
    """(run, row) of the first n rows of each group, in order.

    A run is four arrays (hash of the group, group, score, id) sorted by hash, group, score descending, id. After n outputs of a group
    every run seeks, by binary search, to the first row of a later group. A row equal to the one before it is its repeat and skipped.
    """
    at, size = [0] * len(runs), [len(r[0]) for r in runs]
    key = lambda r: (runs[r][0][at[r]], runs[r][1][at[r]], -runs[r][2][at[r]], runs[r][3][at[r]]) if at[r] < size[r] else None
    tree, out = LoserTree([key(r) for r in range(len(runs))]), []
    group, taken, last = None, 0, None
    while runs and (k := tree.keys[tree.winner]) is not None:
        r = tree.winner
        if k[:2] != group:
            group, taken = k[:2], 0
        if taken < n:
            if k != last:
                out.append((r, at[r]))
                taken, last = taken + 1, k
            at[r] += 1
        else:
            at[r] = seek(runs[r], at[r], group)
        tree.replay(key(r))
    return out


def seek(run: tuple, at: int, group: tuple) -> int:
    """The first row from ``at`` on of a group behind this one: the end of its hash, or inside it of its name where two groups share one."""
    end = at + int(np.searchsorted(run[0][at:], group[0], "right"))
    return at + int(np.searchsorted(run[1][at:end], group[1], "right"))


#: Hashes of groups have as many bits; a bucket is a range of them.
BITS = 31


def top_n(df: DataFrame, group: str, score: str, id_col: str, n: int, bucket_rows: int = 100_000, fan_in: int = 256) -> DataFrame:
    """(group, id, score, rank): the n rows of each group with the highest score, equal scores by id ascending.

    Each task sorts its rows by (hash of the group, group, score, id): a run. It stores the first n of each group,
    streaming, so a group of any size leaves n rows a run. The stored runs are counted, and cut into as many buckets (ranges of the
    hash) as keep a bucket near ``bucket_rows``. A bucket's runs come to one task in order and are merged by a loser tree, ``fan_in``
    runs at a time: with more runs there are more passes, each of which leaves n rows a group and merged run, so no task holds
    more than about bucket_rows, or fan_in * n rows of one group.

    Groups are integers, texts or dates. Rows with a null group, score or id, or a NaN score, are left out; fewer than n rows: all; rows equal
    in group, score and id count once if they are repeats. ids compare as plain text by character code,
    which is Spark's order of strings. n at most 0: no rows.
    """
    kind = df.schema[group].dataType.simpleString()
    if n <= 0:
        return df.select(F.col(group), F.col(id_col).cast("string").alias(id_col), F.col(score).cast("double").alias(score), F.lit(0).alias("rank")).limit(0)
    rows = df.select(F.col(group).alias("g"), F.col(score).cast("double").alias("s"), F.col(id_col).cast("string").alias("i"))
    rows = rows.where("g IS NOT NULL AND s IS NOT NULL AND NOT isnan(s) AND i IS NOT NULL")
    rows = rows.select(F.spark_partition_id().alias("run"), F.pmod(F.xxhash64("g"), F.lit(1 << BITS)).alias("h"), "g", "s", "i")
    order = ["h", "g", F.desc("s"), "i"]

    def head(it):
        last, count, previous = None, 0, None
        for pdf in it:
            if pdf.empty:
                continue
            g = pdf["g"].to_numpy()
            repeat = ((pdf["g"] == pdf["g"].shift()) & (pdf["s"] == pdf["s"].shift()) & (pdf["i"] == pdf["i"].shift())).to_numpy()
            repeat[0] = previous == (g[0], pdf["s"].iloc[0], pdf["i"].iloc[0])
            previous = (g[-1], pdf["s"].iloc[-1], pdf["i"].iloc[-1])
            new = np.r_[g[0] != last, g[1:] != g[:-1]]
            fresh = np.cumsum(~repeat)
            base = np.maximum.accumulate(np.where(new, fresh - ~repeat, 0))
            place = fresh - np.where(np.cumsum(new) == 0, -count, base)
            yield pdf[(place <= n) & ~repeat]
            last, count = g[-1], int(place[-1])

    runs = stage(rows.sortWithinPartitions(*order).mapInPandas(head, rows.schema), "runs")
    ends = runs.agg(F.count(F.lit(1)).alias("n"), F.max("run").alias("m")).first()
    many = max(1, (ends["m"] or 0) + 1)
    while True:
        buckets = 1 << min(BITS, max(0, int(np.ceil(np.log2(max(1, ends["n"] / bucket_rows))))))
        groups = -(-many // fan_in)
        dealt = runs.withColumn("b", (F.shiftright("h", BITS - int(np.log2(buckets)))).cast("int")).withColumn("f", F.floor(F.col("run") / fan_in).cast("int"))
        merged = dealt.repartition(min(4096, buckets * groups), "b", "f").sortWithinPartitions("b", "f", "run", *order)
        merged = merged.mapInPandas(_merging(n), f"run int, h long, g {kind}, s double, i string, rank int")
        if groups == 1:
            return merged.select(F.col("g").alias(group), F.col("i").alias(id_col), F.col("s").alias(score), "rank")
        runs, many = stage(merged.drop("rank"), "merged-runs"), groups
        ends = runs.agg(F.count(F.lit(1)).alias("n")).first()


def _merging(n: int):
    """For mapInPandas over rows ordered by (b, f, run, ...): each (b, f) is merged as soon as it is complete; its run is f."""

    def merge(parts: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        cut = np.flatnonzero(np.r_[True, pdf["run"].to_numpy()[1:] != pdf["run"].to_numpy()[:-1]])
        columns = [pdf[c].to_numpy() for c in ("h", "g", "s", "i")]
        ends = np.r_[cut[1:], len(pdf)]
        took = merge_runs([tuple(c[a:b] for c in columns) for a, b in zip(cut, ends)], n)
        out = pdf.iloc[[cut[r] + i for r, i in took]]
        return out.assign(run=out["f"], rank=out.groupby(["h", "g"], sort=False).cumcount().astype("int32") + 1)[["run", "h", "g", "s", "i", "rank"]]

    def f(it):
        held: list[pd.DataFrame] = []
        for pdf in it:
            if pdf.empty:
                continue
            at = pdf["b"].to_numpy().astype(np.int64) << 32 | pdf["f"].to_numpy().astype(np.int64)
            cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            for a, b in zip(cut, np.r_[cut[1:], len(pdf)]):
                part = pdf.iloc[a:b]
                if held and (held[0]["b"].iloc[0], held[0]["f"].iloc[0]) != (part["b"].iloc[0], part["f"].iloc[0]):
                    yield merge(held)
                    held = []
                held.append(part)
        if held:
            yield merge(held)

    return f
