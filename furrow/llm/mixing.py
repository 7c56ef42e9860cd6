"""Mixing sources to target weights: blocks of fixed length, multinomial counts per shard, permuted block indexes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.clusters import mix64
from furrow.session import running_total, stage


def permute(index: np.ndarray, n: int, key: int | np.ndarray, least: int | np.ndarray | None = None) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at ``index``: four Feistel rounds, repeated while outside.

    ``key`` may differ from entry to entry, and ``least`` may give each entry a smaller n of its own.
    """
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.broadcast_to(np.asarray(key, dtype=np.int64), index.shape)
    limit = np.broadcast_to(np.asarray(n if least is None else least, dtype=np.int64), index.shape).astype(np.uint64)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            left, right = right, left ^ (mix64(right ^ mix64(keys[todo] * 4 + r)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


def refilled(used: np.ndarray, room: np.ndarray, share: np.ndarray, slots: int) -> np.ndarray:
    """Whole numbers of further slots a source, no more than its room, that fill ``slots`` as far as all rooms together allow.

    Sources are raised to a common multiple of their share, so those with room stay in proportion to each other; what is left over when
    no source with a share has room goes to nobody.
    """
    most = used + np.where(share > 0, room, 0)
    want = min(used.sum() + slots, most.sum())
    low, high = 0.0, float(2 * want + 1) / max(share[share > 0].min(), 1e-12) if (share > 0).any() else 0.0
    level = lambda z: np.clip(z * share, used, most)
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if level(mid).sum() < want else (low, mid)
    exact = level(low)
    out = np.floor(exact).astype(np.int64)
    for i in np.argsort(out - exact, kind="stable"):
        if out.sum() >= want:
            break
        out[i] += out[i] < most[i]
    for i in range(len(out)):
        out[i] += min(most[i] - out[i], max(0, want - out.sum()))
    return np.maximum(out - used, 0)


@dataclass(frozen=True)
class Mix:
    """slots (shard, slot, source, epoch, block, refill) and their spans; report: one row a source."""

    slots: DataFrame
    spans: DataFrame
    report: DataFrame


def mix(docs: DataFrame, id_col: str, source_col: str, size_col: str, targets: DataFrame, block_tokens: int = 2048, shard_slots: int = 1024, seed: int = 11, rows_per_chunk: int = 200_000, most_sources: int = 10_000) -> Mix:
    """Combine records so that each source has its share of the total size.

    A source's records, in an order given by a hash of the id, form one stream of tokens that is cut into blocks
    of ``block_tokens``. The total is the sum of the supply of all targeted sources. Each shard of
    ``shard_slots`` slots draws a multinomial count for each source; the source's n-th draw takes
    block permutation(n mod blocks) in epoch n div blocks, each epoch with its own permutation. A source can fill
    blocks * max_repeats slots. Slots drawn beyond that are numbered, permuted, and given to the sources that have room, in
    proportion to their shares (refill), so the mix has its full size wherever all sources together
    allow it. Slots and blocks are joined by (source, block), where a block occurs at most max_repeats times, so no key is hot.

    spans (shard, slot, source, epoch, block, refill, id, start, tokens) name the records' parts, in tokens.
    report has supply_tokens (of the blocks cut), wanted_tokens (share * total), cap_tokens (supply * max_repeats), short,
    drawn_share (of the total, before refilling), drawn_tokens, reachable_share (what the caps allow) and actual_share (both of the tokens
    in the mix). short: the source drew more slots than it can fill, or as many but for six standard deviations of the draw,
    and the exact count of its blocks' tokens confirms cap < wanted.

    Sources compare after trimming and ignoring case; a null or untargeted source, a null id and a null or
    non-positive size add nothing; repeated ids are records of their own. A targeted source without
    records has supply 0. ``targets`` (source, target_share, max_repeats) is small: more than
    ``most_sources`` rows, a repeated source or a null share raise an error; a null max_repeats is 1. The number of tasks a source
    is spread over grows with its records: ``rows_per_chunk`` to each.
    """
    spark = docs.sparkSession
    want = [r.asDict() for r in targets.select("source", "target_share", "max_repeats").limit(most_sources + 1).collect()]
    names = [str(r["source"]).strip().lower() for r in want]
    if len(want) > most_sources or len(set(names)) < len(names) or any(r["source"] is None or r["target_share"] is None for r in want):
        raise ValueError("targets: too many, a repeated source, or a null")
    number = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "name string, s int")
    size = F.col(size_col).cast("long")
    rows = docs.where(F.col(id_col).isNotNull() & (size > 0)).select(F.col(id_col).cast("long").alias("id"), F.lower(F.trim(F.col(source_col).cast("string"))).alias("name"), size.alias("size"))
    rows = stage(rows.join(F.broadcast(number), "name").select("s", "id", "size"), "sizes")  # targets are bounded above
    most = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    stream = running_total(rows, ["s"], "id", F.col("size"), "begin", max(1, -(-most // rows_per_chunk)))
    b = F.lit(block_tokens)
    pieces = stream.withColumn("block", F.explode(F.expr(f"sequence(begin div {block_tokens}, (begin + size - 1) div {block_tokens})")))
    start = F.greatest(F.col("block") * b, F.col("begin")) - F.col("begin")
    stop = F.least((F.col("block") + 1) * b, F.col("begin") + F.col("size")) - F.col("begin")
    pieces = stage(pieces.select("s", "block", "id", start.alias("start"), (stop - start).alias("tokens")), "pieces")
    supply, blocks = np.zeros(len(want), dtype=np.int64), np.zeros(len(want), dtype=np.int64)
    for r in pieces.groupBy("s").agg(F.sum("tokens").alias("n"), F.max("block").alias("b")).collect():  # a row a source
        supply[r["s"]], blocks[r["s"]] = r["n"], r["b"] + 1
    total = int(supply.sum())
    repeats = np.array([1 if r["max_repeats"] is None else max(0, int(r["max_repeats"])) for r in want], dtype=np.int64)
    share = np.array([float(r["target_share"]) for r in want])
    slots_all = -(-total // block_tokens)
    shards = -(-slots_all // shard_slots)
    p = share / share.sum() if len(share) and share.sum() > 0 else share
    room = blocks * repeats
    last = slots_all - (shards - 1) * shard_slots

    def counts(it):
        for pdf in it:
            ids = pdf["id"].to_numpy()
            if not len(ids):
                continue
            c = np.stack([np.random.default_rng([seed, int(i)]).multinomial(shard_slots if i < shards - 1 else last, p) for i in ids])
            yield pd.DataFrame({"shard": np.repeat(ids, len(p)), "s": np.tile(np.arange(len(p), dtype=np.int32), len(ids)), "drawn": c.ravel(), "place": (np.cumsum(c, 1) - c).ravel()})

    drawn = stage(running_total(spark.range(shards).mapInPandas(counts, "shard long, s int, drawn long, place long"), ["s"], "shard", F.col("drawn"), "first", max(1, -(-shards // rows_per_chunk))), "drawn")
    taken = np.zeros(len(want), dtype=np.int64)
    for r in drawn.groupBy("s").agg(F.sum("drawn").alias("n")).collect():
        taken[r["s"]] = r["n"]
    used = np.minimum(taken, room)
    # draws beyond a source's room, numbered over all shards
    over = F.greatest(F.lit(0), F.col("first") + F.col("drawn") - F.greatest(F.col("first"), F.element_at(F.array(*map(F.lit, room.tolist())), F.col("s") + 1))) if len(want) else F.lit(0)
    open_ = drawn.withColumn("over", over.cast("long")).groupBy("shard").agg(F.sum("over").alias("over"))
    open_ = running_total(open_.withColumn("k", F.lit(0)), ["k"], "shard", F.col("over"), "from", max(1, -(-shards // rows_per_chunk))).select("shard", F.col("from").alias("open_first"))
    empty = int((taken - used).sum())
    extra = refilled(used, room - used, p, empty) if empty else np.zeros(len(want), dtype=np.int64)
    edges = np.cumsum(extra)

    def place(it):
        for pdf in it:
            shard, s, n, at, first, begin = (pdf[c].to_numpy() for c in ("shard", "s", "drawn", "place", "first", "open_first"))
            row = np.repeat(np.arange(len(pdf)), n)
            j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            shard_, s_, index, at_ = shard[row], s[row].astype(np.int64), first[row] + j, at[row] + j
            slot = permute(at_, shard_slots, seed * 7919 + shard_, np.where(shard_ < shards - 1, shard_slots, last)) if len(row) else at_
            refill = index >= room[s_]
            if refill.any():
                # the o-th empty slot of its shard, then of all, then by permutation a source with room
                order = np.lexsort((at_, shard_))
                seen = np.cumsum(refill[order])
                base = np.r_[True, shard_[order][1:] != shard_[order][:-1]]
                start_ = np.maximum.accumulate(np.where(base, seen - refill[order], 0))
                o = np.empty(len(row), np.int64)
                o[order] = seen - 1 - start_
                k = np.flatnonzero(refill)
                turn = permute(begin[row[k]] + o[k], max(1, empty), seed * 104_729)
                to = np.searchsorted(edges, turn, "right")
                ok = to < len(edges)
                s_[k[ok]] = to[ok]
                index[k[ok]] = used[to[ok]] + turn[ok] - (edges[to[ok]] - extra[to[ok]])
                s_[k[~ok]] = -1
            epoch, block = index // np.maximum(blocks[s_], 1), index % np.maximum(blocks[s_], 1)
            for who in np.unique(s_[s_ >= 0]):
                mine = np.flatnonzero(s_ == who)
                block[mine] = permute(block[mine], int(blocks[who]), seed * 1_000_003 + who * 1009 + epoch[mine])
            keep = s_ >= 0
            yield pd.DataFrame({"shard": shard_[keep], "slot": slot[keep], "s": s_[keep].astype(np.int32), "epoch": epoch[keep], "block": block[keep], "refill": refill[keep]})

    # all sources of a shard come to one task together, so that its empty slots are counted in order
    whole = drawn.join(open_, "shard").repartition("shard").sortWithinPartitions("shard", "s")

    def shards_whole(it):
        held = None
        for pdf in it:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            cut = pdf["shard"] == pdf["shard"].iloc[-1] if len(pdf) else []
            held, ready = pdf[cut], pdf[~cut] if len(pdf) else pdf
            for a in range(0, len(ready), 1024 * max(1, len(want))):  # frames of about a million slots
                yield ready.iloc[a : a + 1024 * max(1, len(want))]
        if held is not None:
            yield held

    slots = stage(whole.mapInPandas(lambda it: place(shards_whole(it)), "shard long, slot long, s int, epoch long, block long, refill boolean"), "slots")
    spans = stage(slots.join(pieces, ["s", "block"]), "spans")
    reach = np.minimum(share * total, supply * repeats) if not len(share) else refilled(np.zeros(len(want), np.int64), supply * repeats, p, total)
    sigma = np.sqrt(slots_all * p * (1 - p)) if len(p) else p
    likely = taken + 6 * sigma + repeats >= room
    known = spark.createDataFrame(
        [(i, r["source"], float(share[i]), int(supply[i]), float(share[i]) * total, int(supply[i] * repeats[i]), bool(likely[i]) and bool(int(supply[i] * repeats[i]) < float(share[i]) * total), float(reach[i] / max(1, reach.sum()))) for i, r in enumerate(want)],
        "s int, source string, target_share double, supply_tokens long, wanted_tokens double, cap_tokens long, short boolean, reachable_share double",
    )
    got = spans.groupBy("s").agg(F.sum("tokens").alias("drawn_tokens"), F.sum(F.when(~F.col("refill"), F.col("tokens"))).alias("_first"))
    sum_all = spans.agg(F.sum("tokens").alias("all_tokens"))
    report = known.join(got, "s", "left").join(F.broadcast(sum_all))  # one row
    n = F.coalesce("drawn_tokens", F.lit(0))
    report = report.select(
        "source", "target_share", "supply_tokens", "wanted_tokens", "cap_tokens", "short", (F.coalesce("_first", F.lit(0)) / F.lit(max(1, total))).alias("drawn_share"),
        n.alias("drawn_tokens"), "reachable_share", F.coalesce(n / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
    )
    named = F.element_at(F.array(*[F.lit(r["source"]) for r in want]) if want else F.array(F.lit("")), F.col("s") + 1)
    return Mix(slots.withColumn("source", named).drop("s"), spans.withColumn("source", named).drop("s"), report)
