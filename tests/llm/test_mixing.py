from collections import Counter

import numpy as np
import pytest

from furrow.llm.mixing import mix, permute, refilled

TARGETS = [("a", 0.4, 1), ("B ", 0.3, 2), ("c", 0.2, 1), ("none", 0.1, 3)]


def docs(spark, n=600):
    rng = np.random.default_rng(1)
    rows = [(i, ["a", " A", "b", "B", "C"][i % 5], int(s), "x") for i, s in enumerate(rng.integers(1, 400, n))]
    rows += [(n, "a", 30_000, "x"), (n + 1, "other", 50, "x"), (n + 2, None, 50, "x"), (None, "a", 50, "x"), (n + 3, "a", None, "x"), (n + 4, "a", 0, "x")]
    return rows, spark.createDataFrame(rows, "id long, source string, size long, block string")


def run(spark, targets, **kw):
    rows, df = docs(spark)
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return rows, mix(df, "id", "source", "size", t, block_tokens=100, shard_slots=64, rows_per_chunk=50, **kw)


def supply(rows, targets):
    out = Counter()
    for i, s, n, _ in rows:
        if i is not None and s is not None and n:
            out[s.strip().lower()] += n
    return {t: out[t.strip().lower()] for t, *_ in targets}


@pytest.mark.parametrize("targets", [TARGETS, [("a", 0.9, 1), ("b", 0.05, 9), ("c", 0.05, 9)], [("a", 1.0, 1)]])
def test_shares_caps_and_short_sources(spark, targets):
    rows, m = run(spark, targets)
    have = supply(rows, targets)
    total = sum(have.values())
    report = {r.source: r for r in m.report.collect()}
    slots = m.slots.collect()
    assert len({(s.shard, s.slot) for s in slots}) == len(slots)  # no slot twice
    for t, share, most in targets:
        r = report[t]
        assert r.supply_tokens == have[t] and r.short == (have[t] * most < share * total)
        assert r.drawn_tokens <= r.cap_tokens
        assert abs(r.actual_share - r.reachable_share) < 0.03
        times = Counter(s.block for s in slots if s.source == t)
        assert not times or max(times.values()) <= most
    # the mix is as large as the caps allow: every slot is filled, or every block is used up
    room = sum(-(-have[t] // 100) * most for t, share, most in targets if share > 0)
    assert len(slots) == min(-(-total // 100), room)


def test_spans_are_parts_of_documents(spark):
    rows, m = run(spark, TARGETS)
    size = {i: n for i, _, n, _ in rows}
    got = m.spans.collect()
    assert all(0 <= r.start and r.start + r.tokens <= size[r.id] and r.tokens > 0 for r in got)
    per = Counter()
    for r in got:
        per[r.shard, r.slot] += r.tokens
    assert max(per.values()) <= 100
    assert {r.source for r in got if r.refill} <= {t for t, *_ in TARGETS}


def test_refilling_is_whole_and_keeps_proportions():
    out = refilled(np.array([10, 10, 10]), np.array([0, 100, 100]), np.array([0.5, 0.25, 0.25]), 20)
    assert out.tolist() == [0, 10, 10]
    assert refilled(np.array([0, 0]), np.array([3, 4]), np.array([0.5, 0.5]), 100).tolist() == [3, 4]
    assert refilled(np.array([0, 0]), np.array([30, 40]), np.array([0.0, 0.5]), 100).tolist() == [0, 40]


def test_permutation_is_one():
    for n in (1, 2, 7, 64, 1000):
        assert sorted(permute(np.arange(n), n, 5).tolist()) == list(range(n))
        assert sorted(permute(np.arange(n), 1024, 5, n).tolist()) == list(range(n))


def test_nothing_and_bad_targets(spark):
    _, df = docs(spark)
    t = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    empty = mix(df.limit(0), "id", "source", "size", t)
    assert empty.spans.count() == 0 and {r.supply_tokens for r in empty.report.collect()} == {0}
    with pytest.raises(ValueError):
        mix(df, "id", "source", "size", spark.createDataFrame([("a", 0.5, 1), ("A", 0.5, 1)], "source string, target_share double, max_repeats int"))
