import random

import pytest

from furrow.llm.topn import LoserTree, top_n


def brute(rows, n):
    best = {}
    for g, s, i in {r[:3] for r in rows if None not in r[:3] and r[1] == r[1]}:
        best.setdefault(g, []).append((-s, i))
    return sorted((g, i, -s, k + 1) for g, v in best.items() for k, (s, i) in enumerate(sorted(v)[:n]))


def table(spark, rows, parts=7):
    return spark.createDataFrame(rows, "g int, s double, i string, rank int, h string").repartition(parts)


def rows_of(n, hot):
    rng = random.Random(3)
    rows = [(rng.choice([7] * hot + list(range(40))), float(rng.randint(0, 9)), f"p{rng.randint(0, n):05d}", 1, "x") for _ in range(n)]
    return rows + rows[:50] + [(None, 1.0, "a", 1, "x"), (1, None, "a", 1, "x"), (1, float("nan"), "a", 1, "x"), (1, 1.0, None, 1, "x")]


# one bucket; many buckets; several passes over more runs than one merge takes
@pytest.mark.parametrize("kw", [{}, {"bucket_rows": 20}, {"fan_in": 2}, {"fan_in": 2, "bucket_rows": 10}])
def test_equals_brute_force(spark, kw):
    rows = rows_of(2000, 30)
    got = top_n(table(spark, rows), "g", "s", "i", 5, **kw).collect()
    assert sorted((r.g, r.i, r.s, r["rank"]) for r in got) == brute(rows, 5)


def test_text_groups_ties_and_few_rows(spark):
    df = spark.createDataFrame([("b", 1.0, "z"), ("b", 1.0, "Z"), ("b", 1.0, "é"), ("a", 2.0, "k")], "g string, s double, i string")
    got = sorted((r.g, r["rank"], r.i) for r in top_n(df, "g", "s", "i", 5).collect())
    assert got == [("a", 1, "k"), ("b", 1, "Z"), ("b", 2, "z"), ("b", 3, "é")]


def test_nothing(spark):
    assert top_n(table(spark, []), "g", "s", "i", 5).count() == 0
    assert top_n(table(spark, rows_of(20, 1)), "g", "s", "i", 0).count() == 0


def test_loser_tree_merges():
    rng = random.Random(4)
    runs = [sorted(rng.choices(range(50), k=rng.randint(0, 9))) for _ in range(11)]
    at, out = [0] * 11, []
    tree = LoserTree([r[0] if r else None for r in runs])
    while (k := tree.keys[tree.winner]) is not None:
        out.append(k)
        w = tree.winner
        at[w] += 1
        tree.replay(runs[w][at[w]] if at[w] < len(runs[w]) else None)
    assert out == sorted(x for r in runs for x in r)
