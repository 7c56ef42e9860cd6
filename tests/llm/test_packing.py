import random
from collections import defaultdict

import pytest

from furrow.llm.packing import OpenWindows, pack


def check(rows, kinds, got):
    """Every token of every item once, in pieces that follow each other, and no window above its capacity."""
    used, pieces = defaultdict(int), defaultdict(list)
    for r in got:
        used[r.container_id, r.window] += r.tokens
        pieces[r.container_id, r.item].append((r.piece, r.start, r.tokens))
    for k, c in kinds:
        assert all(n <= c for (kk, _), n in used.items() if kk == k)
        for item, size in rows:
            p = sorted(pieces[k, item])
            assert sum(x[2] for x in p) == size and [x[1] for x in p] == [c * i for i in range(len(p))]
            assert len(p) == max(1, -(-size // c))
    return used


# more tasks than one group of leftovers takes; a single group; groups of a few windows
@pytest.mark.parametrize("parts,windows", [(80, 4096), (3, 4096), (80, 50)])
def test_items_are_whole_and_windows_full(spark, parts, windows):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 5, 40, 99, 100, 101, 250, rng.randint(1, 60)])) for i in range(3000)]
    kinds = [("small", 100), ("large", 1000)]
    df = spark.createDataFrame(rows, "id long, size long").repartition(parts)
    got = pack(df, "id", "size", spark.createDataFrame(kinds, "container_id string, capacity_tokens long"), open_windows=4, merge_windows=windows).collect()
    used = check(rows, kinds, got)
    for k, c in kinds:
        mine = [n for (kk, _), n in used.items() if kk == k and n]
        assert sum(mine) / (c * len(mine)) > 0.9


def test_best_fit_and_eviction_of_the_fullest():
    w = OpenWindows(10, 2)
    assert w.put(6, ["a"]) == (None, None) and w.put(8, ["b"]) == (None, None)
    assert w.put(2, ["c"]) == (None, (1, 10, ["b", "c"]))  # exactly the room of the fuller one
    w.put(7, ["d"])
    closed, full = w.put(9, ["e"])
    assert closed == (2, 7, ["d"]) and full is None


def test_missing_sizes_and_ids(spark):
    kinds = spark.createDataFrame([("k", 10)], "container_id string, capacity_tokens long")
    df = spark.createDataFrame([(None, 5), (1, None), (2, -3), (3, 10), (3, 10), (4, 11)], "id long, size long")
    got = sorted((r.item, r.piece, r.start, r.tokens) for r in pack(df, "id", "size", kinds).collect())
    assert got == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 10), (3, 0, 0, 10), (4, 0, 0, 10), (4, 1, 10, 1)]
    assert pack(df.limit(0), "id", "size", kinds).count() == 0
    with pytest.raises(ValueError):
        pack(df, "id", "size", spark.createDataFrame([("k", 0)], "container_id string, capacity_tokens long"))
