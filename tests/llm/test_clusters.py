import numpy as np
import pandas as pd
import pytest

from furrow.llm.clusters import Features, fit_tree, linked_patches, similarity_clusters, typical_members

F = Features({"x": 1.0, "y": 1.0}, {"g": 25.0})
STEP = {"x": 4.0, "y": 4.0}


def brute(rows, radius, least):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and np.isfinite(r[1]) and r[2] is not None and np.isfinite(r[2]) and r[3] is not None]
    rows = list({r[0]: r for r in rows}.values())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if a[3] == b[3] and np.hypot(a[1] - b[1], a[2] - b[2]) <= radius:
                up[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return sorted((min(g), m) for g in groups.values() if len(g) >= least for m in g)


def scene(n, seed=1, spots=0):
    rng = np.random.default_rng(seed)
    rows = [(f"p{i:05d}", float(x), float(y), int(g)) for i, (x, y, g) in enumerate(zip(rng.normal(0, 6, n), rng.normal(0, 6, n), rng.integers(0, 3, n)))]
    rows += [(f"s{i:05d}", 1.0, 1.0, 1) for i in range(spots)]
    rows += [(None, 1.0, 1.0, 1), ("q1", None, 1.0, 1), ("q2", float("nan"), 1.0, 1), ("q3", float("inf"), 1.0, 1), ("q4", 1.0, 1.0, None), rows[0]]
    return rows


# one cell; many cells; a hot cell cut into squares; squares whose places meet in pairs of parts
@pytest.mark.parametrize("leaf,most,spots", [(10_000, 10_000, 0), (60, 10_000, 0), (60, 40, 300), (400, 5, 300)])
def test_patches_are_those_of_brute_force(spark, leaf, most, spots):
    rows = scene(400, spots=spots)
    df = spark.createDataFrame(rows, "id string, x double, y double, g int")
    tree = fit_tree(df, F, STEP, leaf_rows=leaf, branch=4)
    if leaf < 100:
        assert len(tree.leaves()) > 8 and len(tree.centroids) > 1
    got = linked_patches(df, "id", "x", "y", "g", 0.8, 4, tree, max_cell_rows=most).collect()
    assert sorted((r.patch, r.id) for r in got) == brute(rows, 0.8, 4)


def test_every_row_is_weighed_and_cells_stay_near_their_size(spark):
    rows = scene(3000)
    df = spark.createDataFrame(rows, "id string, x double, y double, g int")
    tree = fit_tree(df, F, {"x": 0.5, "y": 0.5}, leaf_rows=200, branch=8)
    leaves = tree.leaves()
    assert tree.rows[leaves].sum() == len(rows) and tree.rows[leaves].max() <= 200
    x = F.__class__(F.numeric, F.category, F.buckets, tree.features.centre).vectors(pd.DataFrame(rows, columns=["id", "x", "y", "g"]))
    assert set(tree.cells(x)) <= set(leaves.tolist())


def test_empty_table_and_one_place(spark):
    none = spark.createDataFrame([], "id string, x double, y double, g int")
    tree = fit_tree(none, F, STEP)
    assert linked_patches(none, "id", "x", "y", "g", 0.8, 1, tree).count() == 0
    assert similarity_clusters(none, "id", tree).count() == 0
    same = spark.createDataFrame([(f"a{i}", 1.0, 1.0, 1) for i in range(50)], "id string, x double, y double, g int")
    tree = fit_tree(same, F, STEP, leaf_rows=10)
    assert len(tree.leaves()) == 1
    assert linked_patches(same, "id", "x", "y", "g", 0.8, 4, tree).where("patch = 'a0'").count() == 50


def test_clusters_hold_similar_rows_and_name_the_nearest(spark):
    rng = np.random.default_rng(2)
    rows = [(f"c{c}-{i:02d}", 100.0 * c + float(rng.normal()), float(rng.normal()), 0) for c in range(6) for i in range(40)]
    df = spark.createDataFrame([*rows, (None, 0.0, 0.0, 0)], "id string, x double, y double, g int")
    tree = fit_tree(df, F, STEP, leaf_rows=80, branch=4)
    got = similarity_clusters(df, "id", tree, target=50).collect()
    assert sum(r.size for r in got) == 241
    for r in got:
        assert len({m.split("-")[0] for m in r.members}) <= 1 and r.spread < 10
    at = spark.createDataFrame([(r[0].split("-")[0], *r) for r in rows], "c string, id string, x double, y double, g int")
    for r in typical_members(at, "c", "id", "x", "y", ["g"]).collect():
        own = [q for q in rows if q[0].startswith(r.cluster + "-")]
        want = sorted((round(np.hypot(q[1] - r.cx, q[2] - r.cy), 6), q[0]) for q in own)
        assert [r.typical_1, r.typical_2, r.typical_3] == [q[1] for q in want[:3]] and r["size"] == 40


def test_clashing_columns(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 1, "k", 3), ("b", 0.1, 0.0, 1, "k", 3)], "id string, x double, y double, g int, cell string, _w int")
    tree = fit_tree(df, F, STEP)
    assert linked_patches(df, "id", "x", "y", "g", 0.8, 2, tree).count() == 2
