import unicodedata

import pytest

from furrow.llm.lookalikes import look_alike_classes, look_alike_pairs, tables

SAME = [
    ("Café at the field", "Café at the field"),
    ("ＡＢＣ １２３", "ABC 123"),
    ("zero​width", "zerowidth"),
    ("hard space", "hard space"),
    ("non‑breaking", "non-breaking"),
    ("раураl", "paypal"),
    ("Ꮯold ᎠᎪᎩ".replace("Ꭹ", "Y"), "Cold DAY"),
    ("𝐁old 𝔊othic", "Bold Gothic"),
    ("Chapter Ⅳ", "Chapter IV"),
    ("ﬁeld oﬃce", "field office"),
    ("ꓓꓮꓔꓮ", "DATA"),
    ("pile ộ up", "pile ộ up"),
    ("ё and йод", "ë and йoд"),
]
APART = [("Case", "case"), ("cafe", "café"), ("a1", "a2"), ("one two", "onetwo"), ("line\nbreak", "line break"), ("dotless ı", "dotless i"), ("quote ’", "quote '"), ("dash –", "dash -"), ("x²", "x2"), ("tab\tstop", "tab stop"), ("Ab", "AΒb"), ("bell\u0007", "bell"), ("각", "간")]


def classes(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    return look_alike_classes(df, "doc_id", "text", **kw)


@pytest.mark.parametrize("most", [500_000, 0])
def test_what_looks_the_same_meets_and_nothing_else(spark, most):
    texts = [t for p in SAME + APART for t in p]
    made = classes(spark, [(i, t, "x") for i, t in enumerate(texts)], most_broadcast=most)
    got = {(r.a, r.b) for r in look_alike_pairs(made).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(len(SAME))}


def test_class_is_named_by_the_shortest_then_first(spark):
    rows = [(5, "hard space", None), (6, "hard space", None), (7, "hard space", None), (3, "hard space", None)]
    got = sorted((r.id, r.class_id, r.canonical_id) for r in classes(spark, rows).collect())
    assert got == [(3, 5, 5), (5, 5, 5), (6, 5, 5), (7, 5, 5)]
    assert sorted((r.a, r.b) for r in look_alike_pairs(classes(spark, rows)).collect()) == [(3, 5), (3, 6), (3, 7), (5, 6), (6, 7)]


def test_missing_empty_long_and_repeated(spark):
    long = "plant row\n" * 20_000
    rows = [(None, "a b", None), (1, None, None), (2, "", None), (3, long, None), (4, long.replace(" ", " "), None), (4, long.replace(" ", " "), None)]
    assert {(r.a, r.b) for r in look_alike_pairs(classes(spark, rows)).collect()} == {(3, 4)}
    assert classes(spark, []).count() == 0


def test_many_spellings_of_one_text(spark):
    rows = [(i, "".join("a" if i >> b & 1 else "а" for b in range(9)) + " field", None) for i in range(512)]
    got = classes(spark, rows).collect()
    assert len(got) == 512 and {r.class_id for r in got} == {511}


def test_tables_keep_canonical_equivalents_together():
    one, many, coarse = tables()
    for c in [*one, *many]:
        d = unicodedata.normalize("NFD", c)
        if d != c and len(d) == 2 and unicodedata.category(d[1]) == "Mn":
            assert coarse.get(c) == coarse.get(d[0], d[0])
