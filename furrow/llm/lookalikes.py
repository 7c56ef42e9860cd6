"""Visually identical text: look-alike mapping, accent-sensitive collation groups, one canonical member each."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.session import stage

# Letters of other scripts that look like Latin letters (Cyrillic, Greek, Armenian, Cherokee), one above the other.
LETTERS = "аеорсухіјѕһԁԛԝѵӏАВЕЅІЈКМНОРСТУХԚԜҮӀ" + "ονιρυακϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ" + "օոսհցզՍՕԼ" + "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ"
LATIN = "aeopcyxijshdqwvlABESIJKMHOPCTYXQWYl" + "ovipuakcjABEZHIKMNOPTYXC" + "onuhgqUOL" + "ABCDEGHJKLMPRSTVWZ"
# Hyphens that look like the ordinary one, and the single-storey g.
OTHERS = {"\u2010": "-", "\u2011": "-", "\u0261": "g"}
# Ranges of default-ignorable characters, which a reader cannot see.
INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0xE0001, 0xE007F), (0xE0100, 0xE01EF)]
# Ranges of spaces that are not the ordinary one; line breaks and tabs are not among them.
SPACES = [(0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]


def _each(ranges):
    return [chr(c) for a, b in ranges for c in range(a, b + 1)]


def _by_rule(c: str) -> str | None:
    """What a character looks like by its decomposition or name, or None.

    Width forms and letters in another type face (<wide>, <narrow>, <font>) look like what they decompose to; Roman numerals,
    ligatures and digraphs like the letters they are made of; a Lisu letter named by one Latin letter, or by one and A, like that capital.
    """
    kind, _, rest = unicodedata.decomposition(c).partition(" ")
    name = unicodedata.name(c, "")
    if kind in ("<wide>", "<narrow>", "<font>"):
        return unicodedata.normalize("NFKC", c)
    if kind == "<compat>" and (name.startswith(("ROMAN NUMERAL", "SMALL ROMAN NUMERAL", "LATIN SMALL LIGATURE", "LATIN CAPITAL LIGATURE")) or (name.startswith("LATIN") and len(rest.split()) == 2 and "LETTER" in name)):
        to = unicodedata.normalize("NFKC", c)
        return to if to.replace("\u0301", "").isalpha() else None
    if name.startswith("LISU LETTER ") and (letter := name[12:]) and letter.isascii() and (len(letter) == 1 or (len(letter) == 2 and letter[1] == "A")):
        return letter[0]
    return None


@lru_cache
def tables() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """(one, many, coarse): characters to their look-alike, to one character or none; to several; without accents.

    Fixed letters, spaces and invisible characters first, then _by_rule, then canonical decompositions: an accented
    look-alike becomes the accented Latin letter. ``coarse`` also drops all accents and all Hangul, so that canonically
    equal texts get the same coarse form.

    Outside, because a reader sees the difference: dotless i, curly quotes, dashes longer than a hyphen, the minus sign, the ellipsis,
    superscripts and circled letters; and look-alikes inside one script, such as l, I and 1.
    """
    one = {c: "" for c in _each(INVISIBLE)} | {c: " " for c in _each(SPACES)} | dict(zip(LETTERS, LATIN, strict=True)) | OTHERS
    many, coarse = {}, {}
    for i in range(0x80, 0x30000):
        c = chr(i)
        if c in one or 0xD800 <= i < 0xE000:
            continue
        if (to := _by_rule(c)) is not None:
            to = unicodedata.normalize("NFC", "".join(one.get(x, x) for x in to))
            if len(to) == 1:
                one[c] = to
                coarse[c] = one.get(d := unicodedata.normalize("NFD", to)[0], d)
            elif to:
                many[c] = to
        elif 0x1100 <= i <= 0x11FF or 0xAC00 <= i <= 0xD7FB or 0xA960 <= i <= 0xA97C:
            coarse[c] = ""
        elif unicodedata.category(c) in ("Mn", "Mc"):
            coarse[c] = ""
        elif (d := unicodedata.normalize("NFD", c)) != c:
            to = unicodedata.normalize("NFC", "".join(one.get(x, x) for x in d))
            if to != unicodedata.normalize("NFC", c):
                (one if len(to) == 1 else many)[c] = to
            coarse[c] = one.get(d[0], d[0])
    return one, many, {c: coarse.get(x, x) for c, x in one.items()} | coarse


#: A private-use character that a translation leaves where a character stands for several.
SEVERAL = "\uf8ff"


def spelled_out(text: Column, keep_marks: bool = True) -> Column:
    """Characters that stand for several, written as these."""
    _, many, coarse = tables()
    bare = lambda t: "".join(c for x in unicodedata.normalize("NFD", t) if (c := coarse.get(x, x)))
    pairs = {a: b if keep_marks else bare(b) for a, b in many.items()}
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs.items()])
    here = F.filter(table, lambda p: F.contains(text, p.getField("a")))
    return F.reduce(here, text, lambda acc, p: F.replace(acc, p.getField("a"), p.getField("b")))


def _translate(t: Column, table: dict[str, str]) -> Column:
    table = {k: v for k, v in table.items() if k != v}
    order = sorted(table, key=lambda c: not table[c])  # those that vanish come last: translate drops what has no counterpart
    return F.translate(t, "".join(order), "".join(table[c] for c in order))


def _formed(df: DataFrame, text: str, out: str, table: dict[str, str], keep_marks: bool) -> DataFrame:
    """``out``: the text by one translation; only texts in which it finds characters that stand for several (or SEVERAL itself)
    are spelled out and translated again. In two projections, so that the translation runs once."""
    t = F.col(text)
    plain = F.octet_length(t) == F.char_length(t)
    df = df.withColumn("_marked", F.when(plain, t).otherwise(_translate(t, table | dict.fromkeys(tables()[1], SEVERAL))))
    again = F.contains("_marked", F.lit(SEVERAL))
    return df.withColumn(out, F.when(again, _translate(spelled_out(t, keep_marks), table)).otherwise(F.col("_marked"))).drop("_marked")


def plain_form(df: DataFrame, text: str, out: str) -> DataFrame:
    """The look-alike-mapped text; composed and combining accents are left as they are. Null stays null."""
    return _formed(df, text, out, tables()[0], True)


def coarse_form(df: DataFrame, text: str, out: str) -> DataFrame:
    """A text without look-alikes and accents: equal for all texts that show the same, and for some others."""
    return _formed(df, text, out, tables()[2], False)


@F.pandas_udf(T.StringType())
def composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def look_alike_classes(docs: DataFrame, id_col: str, text_col: str, most_broadcast: int = 500_000) -> DataFrame:
    """(id, variant, class_id, canonical_id): every record of each class with at least two different stored texts.

    Two texts are in one class if they are the same under the accent-sensitive Unicode collation once look-alikes are mapped:
    the collation takes composed and combining accents for the same, and keeps apart case, accents, digits, spaces and line
    breaks. Control characters, which it ignores, are kept apart by the coarse form, which is part of the key. The canonical member is the
    shortest in bytes, then the smallest id; the class is named by it.

    A 64-bit fingerprint of the coarse form and an MD5 of the stored text go through a narrow aggregate that
    finds fingerprints with several texts. One record of each such text is then mapped and grouped in SQL; texts travel only for
    these, and what they are distributed and joined by is the fingerprint, never the text; the collation compares texts of equal fingerprint. The
    canonical member is joined back by the MD5 to all records. Copies of a text are never gathered.

    Null and empty texts and null ids are left out; repeated ids with equal text give equal rows.
    """
    spark = docs.sparkSession
    t = F.col(text_col)
    rows = docs.where(F.col(id_col).isNotNull() & (F.length(t) > 0)).select(F.col(id_col).alias("id"), t.alias("text"))
    rows = coarse_form(rows, "text", "coarse").select("id", F.md5(F.col("text").cast("binary")).alias("variant"), F.xxhash64("coarse").alias("fp"))
    rows = stage(rows, "fingerprints")
    texts = rows.groupBy("fp", "variant").agg(F.min("id").alias("first"))
    several = texts.groupBy("fp").agg(F.min("variant").alias("a"), F.max("variant").alias("b")).where("a <> b").select("fp")
    first = stage(texts.join(several, "fp", "left_semi").select(F.col("first").alias("id"), "variant", "fp"), "candidates")
    if first.count() <= most_broadcast:  # else the join shuffles
        first = F.broadcast(first)
    base = docs.select(F.col(id_col).alias("id"), t.alias("text")).join(first, "id").where(F.md5(F.col("text").cast("binary")) == F.col("variant"))
    mapped = plain_form(base, "text", "mapped").select("id", "variant", "fp", F.octet_length("text").alias("size"), "mapped")
    mapped = stage(mapped, "mapped")
    # several marks on one letter may stand in any order, which the collation leaves to normalisation
    piled = F.col("mapped").rlike(r"\p{M}\p{M}")
    mapped = mapped.where(~piled).unionByName(mapped.where(piled).withColumn("mapped", composed("mapped")))
    # a text in very many spellings is grouped in 16 parts first; >= and <= is the collation's equality, but no join key
    members = spark.sql(
        """WITH shown AS (SELECT id, variant, fp, size, collate(mapped, 'UNICODE') AS shown, pmod(hash(variant), 16) AS salt FROM {texts}),
        parts AS (SELECT fp, shown, min(struct(size, id)) AS best, min(variant) AS low, max(variant) AS high
            FROM (SELECT * FROM shown DISTRIBUTE BY fp, salt) GROUP BY fp, salt, shown),
        classes AS (SELECT fp, shown, min(best).id AS class_id FROM (SELECT * FROM parts DISTRIBUTE BY fp) GROUP BY fp, shown HAVING min(low) <> max(high))
        SELECT t.variant, c.class_id FROM shown t JOIN classes c ON t.fp = c.fp AND t.shown >= c.shown AND t.shown <= c.shown""",
        texts=mapped,
    )
    members = stage(members.distinct(), "members")
    return rows.select("id", "variant").join(members, "variant").select("id", "variant", "class_id", F.col("class_id").alias("canonical_id"))


def look_alike_pairs(classes: DataFrame, spread: int = 8) -> DataFrame:
    """(a, b): pairs of records of one class whose stored texts differ, smaller id first.

    One side is salted and the other repeated for each salt, so a class that holds much of the corpus is joined in
    ``spread`` tasks at least (AQE splits them further).
    """
    left = classes.distinct().select(F.col("id").alias("a"), F.col("variant").alias("va"), "class_id", F.pmod(F.xxhash64("id"), F.lit(spread)).alias("salt"))
    right = classes.distinct().select(F.col("id").alias("b"), F.col("variant").alias("vb"), "class_id", F.explode(F.array(*[F.lit(i).cast("long") for i in range(spread)])).alias("salt"))
    return left.join(right, ["class_id", "salt"]).where("a < b AND va <> vb").select("a", "b").distinct()
