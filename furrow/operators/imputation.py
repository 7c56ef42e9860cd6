"""Filling missing values from similar records: medians or modes of the finest group with enough support."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import stage


@dataclass(frozen=True)
class Level:
    """A grouping to take a value from, if at least ``support`` of its rows have one."""

    name: str
    keys: tuple[str, ...]
    support: int = 1


def value_histogram(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """(keys, v, c): the number of rows a key and value; counted before the shuffle, so a hot key sends distinct values only."""
    return df.select(*keys, F.col(value).alias("v")).where(F.col("v").isNotNull()).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))


def level_statistics(hist: DataFrame, level: Level, kind: str) -> DataFrame:
    """(keys, value, support): exact median, or the most frequent value (the smallest of equals), of each group.

    What a task sees of a group is its distinct values with their counts, which combine before the shuffle and which the caller
    bounds by rounding. Rows with a null key belong to no group.
    """
    keys = list(level.keys)
    for k in keys:
        hist = hist.where(F.col(k).isNotNull())
    if kind == "mode":
        h = hist.groupBy(*keys, "v").agg(F.sum("c").alias("c"))
        best = F.min(F.struct((-F.col("c")).alias("c"), F.col("v")))
        out = h.groupBy(*keys).agg(best.getField("v").alias("value"), F.sum("c").alias("support"))
    else:
        out = hist.groupBy(*keys).agg(F.percentile("v", 0.5, F.col("c")).alias("value"), F.sum("c").alias("support"))
    return out.where(F.col("support") >= level.support)


def salted_left_join(rows: DataFrame, stats: DataFrame, keys: Sequence[str], spread: int) -> DataFrame:
    """Left join on keys; ``stats`` is repeated ``spread`` times so that a hot key's rows meet it in as many tasks.

    Both sides are shuffled, by the hint: left to itself the planner takes the packed size of the staged file for that of the
    repeated rows, and sends them through the driver.
    """
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(spread))
    wide = stats.withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(spread)])))
    return rows.withColumn("_salt", salt).join(wide.hint("merge"), [*keys, "_salt"], "left").drop("_salt")


#: Bytes of statistics that the driver and every task may hold at once, over all levels of one filling.
MOST_BYTES = 2 << 20


def held_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows, and about the bytes they take as a broadcast relation: eight a column, texts, and 48 a row for its place in the map."""
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() == "string"]
    n, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0))), F.lit(0))).first()
    return n, n * (8 * len(df.columns) + 48) + text


def fill_values(targets: DataFrame, known: DataFrame, value: str, levels: Sequence[Level], kind: str = "median", spread: int = 4, most_broadcast: int = 200_000) -> DataFrame:
    """``targets`` with value, level and support: what each row is filled with, from which level.

    Levels are tried in order, finest first; the first one with enough support gives the value.
    ``known`` has the levels' keys and the usable values. A row whose keys are null, or whose groups all
    lack support, gets nulls: it is not filled. Targets keep every column and repeated rows;
    the names value, level and support must be free.

    A level's statistics, a row a group, are counted: up to ``most_broadcast`` groups go to every task, and the targets stay
    where they are; beyond that both are shuffled, a hot key's targets over ``spread`` tasks. ``spread`` should grow with the largest group.
    The levels sent to every task pass through the driver and stay there together, so they share ``MOST_BYTES``; the number of groups grows with the input.
    """
    every = list(dict.fromkeys(k for x in levels for k in x.keys))
    hist = value_histogram(known, value, every)
    hist = stage(hist, "histogram") if len(levels) > 1 else hist
    out, left = targets, MOST_BYTES
    for i, x in enumerate(levels):
        stats = stage(level_statistics(hist, x, kind).withColumnsRenamed({"value": f"_v{i}", "support": f"_n{i}"}), "level")
        groups, size = held_bytes(stats)
        if groups <= most_broadcast and size <= left:
            out, left = out.join(F.broadcast(stats), list(x.keys), "left"), left - size
        else:
            out = salted_left_join(out, stats, x.keys, spread)
    n = range(len(levels))
    filled = out.withColumns(
        {
            "value": F.coalesce(*[F.col(f"_v{i}") for i in n]),
            "level": F.coalesce(*[F.when(F.col(f"_n{i}").isNotNull(), F.lit(levels[i].name)) for i in n]),
            "support": F.coalesce(*[F.col(f"_n{i}") for i in n]),
        }
    )
    return filled.drop(*[f"_v{i}" for i in n], *[f"_n{i}" for i in n])
