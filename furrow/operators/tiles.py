"""Tile grids, ownership of detections, run-length masks and stitching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.session import stage


def stride(size: int, overlap: float) -> int:
    return max(1, round(size * (1 - overlap)))


def starts(length: int, size: int, overlap: float) -> Column:
    """Array of tile starts along one side: every stride, and one flush with the end; [0] if the scene is shorter than a tile."""
    if length <= size:
        return F.array(F.lit(0))
    return F.array_distinct(F.concat(F.sequence(F.lit(0), F.lit(length - size), F.lit(stride(size, overlap))), F.array(F.lit(length - size))))


def tile_grid(spark: SparkSession, width: int, height: int, size: int, overlap: float) -> DataFrame:
    """tile_id (row by row), x0, y0, x1, y1, and the half-open area the tile owns: own_x0 <= x < own_x1, likewise y."""
    w = Window.partitionBy(F.lit(1)).orderBy("at")  # a side has few starts

    def side(length: int, n: str) -> DataFrame:
        s = spark.range(1).select(F.explode(starts(length, size, overlap)).alias("at"))
        return s.select(F.col("at").alias(f"{n}0"), F.least(F.col("at") + size, F.lit(length)).alias(f"{n}1"), F.lead("at", 1, length).over(w).alias(f"own_{n}1"), (F.row_number().over(w) - 1).alias(f"_{n}"))

    xs, ys = side(width, "x"), side(height, "y")
    nx = len(range(0, width - size + 1, stride(size, overlap))) + bool((width - size) % stride(size, overlap)) if width > size else 1
    grid = ys.crossJoin(F.broadcast(xs))  # two short lists of starts, the grid itself
    return grid.select((F.col("_y") * nx + F.col("_x")).cast("int").alias("tile_id"), "x0", "y0", "x1", "y1", F.col("x0").alias("own_x0"), "own_x1", F.col("y0").alias("own_y0"), "own_y1")


def owner(position: Column, length: int, size: int, overlap: float) -> Column:
    """Index of the tile that owns a position along one side; null outside the scene. An equi-key in place of a range join."""
    if length <= size:
        return F.when((position >= 0) & (position < length), F.lit(0))
    step, last = stride(size, overlap), length - size
    regular = len(range(0, last + 1, step))
    final = regular - 1 + bool(last % step)
    index = F.least(F.floor(position / step), F.lit(regular - 1))
    return F.when((position >= 0) & (position < length), F.when(position >= last, F.lit(final)).otherwise(index)).cast("int")


def owned_detections(df: DataFrame, width: int, height: int, size: int, overlap: float, x: str, y: str) -> DataFrame:
    """Rows with tile_id, the tile that owns their centre; rows outside the scene are left out. Overlaps count once."""
    nx = (len(range(0, width - size + 1, stride(size, overlap))) + bool((width - size) % stride(size, overlap))) if width > size else 1
    tx, ty = owner(F.col(x), width, size, overlap), owner(F.col(y), height, size, overlap)
    return df.withColumn("tile_id", (ty * nx + tx).cast("int")).where("tile_id IS NOT NULL")


def tile_summary(grid: DataFrame, detections: DataFrame, confidence: Column, masked: Column) -> DataFrame:
    """tile_id, x0, y0, detections, masks: also for tiles without any."""
    n = detections.where(confidence).groupBy("tile_id").agg(F.count(F.lit(1)).alias("detections"), F.count_if(masked).alias("masks"))
    return grid.join(n, "tile_id", "left").select("tile_id", "x0", "y0", F.coalesce("detections", F.lit(0)).alias("detections"), F.coalesce("masks", F.lit(0)).alias("masks"))


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in a total order, as for a trial run over a few tiles; each task sends n rows."""
    return df.orderBy(*order).limit(n)


def chunked(df: DataFrame, key: str, parts: int = 8, rows_per_chunk: int = 200_000) -> DataFrame:
    """``chunk`` 0..parts-1: consecutive runs of ceil(n / parts) rows in the order of a unique key.

    Rows are numbered from the counts of their range partitions, so no task sees all of them.
    """
    n = df.count()
    size = max(1, -(-n // parts))
    ranged = df.repartitionByRange(max(1, -(-n // rows_per_chunk)), key).withColumn("_p", F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # a row a partition
    i = F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1 + F.col("_o")
    return ranged.join(before, "_p").withColumn("chunk", F.floor(i / F.lit(size)).cast("int")).drop("_p", "_o")


def stitch(pixels: DataFrame, value: str, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Overlapping masks merged into one scene: the largest value, the sum and the number of masks at each pixel."""
    return pixels.groupBy(*keys).agg(F.max(value).alias("largest"), F.sum(value).alias("total"), F.count(F.lit(1)).alias("masks"))


def run_lengths(pixels: DataFrame, keys: list[str], x: str, value: str | None = None) -> DataFrame:
    """(keys, [value,] first, last): maximal runs of adjacent x in each row, ends included; repeated pixels count once.

    With a value column a run also ends where the value changes.
    """
    v = [value] if value else []
    rows = pixels.where(F.col(x).isNotNull()).select(*keys, F.col(x).alias("_x"), *v).distinct()
    order = Window.partitionBy(*keys, *v).orderBy("_x")
    runs = rows.withColumn("_g", F.col("_x") - F.row_number().over(order))
    return runs.groupBy(*keys, *v, "_g").agg(F.min("_x").alias("first"), F.max("_x").alias("last")).drop("_g")


def runs_json(runs: DataFrame, image: list[str], y: str, width: Column, height: Column, value: str | None = None) -> DataFrame:
    """(image, json): a run-length mask document an image, rows by y and runs by start. A row's runs are bounded by the image's width."""
    entry = F.array(F.col("first").cast("int"), F.col("last").cast("int"), *([F.col(value).cast("int")] if value else []))
    rows = runs.groupBy(*image, y).agg(F.array_sort(F.collect_list(entry)).alias("x_runs"))
    rows = rows.groupBy(*image).agg(F.array_sort(F.collect_list(F.struct(F.col(y).alias("y"), "x_runs"))).alias("rows"))
    form = "row_runs_counts_v1" if value else "row_runs_binary_v1"
    return rows.select(*image, F.to_json(F.struct(F.lit(form).alias("format"), width.alias("width"), height.alias("height"), "rows")).alias("json"))


def pixels_of_runs(runs: DataFrame, keys: list[str], x: str) -> DataFrame:
    """The pixels of runs again."""
    return runs.select(*keys, F.explode(F.sequence("first", "last")).alias(x))
