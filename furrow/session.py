"""Session, staging and prefix-sum helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def get_spark(app: str = "furrow", cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Paths only: functions sent to executors carry this module along.
_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset a local session gets a folder of its own; on a cluster that is an error, as
    no other machine would see the driver's folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="furrow-")
    atexit.register(shutil.rmtree, own, True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage and survives the loss of any executor. The schema is
    passed along, so reading it needs no inference job. Tables live until drop_staged, the end of a
    ``staging`` block, or the end of the process.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that is deleted with the staged tables."""
    if not _STAGED:
        atexit.register(release)
    path = f"{shared_dir(spark)}/stage-{os.getpid()}/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(keep: int = 0) -> None:
    """Delete the staged tables but the first ``keep``."""
    while len(_STAGED) > keep:
        path, spark = _STAGED.pop(), SparkSession.getActiveSession()
        try:
            if spark is not None:
                _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended
            pass


@contextmanager
def staging():
    """All tables staged inside are deleted at the end: write or collect the result before."""
    keep = len(_STAGED)
    try:
        yield
    finally:
        release(keep)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        _delete(df.sparkSession, f)


def running_total(df: DataFrame, keys: list[str], order: str, value: Column, out: str, spread: int) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the same keys that come before, by (chunk, order).

    The sum is taken in two steps so that no key's rows meet in one task: rows fall into
    ``spread`` chunks by a hash of ``order``, running sums are taken inside (key, chunk), and the
    chunks' totals (``spread`` rows a key) are summed and added. ``order`` must be unique within
    a key for the result to be the same in every run. Null values count as 0.
    """
    c, t, o = "_rt_chunk", "_rt_total", "_rt_offset"
    df = df.withColumn(c, F.pmod(F.xxhash64(order), F.lit(spread)))
    v = F.coalesce(value, F.lit(0)).cast("long")
    totals = df.groupBy(*keys, c).agg(F.sum(v).alias(t))
    before = Window.partitionBy(*keys).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_rt_{k}") for k in keys], F.col(c).alias("_rt_c"), F.coalesce(F.sum(t).over(before), F.lit(0)).alias(o))
    inner = Window.partitionBy(*keys, c).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(out, F.coalesce(F.sum(v).over(inner), F.lit(0)))
    on = F.col(c) == F.col("_rt_c")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_rt_{k}"))
    return df.join(totals, on).withColumn(out, F.col(out) + F.col(o)).drop(c, "_rt_c", o, *[f"_rt_{k}" for k in keys])
