"""Shared pieces of the training-data operators: table access and cutting of lineage."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

#: A build side of a hinted broadcast join may have so many rows of two longs at most (about 64 MB hashed).
BROADCAST_ROWS = 1_000_000
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is configured, a local session (tests) gets a temporary one;
    on a cluster that is an error, as executors wouldn't see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        found = context.getCheckpointDir() if hasattr(context, "getCheckpointDir") else None
    if not found:
        found = getattr(spark, "_skyledger_tmp", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="skyledger-")
        spark._skyledger_tmp = found
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/skyledger/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(forget, spark, path)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Spark's file system layer; nothing happens when it or the session is gone."""
    try:
        jvm = spark.sparkContext._jvm
        if jvm is None:
            return
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # the session has ended
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write `df` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files are deleted as soon as it has ended, not when the driver happens to collect its garbage.
    For chains of queries that write what they hand on; the former setting comes back."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def unused(columns: list[str], name: str) -> str:
    """`name`, with as many underscores before it as make it unlike every one of `columns` (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null apart), as a struct of two longs."""
    return F.struct(F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def pow2_at_least(n: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, n))))


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a lambda variable.

    An expression that is used inside another lambda would be computed anew for each element; a variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
