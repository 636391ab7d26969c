"""The process log as a stream: counts by window, sessions, growth of catalogues, states of jobs, a work queue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_log(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100, source: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(source).option("maxFilesPerTrigger", files_per_batch).load(path)


def _timed(rows: DataFrame, ts: str, late: str) -> DataFrame:
    return rows.withWatermark(ts, late) if rows.isStreaming else rows


def window_counts(rows: DataFrame, ts: str, keys: list[str], size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window (tumbling, or sliding with `slide`) and key, for a table or a stream."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = _timed(rows, ts, late).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def session_counts(rows: DataFrame, ts: str, keys: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    out = _timed(rows, ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("session_start"), *keys, "n")


def unseen(rows: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Rows whose key has not come before, state bounded by the watermark on a stream."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key]) if rows.isStreaming else rows.dropDuplicates([key])


def merged_state(before: DataFrame | None, rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The state of each key after more rows: each column's last non-null value with the order it came at, as `_at_<column>`."""
    at = F.struct(*order)
    fresh = rows.select(key, *columns, *(F.when(F.col(c).isNotNull(), at).alias(f"_at_{c}") for c in columns))
    both = fresh if before is None else before.select(fresh.columns).unionByName(fresh)
    # Of values at one order the greatest, whatever the partitions.
    last = [F.max(F.when(F.col(f"_at_{c}").isNotNull(), F.struct(f"_at_{c}", c))).alias(f"_last_{c}") for c in columns]
    kept = both.groupBy(key).agg(*last)
    return kept.select(key, *(F.col(f"_last_{c}")[c].alias(c) for c in columns), *(F.col(f"_last_{c}")[f"_at_{c}"].alias(f"_at_{c}") for c in columns))


def maintain_state(stream: DataFrame, path: str, checkpoint: str, key: str, order: list[str], columns: list[str], keep: int = 2) -> StreamingQuery:
    """Keep a table of the latest state of each job: each batch is merged with the table and written as its next version.

    A version is named by the batch, so a repeated batch writes the same one; readers take the newest that is complete. The
    last `keep` versions before it stay for readers that are still at them; older ones are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = newest(spark, path, number)
        state = merged_state(None if before is None else spark.read.parquet(before), batch, key, order, columns)
        state.write.mode("overwrite").parquet(f"{path}/version={number}")
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for old in _versions(spark, path):
            if old < number - keep:
                files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}"), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions below a folder."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(int(n[8:]) for n in names if n.startswith("version=") and files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def newest(spark: SparkSession, path: str, before: int | None = None) -> str | None:
    """The folder of the newest complete version (below a number)."""
    found = [n for n in _versions(spark, path) if before is None or n < before]
    return f"{path}/version={found[-1]}" if found else None


def process_queue(spark: SparkSession, path: str, schema: StructType, done: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str) -> StreamingQuery:
    """Work through files that arrive in a folder, at least once each: results are appended with their key, and a key that is
    done already is left out, so a run that was stopped goes on where it was."""

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        jvm = session.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(done)
        if place.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(place):
            batch = batch.join(session.read.parquet(done).select(key), key, "left_anti")
        work(batch).write.mode("append").parquet(done)

    return read_log(spark, path, schema).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
