from pyspark.sql import functions as F
from skyledger.streaming import log

SCHEMA = "event_id long, user_id long, ts timestamp, event_type string, value double"


def rows(spark, first):
    return spark.range(first, first + 50).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"), F.lit("step").alias("event_type"), F.col("id").cast("double").alias("value"))


def test_windows_match_batch(spark, tmp_path):
    rows(spark, 0).write.parquet(str(tmp_path / "in"))
    from pyspark.sql.types import _parse_datatype_string

    stream = log.read_log(spark, str(tmp_path / "in"), _parse_datatype_string(SCHEMA))
    q = log.window_counts(stream, "ts", ["event_type"], "5 minutes").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.table("windows").collect()}
    assert got == {tuple(r) for r in log.window_counts(rows(spark, 0), "ts", ["event_type"], "5 minutes").collect()}


def test_states_and_queue(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(SCHEMA)
    for k in range(2):
        rows(spark, 50 * k).write.mode("append").parquet(str(tmp_path / "in"))
        log.maintain_state(log.read_log(spark, str(tmp_path / "in"), schema), str(tmp_path / "state"), str(tmp_path / "c1"), "user_id", ["ts", "event_id"], ["value"]).awaitTermination()
        log.process_queue(spark, str(tmp_path / "in"), schema, str(tmp_path / "done"), str(tmp_path / "c2"), lambda b: b.select("event_id"), "event_id").awaitTermination()
    state = spark.read.parquet(log.newest(spark, str(tmp_path / "state")))
    assert {r.user_id: r.value for r in state.collect()} == {u: max(k for k in range(100) if k % 7 == u) for u in range(7)}
    assert spark.read.parquet(str(tmp_path / "done")).count() == 100


def test_state_keeps_the_order_of_each_column(spark):
    """Batches against one pass over all rows, with orders that come late and columns that are null at times."""
    kind = "job long, ts long, ev long, value double, note string"
    first = spark.createDataFrame([(1, 10, 1, 1.0, "a"), (1, 9, 5, 2.0, None), (2, 5, 1, None, "x"), (3, 1, 1, 7.0, None)], kind)
    second = spark.createDataFrame([(1, 10, 3, 3.0, None), (2, 4, 9, 4.0, "y"), (2, 6, 0, None, None), (4, 1, 1, None, "n")], kind)
    third = spark.createDataFrame([(1, 10, 2, 9.0, "b"), (3, 1, 2, None, "z")], kind)
    state = None
    for batch in (first, second, third):
        state = log.merged_state(state, batch, "job", ["ts", "ev"], ["value", "note"])
    got = {r.job: (r.value, r.note) for r in state.collect()}
    assert got == {1: (3.0, "b"), 2: (4.0, "x"), 3: (7.0, "z"), 4: (None, "n")}
    whole = log.merged_state(None, first.union(second).union(third), "job", ["ts", "ev"], ["value", "note"])
    assert {r.job: (r.value, r.note) for r in whole.collect()} == got
