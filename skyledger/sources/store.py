"""Writers: archive tables, bulk CSV, formatted CSV, header text, database inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.records import nullified, projected


def stamped(rows: DataFrame) -> DataFrame:
    """Insert and update times, as the writer's clock has them."""
    now = F.current_timestamp()
    return rows.withColumns({c: now for c in ("timestamp_insert", "timestamp_update") if c not in rows.columns})


def archive_rows(rows: DataFrame, schema: T.StructType, sentinels: dict[str, float] | None = None, negative: tuple[str, ...] = ()) -> DataFrame:
    """Rows as a table of the archive takes them: null rules, then the schema's columns in its order."""
    return projected(nullified(stamped(rows), sentinels, negative), schema)


def append(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ("archive_id",)) -> None:
    own = [c for c in partition_by if c in rows.columns]
    writer = rows.write.mode("append")
    (writer.partitionBy(*own) if own else writer).parquet(path)


def surrogate(rows: DataFrame, name: str, order: list[str], start: int = 1) -> DataFrame:
    """A number for each row in order of a natural key: ranges are sorted in parallel, and the sizes of the ranges before
    are added (one small row for each range)."""
    from pyspark.sql.window import Window

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    sizes = ordered.groupBy("_part").count()
    base = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ordered.join(F.broadcast(base), "_part").withColumn(name, F.col("_base") + within + (start - 1)).drop("_part", "_base")


def bulk_csv(rows: DataFrame, path: str) -> None:
    """CSV for a database's bulk load: null as \\\\N."""
    rows.write.mode("overwrite").option("nullValue", "\\N").option("emptyValue", "").csv(path)


def formatted(rows: DataFrame, formats: dict[str, str]) -> DataFrame:
    """Columns as text, each by its printf format; null gives empty text."""
    return rows.select(*(F.coalesce(F.format_string(f, F.col(c)), F.lit("")).alias(c) for c, f in formats.items()))


def formatted_csv(rows: DataFrame, path: str, formats: dict[str, str]) -> None:
    formatted(rows, formats).write.mode("overwrite").option("header", True).csv(path)


def jdbc_append(rows: DataFrame, url: str, table: str, batch: int = 1000, **options: str) -> None:
    rows.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=str(batch), **options).save()


def card_line(card: Column) -> Column:
    """One card as 80 characters."""
    number = card["value"].rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eEdD][+-]?\d+)?$|^[TF]$")
    value = F.when(number, F.lpad(card["value"], 20, " ")).otherwise(F.concat(F.lit("'"), F.rpad(F.replace(F.coalesce(card["value"], F.lit("")), F.lit("'"), F.lit("''")), 8, " "), F.lit("'")))
    tail = F.when(card["comment"].isNotNull(), F.concat(F.lit(" / "), card["comment"])).otherwise("")
    free = card["key"].isin("COMMENT", "HISTORY", "")
    return F.rpad(F.when(free, F.concat(F.rpad(card["key"], 8, " "), F.coalesce(card["value"], F.lit("")))).otherwise(F.concat(F.rpad(card["key"], 8, " "), F.lit("= "), value, tail)), 80, " ")


def header_text(cards: Column) -> Column:
    """A header as lines of 80 characters with an END card."""
    return F.concat_ws("\n", F.array_join(F.transform(cards, card_line), "\n"), F.rpad(F.lit("END"), 80, " "))


def write_headers(headers: DataFrame, path: str, cards: str = "cards") -> None:
    headers.select(header_text(F.col(cards)).alias("value")).write.mode("overwrite").text(path)
