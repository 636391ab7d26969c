"""Incremental register of transcribed logbook pages.

A file stream takes the files that have come since the last run (its checkpoint says which), in batches, and stops when there
are no more. Every page gets a row: lines, words, characters, clock times, its first line and the digest of its text, both
without diacritics. Two tables are written below the output path:

    pages/shelf=<logbook>/batch=<n>    the pages that batch n has brought
    sums/batch=<n>                     sums over these pages for each logbook
    logbooks/shelf=<logbook>           sums over all pages of a logbook, anew (from the sums of batches) where a batch has touched it
    rejected/batch=<n>                 rows without a page id

A batch overwrites just its own partitions, so one that is repeated after a failure leaves the same rows. A page id that has
come before, in an earlier batch, stays as it is; of rows with the same id in a batch the one with the least digest stays.
The shelf is the logbook's name made fit for a path (several names may share one); the name itself is kept as a column.

    python -m jobs.logpages --input DIR/documents.parquet --output DIR/register --checkpoint DIR/register-checkpoint
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import LOG, columns, new_folder, session, stored
from skyledger.functions import text as tx
from skyledger.operators import catalog
from skyledger.sources.files import Config

CONFIG = Path(__file__).with_suffix(".ini")
PAGES = columns("page_id long, logbook string, language string, n_lines long, n_words long, n_chars long, n_times long, first_line string, text_sha256 string, shelf string, batch long")
LOGBOOKS = columns("logbook string, n_pages long, total_words long, total_times long, longest long, shelf string")
SUMS = columns("logbook string, n_pages long, total_words long, total_times long, longest long, shelf string, batch long")

#: Page ids of a batch (8 bytes each) that are sent to the tasks which look for them among all earlier ones; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

WORD = r"[^\x20\x09-\x0D]+"
#: Hours and minutes, as observers note them.
CLOCK = r"\b[0-2]?[0-9]:[0-5][0-9]\b"


def settings(path: str | Path = CONFIG) -> Config:
    return Config.parse(Path(path).read_text())


def shelf(logbook: Column) -> Column:
    """A logbook's name in a-z, 0-9 and dashes, at most 60 of them."""
    plain = F.regexp_replace(F.lower(tx.ascii_folded(F.coalesce(logbook, F.lit("none")))), r"[^a-z0-9]+", "-")
    return F.concat(F.lit("lb-"), F.substring(plain, 1, 60))


def page_rows(rows: DataFrame, config: Config) -> DataFrame:
    """One row per input row, without the text."""
    fields = config.sections["Pages"]
    given = rows.select(
        F.expr(fields["page_id"]).cast("long").alias("page_id"), F.expr(fields["logbook"]).cast("string").alias("logbook"), F.expr(fields["language"]).cast("string").alias("language"),
        tx.ascii_folded(F.coalesce(F.expr(fields["text"]).cast("string"), F.lit("")), config.option("Text", "german") == "yes").alias("text"),
    )
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    return given.select(
        "page_id", "logbook", "language", count(r"(?m)^.*[^\x20\x09-\x0D].*$").alias("n_lines"), count(WORD).alias("n_words"), F.length("text").cast("long").alias("n_chars"), count(CLOCK).alias("n_times"),
        F.trim(F.regexp_extract("text", r"([^\n]*[^\x20\x09-\x0D][^\n]*)", 1)).alias("first_line"), F.sha2("text", 256).alias("text_sha256"), shelf(F.col("logbook")).alias("shelf"),
    )


def register(rows: DataFrame, number: int, out: str) -> tuple[int, int, int]:
    """Write one batch of page rows; rows read, pages written, rows rejected."""
    spark = rows.sparkSession
    rows = rows.withColumn("batch", F.lit(number).cast("long")).persist()
    try:
        read, rejected, low, high = rows.agg(F.count(F.lit(1)), F.count_if(F.col("page_id").isNull()), F.min("page_id"), F.max("page_id")).first()
        others = [c for c in PAGES.names if c != "page_id"]
        unique = rows.where("page_id IS NOT NULL").groupBy("page_id").agg(F.min_by(F.struct(*others), F.struct("text_sha256", "logbook", "language")).alias("row")).select("page_id", "row.*")
        # Of the pages so far only ids, and only files whose range of ids the batch reaches into, are read; the others stay where they are.
        before = stored(spark, f"{out}/pages", PAGES).where((F.col("batch") != number) & F.col("page_id").between(low, high)).select("page_id")
        if read <= BROADCAST_ROWS:
            before = before.join(F.broadcast(unique.select("page_id")), "page_id", "left_semi")
        # Spark splits a large logbook's rows over several tasks and puts small ones together.
        _replace(catalog.remaining(unique, before, "page_id").select(PAGES.names).hint("rebalance", "shelf"), f"{out}/pages", "shelf", "batch")
        if rejected:
            _replace(rows.where("page_id IS NULL").drop("shelf"), f"{out}/rejected", "batch")
    finally:
        rows.unpersist()
    own = stored(spark, f"{out}/pages", PAGES).where(F.col("batch") == number)
    pages = own.count()
    if pages:
        one = own.groupBy("logbook", "shelf", "batch").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_words").alias("total_words"), F.sum("n_times").alias("total_times"), F.max("n_words").alias("longest"))
        _replace(one.select(SUMS.names), f"{out}/sums", "batch")
        every = stored(spark, f"{out}/sums", SUMS)
        touched = every.where(F.col("batch") == number).select("shelf").distinct()
        total = every.join(touched, "shelf", "left_semi").groupBy("logbook", "shelf").agg(*(F.sum(c).alias(c) for c in ("n_pages", "total_words", "total_times")), F.max("longest").alias("longest"))
        _replace(total.select(LOGBOOKS.names).hint("rebalance", "shelf"), f"{out}/logbooks", "shelf")
    return read, pages, rejected


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that `rows` has in place of those that are there, and leave the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _pattern(path: str) -> str:
    """A pattern that only `path` fits: file streams take a single file, as well as a folder, if it is given by a pattern."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, source: str, out: str, checkpoint: str, config: Config | None = None) -> dict[str, int]:
    """Register the pages of all files that the checkpoint doesn't have; rows read, pages written, rows rejected."""
    config = config or settings()
    total = {"read": 0, "pages": 0, "rejected": 0}

    def batch(rows: DataFrame, number: int) -> None:
        done = dict(zip(total, register(rows, number, out)))
        LOG.info("batch %d: read %d rows of %s, wrote %d pages to %s, rejected %d", number, done["read"], source, done["pages"], out, done["rejected"])
        total.update({k: total[k] + n for k, n in done.items()})

    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", config.option("Stream", "files_per_batch", "64")).parquet(_pattern(source))
    page_rows(stream, config).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    LOG.info("logpages: read %(read)d rows, wrote %(pages)d pages, rejected %(rejected)d", total)
    return total


def result(spark: SparkSession, out: str) -> DataFrame:
    """All pages with the sums of their logbook."""
    pages, books = stored(spark, f"{out}/pages", PAGES), stored(spark, f"{out}/logbooks", LOGBOOKS).drop("shelf").withColumnRenamed("logbook", "_logbook")
    return pages.join(books, F.col("logbook").eqNullSafe(F.col("_logbook"))).drop("_logbook", "batch")


def job1_logpages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register of all documents, after a second run that finds nothing new."""
    base = new_folder(spark, "logpages")
    for _ in range(2):
        run(spark, f"{sf_dir}/documents.parquet", f"{base}/register", f"{base}/checkpoint")
    return result(spark, f"{base}/register")


_FOLDED = r"regexp_replace(replace(replace(replace(replace(replace(replace(replace(translate(strip_accents(coalesce({}, {})), 'øØđĐðÐłŁħĦŧŦı', 'oOdDdDlLhHtTi'), 'ß', 'ss'), 'æ', 'ae'), 'Æ', 'AE'), 'œ', 'oe'), 'Œ', 'OE'), 'þ', 'th'), 'Þ', 'Th'), '[^\x00-\x7F]', '?', 'g')"
SQL = rf"""
WITH f AS (SELECT doc_id AS page_id, source AS logbook, lang AS language, {_FOLDED.format("text", "''")} AS t, 'lb-' || left(regexp_replace(lower({_FOLDED.format("source", "'none'")}), '[^a-z0-9]+', '-', 'g'), 60) AS shelf FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT page_id, logbook, language, shelf, CAST(len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS BIGINT) AS n_lines, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words, CAST(length(t) AS BIGINT) AS n_chars,
    CAST(len(regexp_extract_all(t, '\b[0-2]?[0-9]:[0-5][0-9]\b')) AS BIGINT) AS n_times, trim(coalesce(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))[1], '')) AS first_line, sha256(t) AS text_sha256 FROM f
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY text_sha256, logbook NULLS FIRST, language NULLS FIRST) = 1),
b AS (SELECT logbook, count(*) AS n_pages, CAST(sum(n_words) AS BIGINT) AS total_words, CAST(sum(n_times) AS BIGINT) AS total_times, max(n_words) AS longest FROM p GROUP BY logbook)
SELECT p.*, b.n_pages, b.total_words, b.total_times, b.longest FROM p JOIN b ON p.logbook IS NOT DISTINCT FROM b.logbook
"""


def main() -> None:
    take = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("input", "output", "checkpoint"):
        take.add_argument(f"--{name}", required=True)
    take.add_argument("--config", default=str(CONFIG))
    given = take.parse_args()
    spark = session("logpages")
    try:
        run(spark, given.input, given.output, given.checkpoint, settings(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
