"""Release of a plate archive: detections of all plates as the archive's source table, and the quality of each plate.

Reads the plates and the detections of their scans, and writes below the output path

    source/archive_id=<a>           detections with their key, distances, ring, border score, flags and their plate's background
    plate_quality/archive_id=<a>    for each plate, also those without detections: counts by flag, background, faintest clean
                                    magnitude, share of clean detections

Of detections with the same number on a plate the brightest stays (of equal ones the least in all columns). A release
overwrites just the archives that it holds, so archives can be released one by one, and running it again gives the same rows;
an archive that has lost all its detections is emptied. Detections of plates that aren't known, or without a number, are left out.

    python -m jobs.plate_release --plates DIR/supplier.parquet --detections DIR/lineitem.parquet --output DIR/release
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobs import LOG, columns, new_folder, session, stored
from skyledger.operators import detections as det
from skyledger.operators import records
from skyledger.sources.files import Config

CONFIG = Path(__file__).with_suffix(".ini")
MEASURES = ("x_source", "y_source", "background", "flux_radius", "elongation", "magerr", "mag_auto")
SOURCE = columns(
    "source_id long, plate_id long, source_num long, x_source double, y_source double, mag_auto double, magerr double, flux_radius double, elongation double, dist_center double, dist_edge double, border double, flag_clean int, flag_rim int, flag_negradius int, annular_bin int, bg_mean double, bg_std double, archive_id long"
)
QUALITY = columns("plate_id long, plate_num string, n_sources long, n_clean long, n_rim long, n_negradius long, bg_mean double, bg_std double, faintest double, clean_share double, archive_id long")

#: Means of numbers with five decimals often lie just between two of six, where the order of a sum decides; this moves them off.
OFF_TIES = 3e-9


#: Plates at most that are sent to every task; more of them are shuffled with their detections.
PLATES_SENT = 500_000


def settings(path: str | Path = CONFIG) -> Config:
    return Config.parse(Path(path).read_text())


def plate_rows(plates: DataFrame, config: Config) -> DataFrame:
    """Plates of the archives to release, one row for each."""
    fields = config.sections["Plates"]
    rows = plates.select(F.expr(fields["plate_id"]).cast("long").alias("plate_id"), F.expr(fields["archive_id"]).cast("long").alias("archive_id"), F.expr(fields["plate_num"]).cast("string").alias("plate_num")).where("plate_id IS NOT NULL AND archive_id IS NOT NULL")
    chosen = [int(a) for a in config.option("Release", "archives").split(",") if a.strip()]
    rows = rows.where(F.col("archive_id").isin(chosen)) if chosen else rows
    return rows.groupBy("plate_id").agg(F.min(F.struct("archive_id", "plate_num")).alias("p")).select("plate_id", "p.*")


def given_rows(rows: DataFrame, config: Config) -> DataFrame:
    """Detections with numbers as they are stored (no NaN, no infinity), of a plate and with a number."""
    fields = config.sections["Detections"]
    given = rows.select(*(F.expr(fields[c]).cast("long").alias(c) for c in ("plate_id", "source_num")), *(F.expr(fields[c]).cast("double").alias(c) for c in MEASURES))
    return records.nullified(given).where("plate_id IS NOT NULL AND source_num IS NOT NULL")


def detection_rows(given: DataFrame, plates: DataFrame) -> DataFrame:
    """The brightest of a plate's detections with the same number, with the plate's archive.

    Rows are dealt once, by ranges of archive and plate: what follows by plate, and the write by archive, moves none of them again."""
    few = F.broadcast(plates) if plates.count() <= PLATES_SENT else plates
    dealt = given.join(few, "plate_id").repartitionByRange("archive_id", "plate_id")
    best = F.min(F.struct(F.coalesce("mag_auto", F.lit(float("inf"))).alias("m"), *MEASURES)).alias("d")
    return dealt.groupBy("archive_id", "plate_id", "source_num").agg(best).select("archive_id", "plate_id", "source_num", *(F.col(f"d.{c}").alias(c) for c in MEASURES))


def measured(rows: DataFrame, width: float, height: float) -> DataFrame:
    """Detections with distances, ring, border score (null where a plate's background doesn't vary) and flags."""
    placed = det.with_background(det.distances(rows, width, height, "x_source", "y_source"), ["archive_id", "plate_id"], height / 2)
    scored = placed.withColumn("border", det.border_score(placed, width, height, "x_source", "y_source"))
    return scored.withColumns(det.flags() | {"annular_bin": det.annular_bin(det.bin_edges(int(width), int(height)), width, height)})


def quality(sources: DataFrame, plates: DataFrame) -> DataFrame:
    """A row for each plate from its detections, zeros where it has none."""
    flagged = lambda c: F.sum(c).cast("long").alias("n" + c[4:])
    clean = F.when(F.col("flag_clean") == 1, F.col("mag_auto"))
    sums = sources.groupBy("plate_id", "archive_id").agg(F.count(F.lit(1)).alias("n_sources"), *(flagged(c) for c in ("flag_clean", "flag_rim", "flag_negradius")), F.first("bg_mean", True).alias("bg_mean"), F.first("bg_std", True).alias("bg_std"), F.max(clean).alias("faintest"))
    rows = plates.join(sums, ["plate_id", "archive_id"], "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_sources", "n_clean", "n_rim", "n_negradius")})
    return records.projected(rows.withColumn("clean_share", F.try_divide("n_clean", "n_sources")), QUALITY)


def run(spark: SparkSession, plates: str, detections: str, out: str, config: Config | None = None) -> dict[str, int]:
    """Write the release; rows read and written of each table."""
    config = config or settings()
    width, height = float(config.option("Image", "width")), float(config.option("Image", "height"))
    own = plate_rows(spark.read.parquet(plates), config)
    given = spark.read.parquet(detections)
    rows, known = given_rows(given, config), own.select("plate_id", "archive_id")
    keyed = measured(detection_rows(rows, known), width, height)
    keyed = keyed.withColumn("source_id", records.source_key(F.lit(int(config.option("Release", "dr_num"))), F.col("plate_id"), F.col("source_num")))
    _replace(records.projected(keyed, SOURCE), f"{out}/source", "archive_id")
    # An overwrite by partitions leaves those that get no row: they are emptied one by one (archives are few).
    filled = rows.select("plate_id").distinct().join(known, "plate_id").select("archive_id").distinct()
    stale = stored(spark, f"{out}/source", SOURCE).select("archive_id").distinct().join(known.select("archive_id").distinct(), "archive_id", "left_semi").join(filled, "archive_id", "left_anti")
    for r in stale.collect():
        spark.createDataFrame([], T.StructType(SOURCE.fields[:-1])).write.mode("overwrite").parquet(f"{out}/source/archive_id={r.archive_id}")
        LOG.info("plate_release: archive %d has no detections any more", r.archive_id)
    # Every archive of the plates now holds this run's rows alone.
    _replace(quality(stored(spark, f"{out}/source", SOURCE), own).hint("rebalance", "archive_id"), f"{out}/plate_quality", "archive_id")
    totals = stored(spark, f"{out}/plate_quality", QUALITY).join(known, ["plate_id", "archive_id"], "left_semi").agg(F.sum("n_sources"), F.count(F.lit(1))).first()
    done = {"read": given.count(), "sources": totals[0] or 0, "plates": totals[1]}
    LOG.info("plate_release: read %d detections of %s, wrote %d sources and the quality of %d plates to %s", done["read"], detections, done["sources"], done["plates"], out)
    return done


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that `rows` has in place of those that are there, and leave the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partitions).parquet(path)


def result(spark: SparkSession, out: str) -> DataFrame:
    """All sources with the quality of their plate, and plates without sources."""
    sources, plates = stored(spark, f"{out}/source", SOURCE).drop("bg_mean", "bg_std"), stored(spark, f"{out}/plate_quality", QUALITY)
    keys = ["plate_id", "archive_id"]
    if plates.count() <= PLATES_SENT:
        without = plates.join(sources.select(*keys).distinct(), keys, "left_anti")
        rows = sources.join(F.broadcast(plates), keys).unionByName(without, allowMissingColumns=True)
    else:
        rows = plates.join(sources, keys, "left")
    six = ("x_source", "y_source", "mag_auto", "magerr", "flux_radius", "elongation", "dist_center", "dist_edge", "faintest", "clean_share")
    return rows.select("plate_id", "archive_id", "plate_num", "source_id", "source_num", "annular_bin", "flag_clean", "flag_rim", "flag_negradius", F.round("border", 4).alias("border"), *(F.round(c, 6).alias(c) for c in six), F.round(F.col("bg_mean") + OFF_TIES, 6).alias("bg_mean"), F.round("bg_std", 6).alias("bg_std"), "n_sources", "n_clean", "n_rim", "n_negradius")


def job2_plate_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release of all detections, made twice in the same place."""
    out = new_folder(spark, "plate-release")
    for _ in range(2):
        run(spark, f"{sf_dir}/supplier.parquet", f"{sf_dir}/lineitem.parquet", out)
    return result(spark, out)


SQL = """
WITH pl AS (SELECT s_suppkey AS plate_id, CAST(s_nationkey AS BIGINT) AS archive_id, s_name AS plate_num FROM supplier QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY s_nationkey, s_name) = 1),
g AS (SELECT l_suppkey AS plate_id, l_orderkey * 8 + l_linenumber AS source_num, l_extendedprice / 1000 AS background, l_quantity - 2 AS flux_radius, 1 + l_quantity / 10 AS elongation, l_discount * 60 AS magerr, l_extendedprice / 5000 AS mag_auto FROM lineitem),
u AS (SELECT *, CAST(source_num * 7919 % 10000 AS DOUBLE) AS x_source, CAST(source_num * 104729 % 8000 AS DOUBLE) AS y_source FROM g WHERE plate_id IN (SELECT plate_id FROM pl)
    QUALIFY row_number() OVER (PARTITION BY plate_id, source_num ORDER BY mag_auto, background, flux_radius, elongation, magerr) = 1),
d AS (SELECT *, sqrt(pow(x_source - 5000, 2) + pow(y_source - 4000, 2)) AS dist_center, least(x_source, y_source, 10000 - x_source, 8000 - y_source) AS dist_edge FROM u),
st AS (SELECT plate_id, CASE WHEN count(*) FILTER (i) > 3 THEN avg(background) FILTER (i) ELSE avg(background) END AS bg_mean, CASE WHEN count(*) FILTER (i) > 3 THEN stddev_pop(background) FILTER (i) ELSE stddev_pop(background) END AS bg_std FROM (SELECT *, dist_edge > 400 AND dist_edge < 3600 AS i FROM d) GROUP BY plate_id),
l AS (SELECT sqrt(pow(i.range * 100 - 5000, 2) + pow(j.range * 100 - 4000, 2)) AS r FROM range(4, 96) i, range(4, 76) j), o AS (SELECT sqrt(10000.0::DOUBLE * 10000 + 8000 * 8000) * 5 / 12 AS outer_r),
e AS (SELECT quantile_cont(r, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS q FROM l, o WHERE r <= outer_r),
b AS (SELECT d.*, bg_mean, bg_std, abs(background - bg_mean) / nullif(bg_std, 0) / greatest(least(x_source / 10000, 1 - x_source / 10000, y_source / 8000, 1 - y_source / 8000), 1e-5::DOUBLE) AS border, CASE WHEN dist_edge < 400 OR dist_center >= outer_r THEN 9 ELSE 1 + len(list_filter(q, lambda v: v <= dist_center)) END AS annular_bin FROM d JOIN st USING (plate_id), o, e),
f AS (SELECT *, CASE WHEN flux_radius > 0 AND elongation < 5 AND magerr < 5 AND border < 100 THEN 1 ELSE 0 END AS flag_clean, CASE WHEN border >= 100 THEN 1 ELSE 0 END AS flag_rim, CASE WHEN flux_radius <= 0 THEN 1 ELSE 0 END AS flag_negradius FROM b),
q AS (SELECT plate_id, count(*) AS n_sources, CAST(sum(flag_clean) AS BIGINT) AS n_clean, CAST(sum(flag_rim) AS BIGINT) AS n_rim, CAST(sum(flag_negradius) AS BIGINT) AS n_negradius, max(mag_auto) FILTER (flag_clean = 1) AS faintest FROM f GROUP BY plate_id)
SELECT pl.plate_id, pl.archive_id, pl.plate_num, 4 * 10000000000000 + f.plate_id * 10000000 + source_num AS source_id, source_num, CAST(annular_bin AS INTEGER) AS annular_bin, flag_clean, flag_rim, flag_negradius, round(border, 4) AS border, round(x_source, 6) AS x_source, round(y_source, 6) AS y_source, round(mag_auto, 6) AS mag_auto, round(magerr, 6) AS magerr, round(flux_radius, 6) AS flux_radius, round(elongation, 6) AS elongation,
    round(dist_center, 6) AS dist_center, round(dist_edge, 6) AS dist_edge, round(bg_mean + 3e-9::DOUBLE, 6) AS bg_mean, round(bg_std, 6) AS bg_std, round(faintest, 6) AS faintest, round(n_clean / nullif(n_sources, 0), 6) AS clean_share, coalesce(n_sources, 0) AS n_sources, coalesce(n_clean, 0) AS n_clean, coalesce(n_rim, 0) AS n_rim, coalesce(n_negradius, 0) AS n_negradius
FROM pl LEFT JOIN f ON f.plate_id = pl.plate_id LEFT JOIN q ON q.plate_id = pl.plate_id
"""


def main() -> None:
    take = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("plates", "detections", "output"):
        take.add_argument(f"--{name}", required=True)
    take.add_argument("--config", default=str(CONFIG))
    given = take.parse_args()
    spark = session("plate_release")
    try:
        run(spark, given.plates, given.detections, given.output, settings(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
