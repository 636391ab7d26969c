"""Test tables as plates, sources and stars: the same arithmetic in Spark and in SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.sky import modulo


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of a small file dealt over all tasks, for columns that cost far more than reading them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def new_path(spark: SparkSession, name: str) -> str:
    """A path of a new name in the folder that driver and executors share; a local session without one gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="skyledger-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_sky(df: DataFrame, key: str) -> DataFrame:
    """`df` with ra and dec (degrees) from a whole-number key, spread evenly over the sphere."""
    k = F.col(key).cast("double")
    return df.withColumns({"ra": modulo(k * F.lit(205.142504759), 360.0), "dec": F.degrees(F.asin(F.lit(2.0) * modulo(k * F.lit(0.754877666), 1.0) - F.lit(1.0)))})


def on_plane(df: DataFrame, key: str) -> DataFrame:
    """`df` with x and y (pixels) from a whole-number key."""
    k = F.col(key).cast("long")
    return df.withColumns({"x": (k * 7919 % 10000).cast("double"), "y": (k * 104729 % 8000).cast("double")})


def sky_sql(key: str) -> str:
    k = f"CAST({key} AS DOUBLE)"
    u = f"({k} * 0.754877666::DOUBLE)"
    r = f"({k} * 205.142504759::DOUBLE)"
    return f"({r} - 360.0::DOUBLE * floor({r} / 360.0::DOUBLE)) AS ra, degrees(asin(2.0::DOUBLE * ({u} - 1.0::DOUBLE * floor({u} / 1.0::DOUBLE)) - 1.0::DOUBLE)) AS dec"


def plane_sql(key: str) -> str:
    return f"CAST({key} * 7919 % 10000 AS DOUBLE) AS x, CAST({key} * 104729 % 8000 AS DOUBLE) AS y"


def separation_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    return f"degrees(asin(least(sqrt(pow(sin(radians({dec2} - {dec1}) / 2), 2) + cos(radians({dec1})) * cos(radians({dec2})) * pow(sin(radians({ra2} - {ra1}) / 2), 2)), 1.0::DOUBLE)) * 2)"
