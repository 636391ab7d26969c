"""Runnable jobs: each has a command line, a small configuration file and a function that takes a session."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOG = logging.getLogger("skyledger.jobs")


_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def columns(text: str) -> T.StructType:
    """A schema from 'name type, name type'."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of a new name below the one that driver and executors share; a local session without one gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="skyledger-")
    return f"{base.rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, without rows if nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def session(name: str) -> SparkSession:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
