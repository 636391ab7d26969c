"""Steps that must not gather a large group, a whole side of a join, or repeated work in one place."""

from pyspark.sql import functions as F

from skyledger.functions import sky
from skyledger.operators import fits
from skyledger.plans import QUERIES
from tests.conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def test_points_of_a_large_group_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(fits, "TOGETHER", 50)
    points = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.lit(1)).alias("g"), (F.col("id") * 7 % 1000 / 10.0 - 3).alias("x"))
    curve = spark.createDataFrame([(g, float(x), float(x * x)) for g in (1, None) for x in range(0, 91, 10)], "g int, cx double, cy double")
    whole = fits.interpolated(points, curve, "g", "x")
    dealt = fits.interpolated(points, curve, "g", "x", parts=fits.group_parts(points, "g"))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect())) and dealt.where("value IS NOT NULL").count() == 1000
    assert {r.g: r._parts for r in fits.group_parts(points, "g").collect()} == {1: 18, None: 2}


def test_fields_are_not_broadcast_with_their_pixels(spark):
    assert "BroadcastHashJoin" not in plan_of(QUERIES["cone_cover_join"](spark, SF))


def test_inverse_computes_its_start_once(spark):
    one = [F.lit(v) for v in (310.0, 55.0)]
    cd = tuple(map(F.lit, (-0.00042, 0.00003, 0.00003, 0.00042)))
    x, _ = sky.tpv_pixel(F.col("ra"), F.col("dec"), *one, (F.lit(5000.0), F.lit(4000.0)), cd, {0: 1e-4}, {0: 1e-4})
    text = spark.createDataFrame([(310.0, 55.0)], "ra double, dec double").select(x.alias("x"))._jdf.queryExecution().analyzed().toString()
    # The place on the plane is written out for the start and for what a step compares with, not in every term of a step.
    assert 0 < text.count("RADIANS((ra") <= 60
