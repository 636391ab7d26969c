"""Rows of a null group, and of groups without a counterpart, stay."""

from pyspark.sql import functions as F
from skyledger.operators import calibration, fits, headers


def test_null_groups_are_clipped_like_others(spark):
    rows = [(g, v) for g in ("a", None) for v in (1.0, 1.1, 0.9, 1.0, 50.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for rounds in (1, None):
        got = fits.sigma_clipped(df, ["g"], "v", 1.5, rounds).collect()
        assert sorted(r.v for r in got if r.g is None) == sorted(r.v for r in got if r.g == "a") == [0.9, 1.0, 1.0, 1.1]


def test_sources_without_a_curve_stay(spark):
    curves = spark.createDataFrame([("a", m, m + 1.0, 0.1, 10.0, 12.0) for m in (10.0, 11.0, 12.0)], "plate string, plate_mag double, natmag double, error double, bright_limit double, faint_limit double")
    rows = spark.createDataFrame([("a", 10.5, 0.0), ("a", 9.0, 0.0), ("b", 10.5, 0.0), (None, 10.5, 0.0)], "plate string, mag double, magerr double").withColumns({"color": F.lit(1.0), "color_term": F.lit(0.5), "natmag_correction": F.lit(0.0)})
    got = {(r.plate, r.mag): (r.natmag, r.phot_range_flag) for r in calibration.applied(rows, curves, "plate").collect()}
    assert got == {("a", 10.5): (11.5, 0), ("a", 9.0): (10.0, 1), ("b", 10.5): (None, 0), (None, 10.5): (None, 0)}


def test_capitals_after_every_other_character(spark):
    names = {"schmidt-kaler": "Schmidt-Kaler", "o'neil": "O'Neil", "a.b. MÜLLER": "A. B.  Müller", "": "", "3rd élan": "3Rd Élan"}
    df = spark.createDataFrame(list(names.items()), "name string, want string").select(headers.named_observer(F.col("name")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
