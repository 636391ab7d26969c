import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from skyledger.functions import sky, text, times
from skyledger.operators import calibration, crossmatch, fits, headers, plates
from skyledger.sources import files, store


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_numbers_and_lists(spark):
    r = one(spark, text.number(F.lit(" 12 ")).alias("a"), text.number(F.lit("1.5e1")).alias("b"), text.number(F.lit("x")).alias("c"), text.items(F.lit(" a;b ; ")).alias("d"), text.items(F.lit(None).cast("string")).alias("e"))
    assert (r.a, r.b, r.c, r.d, r.e) == (12.0, 15.0, None, ["a", "b", ""], [])


def test_combined_times(spark):
    lists = [F.array(F.lit("UT 1:00"), F.lit("2:00")), F.array(F.lit("21:30")), F.array(F.lit("5:00"), F.lit("6:00"))]
    assert one(spark, text.combined_times(*lists).alias("t")).t == ["UT 21:30, ST 5:00", "2:00, ST 6:00"]


def test_folding(spark):
    r = one(spark, text.ascii_folded(F.lit("Größe é 星"), True).alias("a"), text.ascii_folded(F.lit("Größe")).alias("b"))
    assert (r.a, r.b) == ("Groesse e ?", "Grosse")


def test_healpix_known_pixels(spark):
    rows = spark.createDataFrame([(0.0, 90.0), (45.0, 0.0), (0.0, 0.0), (45.0, 89.999), (180.0, -89.999), (315.0, -10.0)], "ra double, dec double")
    got = [r[0] for r in rows.select(sky.healpix_nested(F.col("ra"), F.col("dec"), 0)).collect()]
    assert got == [0, 5, 4, 0, 10, 11]
    wide = spark.range(20000).select((F.col("id") * 0.5698402909980532 % 1 * 360).alias("ra"), F.degrees(F.asin(F.col("id") * 0.7548776662466927 % 1 * 2 - 1)).alias("dec"))
    counts = wide.groupBy(sky.healpix_nested(F.col("ra"), F.col("dec"), 2).alias("p")).count()
    assert counts.count() == 192 and counts.agg(F.max("count")).first()[0] < 160  # equal areas
    nested = wide.filter(F.shiftright(sky.healpix_nested(F.col("ra"), F.col("dec"), 8), 4) != sky.healpix_nested(F.col("ra"), F.col("dec"), 6))
    assert nested.count() == 0


def test_projection_round_trip(spark):
    points = spark.range(200).select((F.col("id") / 40 + 38).alias("ra"), (F.col("id") / 60 + 28).alias("dec"))
    const = [F.lit(v) for v in (40.0, 30.0, 0.001, 5000.0, 4000.0)]
    x, y = sky.tan_pixel(F.col("ra"), F.col("dec"), *const)
    back = points.withColumns({"x": x, "y": y})
    a, d = sky.tan_sky(F.col("x"), F.col("y"), *const)
    assert back.filter((F.abs(a - F.col("ra")) > 1e-9) | (F.abs(d - F.col("dec")) > 1e-9)).count() == 0


def test_distortion_inverse(spark):
    a, b = {(2, 0): 1e-5, (1, 1): 2e-5}, {(0, 2): -1e-5}
    p = spark.range(50).select((F.col("id") * 2.0).alias("x"), (F.col("id") * 1.5).alias("y"))
    u, v = F.col("x") + sky.polynomial(F.col("x"), F.col("y"), a), F.col("y") + sky.polynomial(F.col("x"), F.col("y"), b)
    q = p.withColumns({"u": u, "v": v})
    x, y = sky.undistorted(F.col("u"), F.col("v"), a, b, 8)
    assert q.filter((F.abs(x - F.col("x")) > 1e-6) | (F.abs(y - F.col("y")) > 1e-6)).count() == 0


def test_offset_and_motion_round_trip(spark):
    p = spark.range(100).select((F.col("id") * 3.5).alias("ra"), (F.col("id") * 1.5 - 75).alias("dec"))
    a, d = sky.directional_offset(F.col("ra"), F.col("dec"), F.lit(30.0), F.lit(2.0))
    q = p.withColumns({"a": a, "d": d})
    assert q.filter(F.abs(sky.separation(F.col("ra"), F.col("dec"), F.col("a"), F.col("d")) - 2) > 1e-9).count() == 0


def test_sexagesimal(spark):
    r = one(spark, sky.sexagesimal(F.lit("-0:30")).alias("a"), sky.as_sexagesimal(F.lit(12.5)).alias("b"), sky.as_sexagesimal(F.lit(-0.99999), True).alias("c"))
    assert (r.a, r.b, r.c) == (-0.5, "12:30:00.0", "-01:00:00.0")


def test_plate_epoch(spark):
    r = one(spark, times.plate_epoch(F.lit("x"), F.lit("1956-03-11"), F.lit(None)).alias("a"), times.plate_epoch(F.lit("1901.5"), F.lit(None), F.lit(None)).alias("b"))
    assert (r.a, r.b) == (1956.5, 1901.5)


GOLDEN_START = {("plate1", 1): "1956-03-11 20:11:30", ("plate2", 1): "1956-03-11 21:30:00", ("plate2", 2): "1956-03-11 22:10:00", ("plate3", 1): "1931-03-12 23:49:08"}
GOLDEN_JD = {("plate1", 1): 2435544.34479, ("plate2", 1): 2435544.40625, ("plate2", 2): 2435544.42778, ("plate3", 1): 2426413.49940}


def test_observation_times(spark, tmp_path):
    (tmp_path / "plates.csv").write_text("plate1,1956-03-11,0:00:00,,1,1,x,UT\nplate1,1956-03-11,21:11:30,,1,600,x,Europe/Berlin\nplate2,1956-03-11,21:30:00;22:10:00|22:17:00,22:00:00;22:15:00|22:22:00,2,1800;600,x,UT\nplate3,1931-03-12,12:00:00,,1,1200,x,ST\n")
    conf = files.Config.parse("[plates.csv]\ncsv_list_delimiter = ;\nplate_id = 1\ndate_orig = 2\ntms_orig = 3\ntme_orig = 4\nnumexp = 5\nexptime = 6\ntz_orig = 8\n[Keyword values]\nsite_longitude = 13.06417\n")
    raw = files.metadata_csv(spark, str(tmp_path / "plates.csv"), conf.layout("plates.csv"), lists=("date_orig", "tms_orig", "tme_orig", "exptime"), list_delimiter=conf.option("plates.csv", "csv_list_delimiter"))
    rows = files.latest_rows(raw, "plate_id").withColumns({"exptime": F.transform("exptime", lambda x: x.try_cast("double")), "site_longitude": F.lit(float(conf.constants()["site_longitude"]))})
    assert rows.count() == 3
    got = {(r.plate_id, r.exposure_num): r for r in plates.exposures_of(plates.exposure_parts(rows)).collect()}
    assert set(got) == set(GOLDEN_JD)
    for k, r in got.items():
        assert r.ut_start == dt.datetime.fromisoformat(GOLDEN_START[k])
        assert abs(r.jd_avg - GOLDEN_JD[k]) < 1e-5, (k, r)
    assert got["plate2", 2].num_sub == 2 and got["plate2", 2].exptime == 600


def test_fixed_width_lists(spark, tmp_path):
    line = "POT080 000123A" + "0512  -0530  " + "C" + "19560311211130" + " " + "Orion               " + "S4" + " 1" + " 2" + " 600.0" + "Agfa Astro " + "GG13   " + "IN" + "1618"
    (tmp_path / "main.txt").write_text(line + "\n")
    r = files.plate_list(spark, str(tmp_path / "main.txt"), "UT").first()
    assert (r.wfpdb_id, r.plate_num, r.object_name, r.object_type, r.method, r.numexp, r.exptime, r.plate_format) == ("POT080_000123A", "123A", "Orion", "star cluster", "direct photograph", 2, 600.0, "16x18")
    assert (r.date_orig, r.tms_orig, r.ra_orig) == ("1956-03-11", "UT 21:11:30", "05:12")
    (tmp_path / "notes.txt").write_text("POT080 000123A Object: a, b; Focus: 1.5; odd: x; plain\n")
    n = files.notes_list(spark, str(tmp_path / "notes.txt")).first()
    assert (n.object_name, n.focus, n.notes) == (["a", "b"], ["1.5"], "odd: x; plain")


SCHEMA = """
- name: demo
  functions:
    pgsql: |-
      CREATE FUNCTION f() RETURNS TRIGGER;
  tables:
  - name: plate
    order: 1
    columns:
    - {name: plate_id, order: 2, mysql_datatype: INT UNSIGNED NOT NULL, pgsql_datatype: serial}
    - {name: archive_id, order: 1, mysql_datatype: INT, pgsql_datatype: integer NOT NULL}
    - {name: epoch, order: 3, mysql_datatype: DOUBLE, pgsql_datatype: double precision}
    triggers: {pgsql: [{name: t, function: f()}]}
    indexes:
    - {name: pgsql_pk, val: "ALTER TABLE plate ADD CONSTRAINT pk PRIMARY KEY (plate_id)"}
    - {name: index_1, val: "CREATE INDEX a_ind ON plate (archive_id)"}
"""


def test_schema(spark):
    s = files.parse_schema(SCHEMA, "pgsql", "other")
    assert [f.simpleString() for f in files.spark_schema(s.tables["plate"])] == ["archive_id:int", "plate_id:int", "epoch:double"]
    assert "CREATE TABLE other.plate" in files.create_sql(s) and "CREATE TRIGGER t" in files.create_sql(s)
    assert files.index_sql(s) == "ALTER TABLE other.plate ADD CONSTRAINT pk PRIMARY KEY (plate_id);\nCREATE INDEX plate_a_ind ON other.plate (archive_id);"
    assert files.spark_schema(files.parse_schema(SCHEMA, "mysql").tables["plate"])["plate_id"].dataType.simpleString() == "bigint"


def test_headers(spark, tmp_path):
    cards = [f"{'SIMPLE':<8}= {'T':>20}", f"{'OBSERVER':<8}= 'O''Neil  '           / who", f"{'EXPTIME2':<8}= {'20.5':>20}", f"{'EXPTIME1':<8}= {'10':>20}", f"{'HISTORY':<8}made"]
    block = "".join(c.ljust(80) for c in [*cards, "END"]).ljust(2880).encode()
    (tmp_path / "a.fits").write_bytes(block)
    h = files.image_headers(spark, str(tmp_path))
    r = h.select(headers.value_of(F.col("cards"), "OBSERVER").alias("o"), headers.values_of(F.col("cards"), "EXPTIME").alias("e"), store.header_text(F.col("cards")).alias("t"), "length").first()
    assert (r.o, r.e, r.length) == ("O'Neil", ["10", "20.5"], 2880)
    assert all(len(x) == 80 for x in r.t.split("\n")) and "'O''Neil '" in r.t
    wcs = F.array(headers.card("CRVAL1", F.lit("1.5")))
    keys = h.select(F.transform(headers.with_wcs(F.col("cards"), wcs), lambda c: c["key"]).alias("k")).first().k
    assert keys == ["SIMPLE", "OBSERVER", "EXPTIME2", "EXPTIME1", "CRVAL1", "HISTORY"]


def test_lowess_on_lines():
    x = np.sort(np.random.default_rng(1).uniform(0, 10, 300))
    assert np.abs(fits.lowess(x, 3 * x - 2, 0.3, 3, 0.1) - (3 * x - 2)).max() < 1e-8


def test_calibration_rejects_outliers():
    rng = np.random.default_rng(2)
    mag = rng.uniform(8, 14, 400)
    nat = mag * 0.95 + 1 + rng.normal(0, 0.02, 400)
    nat[:10] += 3
    found = calibration.calibrated(mag, nat)
    assert found["outlier"][:10].all() and found["outlier"][10:].mean() < 0.1
    assert np.abs(np.interp(11.0, found["x"], found["y"]) - (11 * 0.95 + 1)) < 0.05


def test_clusters_by_brute_force(spark):
    rng = np.random.default_rng(3)
    xy = np.concatenate((rng.normal(0, 1, (40, 2)), rng.normal(20, 1, (40, 2)), rng.uniform(-50, 50, (20, 2))))
    points = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(xy)], "id long, x double, y double")
    got = {r.id: r.label for r in fits.dbscan_labels(points, "id", 1.0, 4).collect()}
    near = np.hypot(xy[:, None, 0] - xy[None, :, 0], xy[:, None, 1] - xy[None, :, 1]) <= 1.0
    core = near.sum(1) >= 4
    label = {k: k for k in np.flatnonzero(core)}
    for _ in range(100):
        label = {k: min(label[j] for j in np.flatnonzero(near[k] & core)) for k in label}
    want = {k: label.get(k, min((label[j] for j in np.flatnonzero(near[k] & core)), default=None)) for k in range(100)}
    assert got == want


@pytest.mark.parametrize("crowded", [10_000, 3])
def test_salted_pairs_agree(spark, crowded, monkeypatch):
    monkeypatch.setattr(crossmatch, "CROWDED", crowded)
    p = spark.range(300).select("id", (F.col("id") * 7919 % 100).cast("double").alias("x"), (F.col("id") * 31 % 97).cast("double").alias("y"))
    n = crossmatch.pairs_within(p, p, 5.0, "id", "id").count()
    rows = np.array([(r.x, r.y) for r in p.collect()])
    assert n == (np.hypot(rows[:, None, 0] - rows[None, :, 0], rows[:, None, 1] - rows[None, :, 1]) < 5).sum()


def test_bulk_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "a")], "id long, name string")
    store.bulk_csv(df, str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["1,\\N", "2,a"]
