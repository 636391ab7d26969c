from skyledger.operators import records


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_each_key_falls_back_to_the_next(spark):
    scans = frame(
        spark,
        [("a.fits", "p1", None), ("b.fits", None, None), ("c.x.fits", None, None), ("d", None, None), ("e.fits", None, "w5"), ("g.fits", "p7", None), ("h.fits", "p8", "w8"), ("a.fits", "p1", None), (None, None, None), (".fits", "p2", None)],
        "filename string, plate_id string, wfpdb_id string",
    )
    plates = frame(spark, [("p1", "w1"), ("p2", None), ("c.x", "w3"), ("p8", "w9"), (None, "w0")], "plate_id string, wfpdb_id string")
    listed = frame(spark, [("b",), ("p7",), ("p2",), (None,)], "key string")
    got = sorted((str(r.filename), str(r.plate_id), str(r.wfpdb_id)) for r in records.resolved_keys(scans, plates, listed).collect())
    # In turn: by the plate; the stem in the list is both; the stem among the plates; nothing; by the wfpdb_id; the list has the plate's key; its own.
    assert got == sorted([("a.fits", "p1", "w1")] * 2 + [("b.fits", "b", "b"), ("c.x.fits", "c.x", "None"), ("d", "None", "None"), ("e.fits", "w5", "w5"), ("g.fits", "p7", "p7"), ("h.fits", "p8", "w8"), ("None", "None", "None"), (".fits", "p2", "p2")])


def test_later_sources_override_field_by_field(spark):
    items = frame(spark, [(1, "w1", "p1", "f1"), (2, None, "p2", "f2"), (3, "w3", "p3", None), (4, None, None, None)], "k long, wfpdb_id string, plate_id string, filename string")
    main = frame(spark, [("w1", "m1", "e1"), ("p1", "not this one", "nor this"), ("p2", "m2", None), ("w3", None, "e3"), ("p3", "hidden", "hidden")], "key string, object string, emulsion string")
    notes = frame(spark, [("p1", "n1"), ("p2", None)], "key string, object string")
    scans = frame(spark, [("f2", "s2", "o2"), (None, "x", "x")], "key string, emulsion string, observer string")
    both = ["wfpdb_id", "plate_id"]
    rows = records.cascaded(items, "k", [(main, both), (notes, both), (scans, ["filename"])], ["object", "emulsion", "observer"]).collect()
    assert {r.k: (r.object, r.emulsion, r.observer) for r in rows} == {1: ("n1", "e1", None), 2: ("m2", "s2", "o2"), 3: (None, "e3", None), 4: (None, None, None)}


def test_scans_share_the_record_of_their_plate(spark):
    """Four scans of three plates."""
    scans = frame(spark, [("plate_0001.fits", "plate1"), ("plate_0002.fits", "plate2"), ("plate_0003_1.fits", "plate3"), ("plate_0003_2.fits", "plate3")], "filename string, plate_id string").selectExpr("*", "CAST(NULL AS STRING) AS wfpdb_id")
    plates = frame(spark, [("plate1", "1956-03-11", "21:11:30"), ("plate2", "1956-03-11", "21:30:00;22:10:00|22:17:00"), ("plate3", "1931-03-12", "12:00:00")], "key string, date_orig string, tms_orig string")
    items = records.resolved_keys(scans, plates.selectExpr("key AS plate_id", "CAST(NULL AS STRING) AS wfpdb_id"), plates.select("key").limit(0))
    got = {r.filename: (r.tms_orig, r.date_orig) for r in records.cascaded(items, "filename", [(plates, ["plate_id"])], ["date_orig", "tms_orig"]).collect()}
    assert got == {"plate_0001.fits": ("21:11:30", "1956-03-11"), "plate_0002.fits": ("21:30:00;22:10:00|22:17:00", "1956-03-11"), "plate_0003_1.fits": ("12:00:00", "1931-03-12"), "plate_0003_2.fits": ("12:00:00", "1931-03-12")}
