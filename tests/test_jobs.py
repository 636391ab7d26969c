import subprocess
import sys
from pathlib import Path

import pytest
from jobs import logpages, plate_release
from tests.oracle import SF, same

ROOT = Path(__file__).resolve().parent.parent
PAGES = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("job", [(logpages.job1_logpages, logpages.SQL), (plate_release.job2_plate_release, plate_release.SQL)])
def test_sql(spark, job):
    same(job[0](spark, SF), job[1])


def arrive(spark, rows, path):
    spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(str(path))


def pages(spark, out):
    return {r.page_id: (r.n_lines, r.n_words, r.n_times, r.first_line, r.n_pages, r.total_words) for r in logpages.result(spark, out).collect()}


FIRST = [(1, "\nÉtoile α 21:30\nclear sky", "fr", "Märzbuch 1"), (2, "plate 7\n\n  \n22:05 end, 22:10", "en", None), (3, None, None, "Märzbuch 1"), (None, "lost", "en", "x")]
SECOND = [(4, "new page", "en", "Märzbuch 1"), (1, "other text", "en", "x"), (5, "b", "en", ""), (5, "a a", "en", "")]


@pytest.mark.parametrize("sent", [10**6, 0])
def test_logpages_take_only_what_is_new(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(logpages, "BROADCAST_ROWS", sent)
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    arrive(spark, FIRST, source)
    assert logpages.run(spark, str(source), out, mark) == {"read": 4, "pages": 3, "rejected": 1}
    one = {1: (2, 5, 1, "Etoile ? 21:30", 2, 5), 2: (2, 5, 2, "plate 7", 1, 5), 3: (0, 0, 0, "", 2, 5)}
    assert pages(spark, out) == one
    assert logpages.run(spark, str(source), out, mark) == {"read": 0, "pages": 0, "rejected": 0}
    arrive(spark, SECOND, source)
    assert logpages.run(spark, str(source), out, mark) == {"read": 4, "pages": 2, "rejected": 0}
    two = {1: (2, 5, 1, "Etoile ? 21:30", 3, 7), 2: one[2], 3: (0, 0, 0, "", 3, 7), 4: (1, 2, 0, "new page", 3, 7)}
    got = pages(spark, out)
    assert got.pop(5)[4] == 1 and got == two
    assert {r.shelf for r in spark.read.parquet(f"{out}/pages").collect()} == {"lb-marzbuch-1", "lb-none", "lb-"}
    # Files that bring nothing but pages that are known leave everything as it is.
    arrive(spark, SECOND, source)
    assert logpages.run(spark, str(source), out, mark) == {"read": 4, "pages": 0, "rejected": 0} and pages(spark, out).keys() == {1, 2, 3, 4, 5}
    # So does a run that has lost its checkpoint: every file comes again.
    before = sorted(map(tuple, logpages.result(spark, out).collect()))
    assert logpages.run(spark, str(source), out, mark + "-new")["read"] == 12
    assert sorted(map(tuple, logpages.result(spark, out).collect())) == before


def test_logpages_go_on_after_a_failure(spark, tmp_path, monkeypatch):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    for row in FIRST[:3]:
        arrive(spark, [row], source)
    config = logpages.settings()
    config.sections["Stream"]["files_per_batch"] = "1"
    replace = logpages._replace

    def broken(rows, path, *partitions):
        if path.endswith("logbooks") and rows.where("n_pages = 1").count() != rows.count():
            raise OSError("disk is gone")
        replace(rows, path, *partitions)

    with monkeypatch.context() as m:
        m.setattr(logpages, "_replace", broken)
        with pytest.raises(Exception, match="disk is gone"):
            logpages.run(spark, str(source), out, mark, config)
    assert pages(spark, out)
    logpages.run(spark, str(source), out, mark, config)
    whole = tmp_path / "whole"
    logpages.run(spark, str(source), str(whole), str(tmp_path / "other"))
    assert pages(spark, out) == pages(spark, str(whole)) and len(pages(spark, out)) == 3


def small_release(spark, tmp_path, detections):
    plates = [(1, "a", 10), (2, "b", 10), (3, "c", 20), (None, "d", 20), (4, "e", None)]
    spark.createDataFrame(plates, "s_suppkey long, s_name string, s_nationkey int").write.mode("overwrite").parquet(f"{tmp_path}/plates")
    spark.createDataFrame(detections, "l_suppkey long, l_orderkey long, l_linenumber int, l_extendedprice double, l_quantity double, l_discount double").write.mode("overwrite").parquet(f"{tmp_path}/detections")
    return f"{tmp_path}/plates", f"{tmp_path}/detections", f"{tmp_path}/out"


def test_release_of_some_archives(spark, tmp_path):
    rows = [(1, k, 1, 1000.0 * k, 5.0, 0.01) for k in range(20)] + [(1, 3, 1, 2.0, 5.0, 0.01), (3, 1, 1, float("nan"), 1.0, 0.01), (9, 1, 1, 1.0, 1.0, 0.0), (None, 1, 1, 1.0, 1.0, 0.0)]
    paths = small_release(spark, tmp_path, rows)
    assert plate_release.run(spark, *paths) == {"read": 24, "sources": 21, "plates": 3}
    first = sorted(map(str, plate_release.result(spark, paths[2]).collect()))
    assert plate_release.run(spark, *paths)["sources"] == 21 and sorted(map(str, plate_release.result(spark, paths[2]).collect())) == first
    by_plate = {r.plate_id: r for r in plate_release.result(spark, paths[2]).collect()}
    assert by_plate[1].n_sources == 20 and by_plate[2].n_sources == 0 and by_plate[2].source_id is None and by_plate[3].mag_auto is None and by_plate[3].n_negradius == 1
    assert min(r.mag_auto for r in plate_release.result(spark, paths[2]).where("source_num = 25").collect()) == round(2.0 / 5000, 6)
    # One archive anew: plate 3 has lost its detection, plate 1's archive isn't touched.
    config = plate_release.settings()
    config.sections["Release"]["archives"] = "20"
    small_release(spark, tmp_path, [(1, 1, 1, 1.0, 1.0, 0.0)])
    assert plate_release.run(spark, *paths, config) == {"read": 1, "sources": 0, "plates": 1}
    after = {r.plate_id: r.n_sources for r in plate_release.result(spark, paths[2]).collect()}
    assert after == {1: 20, 2: 0, 3: 0} and plate_release.stored(spark, f"{paths[2]}/source", plate_release.SOURCE).count() == 20


@pytest.mark.parametrize("job", ["logpages", "plate_release"])
def test_command_line(job, tmp_path):
    given = {"logpages": ["--input", f"{SF}/documents.parquet", "--checkpoint", f"{tmp_path}/mark"], "plate_release": ["--plates", f"{SF}/supplier.parquet", "--detections", f"{SF}/lineitem.parquet"]}[job]
    done = subprocess.run([sys.executable, "-m", f"jobs.{job}", *given, "--output", f"{tmp_path}/out"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and f"skyledger.jobs {job}: read" in done.stderr, done.stderr[-2000:]
    assert any(tmp_path.glob("out/*/*=*/*.parquet")) or any(tmp_path.glob("out/*/*=*/*=*/*.parquet"))
