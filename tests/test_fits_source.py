import os
from decimal import Decimal

import numpy as np
import pytest
from skyledger.sources import fits_source as src


def header(cards):
    lines = "".join(f"{k:<8}= {v!s:>20}".ljust(80) if not isinstance(v, str) else f"{k:<8}= '{v}'".ljust(80) for k, v in cards)
    lines += "END".ljust(80)
    return lines.ljust(-(-len(lines) // src.BLOCK) * src.BLOCK).encode()


def padded(data):
    return data + b"\0" * (-len(data) % src.BLOCK)


def image(pixels, cards=()):
    bits = {"u1": 8, "i2": 16, "i4": 32, "i8": 64, "f4": -32, "f8": -64}[pixels.dtype.str[1:]]
    shape = [(f"NAXIS{k + 1}", n) for k, n in enumerate(reversed(pixels.shape))]
    return header([("SIMPLE", "T"), ("BITPIX", bits), ("NAXIS", pixels.ndim), *shape, *cards]) + padded(pixels.astype(pixels.dtype.newbyteorder(">")).tobytes())


def table(rows, columns):
    """columns: (name, TFORM, bytes of each row, more cards without number)."""
    body = b"".join(b"".join(c[2][k] for c in columns) for k in range(rows))
    width = len(body) // rows if rows else 8
    cards = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", width), ("NAXIS2", rows), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(columns))]
    for k, (name, form, _, more) in enumerate(columns, 1):
        cards += [(f"TTYPE{k}", name), (f"TFORM{k}", form), *((f"{key}{k}", v) for key, v in more)]
    return header(cards) + padded(body)


EMPTY = header([("SIMPLE", "T"), ("BITPIX", 8), ("NAXIS", 0)])


@pytest.fixture
def catalogue(tmp_path):
    n = 1000
    rng = np.random.default_rng(1)
    x, flux, count = rng.normal(size=n), rng.normal(size=(n, 3)).astype("f4"), rng.integers(-5, 5, n)
    each = lambda a, kind: [np.array(v, kind).tobytes() for v in a]
    columns = [
        ("NUMBER", "1J", each(np.arange(n), ">i4"), ()), ("X_IMAGE", "D", each(x, ">f8"), ()), ("FLUX", "3E", each(flux, ">f4"), ()), ("BITS", "11X", [b"\xff\xe0"] * n, ()), ("NAME", "6A", [f"s{k}".encode().ljust(6) for k in range(n)], ()),
        ("GOOD", "L", [b"T" if k % 3 else b"F" if k % 2 else b"\0" for k in range(n)], ()), ("COUNT", "I", each(count, ">i2"), (("TNULL", -3),)), ("SCALED", "I", each(count, ">i2"), (("TSCAL", 0.5), ("TZERO", 10.0))), ("UNSIGNED", "J", each(count, ">i4"), (("TZERO", 2147483648.0),)),
        ("BIG", "K", each(count, ">i8"), (("TZERO", 9223372036854775808.0),)), ("VAR", "PE(5)", [b"\0" * 8] * n, ()),
    ]
    (tmp_path / "a.fits").write_bytes(EMPTY + table(n, columns))
    (tmp_path / "b.fits").write_bytes(EMPTY + table(3, columns[:2]))
    (tmp_path / "c.fits").write_bytes(EMPTY + table(0, columns))
    (tmp_path / "d.fits").write_bytes(EMPTY)
    (tmp_path / "note.txt").write_text("none")
    return tmp_path, x, flux, count


def test_tables_by_ranges_of_rows(spark, catalogue):
    path, x, flux, count = catalogue
    rows = src.extractor_table(spark, str(path), bytes_per_partition=5000)
    assert rows.rdd.getNumPartitions() > 10 and rows.columns == ["path", "row", "NUMBER", "X_IMAGE", "FLUX", "NAME", "GOOD", "COUNT", "SCALED", "UNSIGNED", "BIG"]
    got = sorted(rows.collect(), key=lambda r: (r.path, r.row))
    assert len(got) == 1003 and [r.NUMBER for r in got] == [*range(1000), 0, 1, 2]
    for k, r in enumerate(got[:1000]):
        assert r.X_IMAGE == x[k] and np.array_equal(np.array(r.FLUX, "f4"), flux[k]) and r.NAME == f"s{k}" and r.GOOD == (True if k % 3 else False if k % 2 else None)
        c = int(count[k])
        assert r.COUNT == (None if c == -3 else c) and r.SCALED == 10 + 0.5 * c and r.UNSIGNED == 2**31 + c and r.BIG == Decimal(2**63 + c)
    assert all(r.FLUX is None and r.NAME is None for r in got[1000:])
    named = src.extractor_table(spark, f"file://{path}/a.fits", {"X_IMAGE": "x_source", "NOT_THERE": "y_source"}, columns="X_IMAGE,NUMBER")
    assert named.columns == ["path", "row", "x_source"] and named.count() == 1000


def test_images_by_lines(spark, tmp_path):
    rng = np.random.default_rng(2)
    cube, plane = rng.integers(-100, 100, (2, 30, 17)).astype("i2"), rng.normal(size=(40, 9)).astype("f4")
    plane[3, 4] = np.nan
    (tmp_path / "u.fits").write_bytes(image(cube, [("BZERO", 32768.0), ("BSCALE", 3.0), ("BLANK", -7)]))
    (tmp_path / "f.fits").write_bytes(image(plane, [("BZERO", 1.5), ("BSCALE", 2.0)]))
    (tmp_path / "n.fits").write_bytes(image(np.full((2, 2), np.nan, "f8")))
    lines = sorted(src.image_lines(spark, str(tmp_path), bytes_per_partition=100).collect(), key=lambda r: (r.path, r.line))
    by = {name: [r.pixels for r in lines if r.path.endswith(name)] for name in ("u.fits", "f.fits")}
    want = [[None if v == -7 else v + 32768.0 for v in line] for line in cube.reshape(-1, 17).tolist()]  # unsigned: the scale doesn't count
    assert by["u.fits"] == want
    assert np.allclose([[np.nan if v is None else v for v in line] for line in by["f.fits"]], plane.astype(float) * 2 + 1.5, equal_nan=True)
    got = {os.path.basename(r.path): (r.fits_minval, r.fits_maxval) for r in src.pixel_extremes(spark, str(tmp_path), bytes_per_partition=100).collect()}
    kept = cube[cube != -7]
    assert got["u.fits"] == (kept.min() + 32768.0, kept.max() + 32768.0) and got["n.fits"] == (None, None)
    assert np.allclose(got["f.fits"], (np.nanmin(plane) * 2.0 + 1.5, np.nanmax(plane) * 2.0 + 1.5))
    raw = src.image_lines(spark, f"{tmp_path}/u.fits", raw="true").orderBy("line").first()
    assert raw.pixels == [None if v == -7 else float(v) for v in cube[0, 0].tolist()]


def test_an_image_beyond_two_gigabytes_is_planned_by_its_header(spark, tmp_path):
    path, lines = tmp_path / "large.fits", 50_000
    head = header([("SIMPLE", "T"), ("BITPIX", 16), ("NAXIS", 2), ("NAXIS1", 30_000), ("NAXIS2", lines), ("BZERO", 32768.0)])
    with path.open("wb") as file:
        file.write(head)
        file.truncate(len(head) + -(-60_000 * lines // src.BLOCK) * src.BLOCK)  # sparse: nothing is stored
        file.seek(0, 2)
        file.write(image(np.ones((1, 2), "u1")))
    reader = src.Reader(None, {"path": str(path), "what": "image"})
    parts = reader.partitions()
    assert len(parts) == 45 and parts[-1].last == lines and parts[0].first == 0 and all(a.last == b.first for a, b in zip(parts, parts[1:]))
    rows = src.unit_headers(spark, str(path)).collect()
    assert [(r.hdu, r.data_bytes) for r in rows] == [(0, 60_000 * lines), (1, 2)] and rows[0].cards[1].value == "16"


def test_broken_files(spark, tmp_path):
    (tmp_path / "empty.fits").write_bytes(b"")
    (tmp_path / "cut.fits").write_bytes(image(np.ones((200, 100), "i2"))[:9000])
    (tmp_path / "no_end.fits").write_bytes("SIMPLE  =                    T".ljust(2880).encode())
    assert {os.path.basename(r.path): len(r.cards) for r in src.unit_headers(spark, str(tmp_path)).collect()} == {"cut.fits": 5, "no_end.fits": 36}
    with pytest.raises(Exception, match="ends within its data"):
        src.image_lines(spark, f"{tmp_path}/cut.fits").count()
    assert src.image_lines(spark, f"{tmp_path}/empty.fits").count() == 0 and src.extractor_table(spark, str(tmp_path)).count() == 0
