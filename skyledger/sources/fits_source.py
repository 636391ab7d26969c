"""A data source for FITS files: binary tables, images by lines, and headers, read by ranges of rows.

    spark.dataSource.register(FitsSource)
    spark.read.format("fits_hdu").option("what", "table").load(path)

Planning reads headers alone (blocks of 2,880 bytes to END, data units are skipped), so neither the driver nor a task ever holds a
file: a partition is a range of a table's rows or an image's lines of about `bytes_per_partition` bytes, and is read in pieces.
A table's schema is that of the first file's header (files in order of path); a column that another file lacks is null
there, one that it adds is left out. Pixels and numbers are big-endian; BZERO and BSCALE (TZERO, TSCAL) are applied and
BLANK (TNULL) is null. Bit, complex and variable-length columns are left out.

Options: path (file or folder, any file system that Arrow knows), glob (of file names, `*.fits`), what (`table`, `image` or
`headers`), hdu (from 0; default: 1 for tables, 0 for images), columns (comma-separated, of a table), bytes_per_partition,
raw (`true`: pixels as they are stored).
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skyledger.sources.files import parse_cards

BLOCK = 2880
#: Bytes that a task reads at once.
PIECE = 1 << 22

# Fixed values of the format: kinds of table columns (bytes of one, numpy kind, Spark kind), of pixels, and what unsigned pixels add.
COLUMN_KINDS = {
    "L": (1, "S1", T.BooleanType()), "B": (1, ">u1", T.ShortType()), "I": (2, ">i2", T.ShortType()), "J": (4, ">i4", T.IntegerType()), "K": (8, ">i8", T.LongType()),
    "E": (4, ">f4", T.FloatType()), "D": (8, ">f8", T.DoubleType()), "A": (1, "S", T.StringType()),
}
OTHER_BYTES = {"X": 1, "C": 8, "M": 16, "P": 8, "Q": 16}
PIXEL_KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
UNSIGNED_ZERO = {8: -128.0, 16: 32768.0, 32: 2147483648.0, 64: 9223372036854775808.0}


@dataclass
class Unit:
    """A header and data unit: cards, and where its data begin."""

    number: int
    cards: list[dict]
    data: int

    def value(self, key: str) -> str | None:
        return next((c["value"] for c in self.cards if c["key"] == key), None)

    def whole(self, key: str, default: int = 0) -> int:
        found = self.value(key)
        return default if found is None else int(float(found))

    def number_of(self, key: str, default: float) -> float:
        found = self.value(key)
        return default if found is None else float(found.replace("D", "E"))

    def axes(self) -> list[int]:
        return [self.whole(f"NAXIS{k + 1}") for k in range(self.whole("NAXIS"))]

    def data_bytes(self) -> int:
        axes = self.axes()
        if not axes:
            return 0
        if axes[0] == 0 and self.value("GROUPS") == "T":
            axes = axes[1:]
        return abs(self.whole("BITPIX", 8)) // 8 * self.whole("GCOUNT", 1) * (self.whole("PCOUNT") + int(np.prod(axes, dtype=object)))


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str, pattern: str) -> list[str]:
    """Files of a path in order, as paths of its file system."""
    files, at = opened(path)
    if files.get_file_info(at).type != fs.FileType.Directory:
        return [at]
    found = files.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern))


def units(file: pa.NativeFile, size: int) -> Iterator[Unit]:
    """All units of a file, without their data; a unit whose header has no END ends the file."""
    at, number = 0, 0
    while at < size:
        file.seek(at)
        blocks, ended = [], False
        while not ended and (block := file.read(BLOCK)):
            blocks.append(block)
            ended = any(block[k : k + 8] == b"END     " for k in range(0, len(block), 80))
        unit = Unit(number, parse_cards(b"".join(blocks)), at + BLOCK * len(blocks))
        if not unit.cards:
            return
        yield unit
        if not ended:
            return
        at, number = unit.data + -(-unit.data_bytes() // BLOCK) * BLOCK, number + 1


@dataclass
class Column:
    """A table column: its name, place in the row, numpy kind, repeat, scale and null."""

    name: str
    offset: int
    code: str
    repeat: int
    scale: float
    zero: float
    null: int | None

    def spark_type(self) -> T.DataType:
        kind = COLUMN_KINDS[self.code][2]
        if self.code in "BIJK" and (self.scale != 1 or self.zero != int(self.zero)):
            kind = T.DoubleType()
        elif self.code in "BIJK" and self.zero:
            kind = T.LongType() if abs(self.zero) < 1 << 62 else T.DecimalType(20, 0)
        return kind if self.repeat == 1 or self.code == "A" else T.ArrayType(kind)

    def values(self, rows: np.ndarray) -> pa.Array:
        """The column of some rows (bytes, a row each) as an Arrow array."""
        width, kind, _ = COLUMN_KINDS[self.code]
        raw = np.ascontiguousarray(rows[:, self.offset : self.offset + width * self.repeat])
        if self.code == "A":
            return pa.array([bytes(r).split(b"\0", 1)[0].decode("latin-1").rstrip() for r in raw], pa.string())
        x = raw.view(kind).reshape(len(rows), self.repeat)
        x = x.astype(x.dtype.newbyteorder("=")) if self.code != "L" else x
        missing = x == self.null if self.null is not None else np.zeros(x.shape, bool)
        target = self.spark_type().elementType if isinstance(self.spark_type(), T.ArrayType) else self.spark_type()
        if self.code == "L":
            missing, x = ~np.isin(x, (b"T", b"F")), x == b"T"
        elif isinstance(target, T.DecimalType):
            x = x.astype(object) + int(self.zero)
        elif isinstance(target, T.LongType) and self.zero:
            x = x.astype(np.int64) + int(self.zero)
        elif self.scale != 1 or self.zero:
            x = x.astype(np.float64) * self.scale + self.zero
        flat = pa.array(x.reshape(-1), mask=missing.reshape(-1)) if x.dtype != object else pa.array([None if m else int(v) for v, m in zip(x.reshape(-1), missing.reshape(-1))], pa.decimal128(20, 0))
        flat = flat.cast(_arrow(target))
        return flat if not isinstance(self.spark_type(), T.ArrayType) else pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * self.repeat, pa.int32()), flat)


def _arrow(kind: T.DataType) -> pa.DataType:
    plain = {T.BooleanType: pa.bool_(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64(), T.StringType: pa.string(), T.DecimalType: pa.decimal128(20, 0)}
    return pa.list_(_arrow(kind.elementType)) if isinstance(kind, T.ArrayType) else plain[type(kind)]


def table_columns(unit: Unit) -> list[Column]:
    """The columns of a binary table that can be read."""
    out, offset = [], 0
    for k in range(1, unit.whole("TFIELDS") + 1):
        repeat, code = re.match(r"\s*(\d*)([A-Z])", unit.value(f"TFORM{k}") or "A").groups()
        n = int(repeat or 1)
        if code in COLUMN_KINDS and n:
            null = unit.value(f"TNULL{k}")
            out.append(Column((unit.value(f"TTYPE{k}") or f"col{k}").strip(), offset, code, n, unit.number_of(f"TSCAL{k}", 1.0), unit.number_of(f"TZERO{k}", 0.0), None if null is None else int(null)))
        offset += -(-n // 8) if code == "X" else n * (COLUMN_KINDS[code][0] if code in COLUMN_KINDS else OTHER_BYTES[code])
    return out


def pixel_scale(unit: Unit) -> tuple[float, float]:
    """BSCALE and BZERO; a BZERO other than 0 on whole-number pixels means unsigned ones, with scale 1 and the zero of their size."""
    zero, bits = unit.number_of("BZERO", 0.0), unit.whole("BITPIX", 8)
    return (1.0, UNSIGNED_ZERO[bits]) if zero and bits in UNSIGNED_ZERO else (unit.number_of("BSCALE", 1.0), zero)


@dataclass
class Rows(InputPartition):
    """Rows `first` to before `last` of a unit's data, each of `width` bytes from `data` on."""

    path: str
    unit: Unit | None
    first: int
    last: int
    width: int


class Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options, self.what = schema, dict(options), options.get("what", "table")

    def partitions(self) -> list[Rows]:
        files, _ = opened(self.options["path"])
        out, most = [], int(self.options.get("bytes_per_partition", 64 << 20))
        for path in listed(self.options["path"], self.options.get("glob", "*.fits")):
            if self.what == "headers":
                out.append(Rows(path, None, 0, 0, 0))
                continue
            if (unit := _unit(files, path, self.options)) is None:
                continue
            axes = unit.axes()
            width = axes[0] if self.what == "table" else axes[0] * abs(unit.whole("BITPIX")) // 8
            rows = axes[1] if self.what == "table" else int(np.prod(axes[1:], dtype=object))
            step = max(1, most // max(1, width))
            out += [Rows(path, unit, a, min(a + step, rows), width) for a in range(0, rows if width else 0, step)]
        return out

    def read(self, part: Rows | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no file has rows
            return
        files, _ = opened(self.options["path"])
        with files.open_input_file(part.path) as file:
            if self.what == "headers":
                kind = pa.list_(pa.struct([("pos", pa.int32()), ("key", pa.string()), ("value", pa.string()), ("comment", pa.string())]))
                for unit in units(file, file.size()):
                    yield pa.RecordBatch.from_arrays([pa.array([part.path]), pa.array([unit.number], pa.int32()), pa.array([unit.data_bytes()], pa.int64()), pa.array([unit.cards], kind)], names=self.schema.names)
                return
            columns = {c.name: c for c in table_columns(part.unit)} if self.what == "table" else {}
            step = max(1, PIECE // part.width)
            for a in range(part.first, part.last, step):
                n = min(step, part.last - a)
                file.seek(part.unit.data + a * part.width)
                data = file.read(n * part.width)
                if len(data) < n * part.width:
                    raise ValueError(f"{part.path} ends within its data")
                rows = np.frombuffer(data, np.uint8).reshape(n, part.width)
                head = [pa.array([part.path] * n, pa.string()), pa.array(np.arange(a, a + n), pa.int64())]
                yield pa.RecordBatch.from_arrays([*head, *self._body(part.unit, columns, rows)], names=self.schema.names)

    def _body(self, unit: Unit, columns: dict[str, Column], rows: np.ndarray) -> list[pa.Array]:
        if self.what == "table":
            return [columns[f.name].values(rows).cast(_arrow(f.dataType)) if f.name in columns else pa.nulls(len(rows), _arrow(f.dataType)) for f in self.schema.fields[2:]]
        kind = np.dtype(PIXEL_KINDS[unit.whole("BITPIX")])
        x = np.ascontiguousarray(rows).view(kind)
        blank = unit.value("BLANK")
        missing = x == int(blank) if blank is not None and kind.kind != "f" else np.isnan(x) if kind.kind == "f" else np.zeros(x.shape, bool)
        scale, zero = (1.0, 0.0) if self.options.get("raw", "").lower() == "true" else pixel_scale(unit)
        flat = pa.array(x.astype(np.float64).reshape(-1) * scale + zero, mask=missing.reshape(-1))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * x.shape[1], pa.int32()), flat)]


def _unit(files: fs.FileSystem, path: str, options: dict) -> Unit | None:
    want = int(options.get("hdu", 0 if options.get("what", "table") == "image" else 1))
    with files.open_input_file(path) as file:
        return next((u for u in units(file, file.size()) if u.number == want), None)


class FitsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fits_hdu"

    def schema(self) -> T.StructType:
        what = self.options.get("what", "table")
        path = T.StructField("path", T.StringType())
        if what == "headers":
            return T.StructType([path, T.StructField("hdu", T.IntegerType()), T.StructField("data_bytes", T.LongType()), T.StructField("cards", _CARDS)])
        if what == "image":
            return T.StructType([path, T.StructField("line", T.LongType()), T.StructField("pixels", T.ArrayType(T.DoubleType()))])
        files, _ = opened(self.options["path"])
        found = next(filter(None, (_unit(files, p, self.options) for p in listed(self.options["path"], self.options.get("glob", "*.fits")))), None)
        columns = table_columns(found) if found else []
        if chosen := [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]:
            by_name = {c.name: c for c in columns}
            columns = [by_name[c] for c in chosen]
        return T.StructType([path, T.StructField("row", T.LongType()), *(T.StructField(c.name, c.spark_type()) for c in columns)])

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(schema, self.options)


_CARDS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType()), T.StructField("comment", T.StringType())]))


def _read(spark: SparkSession, path: str, what: str, **options: object) -> DataFrame:
    spark.dataSource.register(FitsSource)
    return spark.read.format("fits_hdu").options(what=what, **{k: str(v) for k, v in options.items()}).load(path)


def extractor_table(spark: SparkSession, path: str, names: dict[str, str] | None = None, **options: object) -> DataFrame:
    """Rows of an extractor's binary tables; with `names` the columns that it has, under the source table's names, beside path and row."""
    rows = _read(spark, path, "table", **options)
    return rows if names is None else rows.select("path", "row", *(F.col(f"`{a}`").alias(b) for a, b in names.items() if a in rows.columns))


def image_lines(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Images line by line: path, line (over all axes but the first), pixels."""
    return _read(spark, path, "image", **options)


def unit_headers(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """path, hdu, data_bytes, cards of every header; no data are read."""
    return _read(spark, path, "headers", **options)


def pixel_extremes(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """fits_minval and fits_maxval of each image, as physical values; null where all pixels are blank."""
    return image_lines(spark, path, **options).groupBy("path").agg(F.min(F.array_min("pixels")).alias("fits_minval"), F.max(F.array_max("pixels")).alias("fits_maxval"))
