"""Readers of archive files: configuration, metadata tables, fixed-width lists, schema files, image headers."""

from __future__ import annotations

import configparser
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import text as tx


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, through Spark's file systems."""
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


@dataclass(frozen=True)
class Config:
    """Settings of an archive: file layouts (column numbers by file), constants, lookup tables."""

    sections: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def parse(cls, content: str, acknowledgements: str | None = None) -> Config:
        parser = configparser.ConfigParser(interpolation=None)
        parser.read_string(content)
        sections = {s: dict(parser.items(s)) for s in parser.sections()}
        if acknowledgements is not None:
            lines = "\n".join(line.strip() for line in acknowledgements.splitlines()).strip()
            sections.setdefault("Keyword values", {})["fits_acknowledgements"] = lines
        return cls(sections)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Config:
        found = cls.parse(read_text(spark, path))
        file = found.sections.get("Files", {}).get("fits_acknowledgements")
        return cls.parse(read_text(spark, path), read_text(spark, file)) if file else found

    def layout(self, file: str) -> dict[str, int]:
        """Column numbers (from 1) of a file's keywords."""
        return {k: int(v) for k, v in self.sections.get(file, {}).items() if not k.startswith("csv_") and v.strip().isdigit()}

    def option(self, section: str, name: str, default: str = "") -> str:
        return self.sections.get(section, {}).get(name, default)

    def constants(self) -> dict[str, str]:
        return self.sections.get("Keyword values", {})


def metadata_csv(spark: SparkSession, path: str, layout: dict[str, int], delimiter: str = ",", quote: str = '"', lists: tuple[str, ...] = (), list_delimiter: str = ",") -> DataFrame:
    """A headerless table: the layout's columns as text, list columns split, and row_num (the order in the file)."""
    raw = spark.read.csv(path, header=False, sep=delimiter, quote=quote, inferSchema=False).withColumn("row_num", F.monotonically_increasing_id())
    have = len(raw.columns) - 1

    def cell(name: str) -> Column:
        at = layout[name] - 1
        value = F.trim(F.col(f"_c{at}")) if at < have else F.lit(None).cast("string")
        return tx.items(value, list_delimiter) if name in lists else value

    return raw.select(*(cell(n).alias(n) for n in layout), "row_num")


def latest_rows(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with equal key the last in the file."""
    from skyledger.operators.records import last_wins

    return last_wins(rows, key, "row_num").drop("row_num")


def _cut(start: int, stop: int) -> Column:
    """Characters from `start` (0 first) to before `stop`."""
    return F.substring("value", start + 1, stop - start)


def _part(start: int, stop: int) -> Column:
    return F.nullif(F.trim(_cut(start, stop)), F.lit(""))


def wide_plate_id() -> Column:
    """The key of a fixed-width line: its first 14 characters, inner blanks as underscores."""
    return F.regexp_replace(F.rtrim(_cut(0, 14)), " ", "_")


def plate_list(spark: SparkSession, path: str, timezone: str = "", exptime_minutes: bool = False) -> DataFrame:
    """Plates of a fixed-width main list."""
    two = lambda a, b: F.lpad(_part(a, b), 2, "0")
    zone = timezone.upper() if timezone.upper() in ("ST", "UT") else timezone
    ra = F.when(_part(14, 16).isNotNull(), F.concat_ws(":", two(14, 16), F.coalesce(two(16, 18), F.lit("00")), two(18, 20)))
    dec = F.when(_part(21, 22).isNotNull(), F.concat_ws(":", _cut(20, 23), F.coalesce(two(23, 25), F.lit("00")), two(25, 27)))
    start = F.when(_part(36, 38).isNotNull(), F.concat_ws(":", _cut(36, 38), F.when(_part(38, 40).isNotNull(), _cut(38, 40)), F.when(_part(38, 40).isNotNull() & _part(40, 42).isNotNull(), _cut(40, 42))))
    code = _part(63, 65)
    size1, size2 = _part(95, 97).try_cast("int"), _part(97, 99).try_cast("int")
    number = F.concat(_part(7, 13).try_cast("int").cast("string"), F.trim(_cut(13, 14)))
    return spark.read.text(path).select(
        wide_plate_id().alias("wfpdb_id"), number.alias("plate_num"), ra.alias("ra_orig"), dec.alias("dec_orig"), _cut(27, 28).alias("coord_flag"),
        F.when(_part(28, 32).isNotNull(), F.concat_ws("-", _cut(28, 32), _cut(32, 34), _cut(34, 36))).alias("date_orig"),
        (F.when(start.isNotNull(), F.concat(F.lit(f"{zone} "), start)) if zone else start).alias("tms_orig"), F.trim(_cut(42, 43)).alias("time_flag"), F.trim(_cut(43, 63)).alias("object_name"), code.alias("object_type_code"),
        F.coalesce(tx.lookup(code, tx.OBJECT_TYPES), code).alias("object_type"), _part(65, 67).try_cast("int").alias("method_code"), tx.lookup(_part(65, 67).try_cast("int"), tx.METHODS).alias("method"),
        F.coalesce(_part(67, 69).try_cast("int"), F.lit(1)).alias("numexp"), (_part(69, 75).try_cast("double") * (60.0 if exptime_minutes else 1.0)).alias("exptime"), F.trim(_cut(75, 86)).alias("emulsion"), F.trim(_cut(86, 93)).alias("filter"), F.trim(_cut(93, 95)).alias("spectral_band"),
        size1.alias("plate_size1"), size2.alias("plate_size2"), F.when((size1 != 0) & (size2 != 0), F.concat_ws("x", F.least(size1, size2).cast("string"), F.greatest(size1, size2).cast("string"))).alias("plate_format"),
    )


def observer_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(wide_plate_id().alias("wfpdb_id"), F.trim(F.substr(F.col("value"), F.lit(16))).alias("observer"))


#: Keys of a notes line with a column of their own; other keys stay in the notes.
NOTE_KEYS = ("exposure time", "exposure start", "exposure end", "ut-start", "ut-end", "st-start", "st-end", "jd-avg", "object", "object name", "object type", "ra", "dec", "focus", "emulsion", "instrument", "prism name", "prism angle", "sky conditions", "original plate number", "bibcode", "observer notes", "observer note", "time zone")


def notes_list(spark: SparkSession, path: str) -> DataFrame:
    """Notes lines 'key: value; key: value' after the plate's key: a column for each known key, joined texts for the rest."""
    rows = spark.read.text(path).select(wide_plate_id().alias("wfpdb_id"), tx.key_values(F.substr(F.col("value"), F.lit(16))).alias("kv"))
    kv = F.col("kv")
    listed = lambda k: tx.items(tx.value_of(kv, k), ",")
    out = {k.replace(" ", "_").replace("-", "_"): listed(k) for k in ("exposure time", "exposure start", "exposure end", "ut-start", "ut-end", "st-start", "st-end", "object type", "ra", "dec", "focus")}
    out |= {k.replace(" ", "_"): tx.value_of(kv, k) for k in ("emulsion", "instrument", "prism name", "prism angle", "sky conditions", "original plate number", "bibcode")}
    out |= {"jd_avg": tx.number(tx.value_of(kv, "jd-avg")), "object_name": tx.items(F.coalesce(tx.value_of(kv, "object"), tx.value_of(kv, "object name")), ",")}
    observer = F.array_join(F.transform(F.filter(kv, lambda x: x["key"].startswith("observer note")), lambda x: x["value"]), "; ")
    return rows.select("wfpdb_id", *(v.alias(k) for k, v in out.items()), F.nullif(observer, F.lit("")).alias("observer_notes"), tx.joined_values(kv, "notes", NOTE_KEYS).alias("notes"))


def quality_list(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).select(wide_plate_id().alias("wfpdb_id"), tx.key_values(F.substr(F.col("value"), F.lit(16))).alias("kv"))
    kv = F.col("kv")
    return rows.select("wfpdb_id", tx.number(tx.value_of(kv, "temperature")).alias("air_temperature"), tx.value_of(kv, "calmness").alias("sky_calmness"), tx.value_of(kv, "sharpness").alias("sky_sharpness"), tx.value_of(kv, "transparency").alias("sky_transparency"), tx.value_of(kv, "sky").alias("sky_conditions"))


def platelist(first: DataFrame, other: DataFrame, key: str = "plate_id") -> DataFrame:
    """Keys of the first source, or of the other one where the first has no rows at all."""
    return first.select(key) if first.limit(1).count() else other.select(key)


# Schema files


@dataclass(frozen=True)
class Table:
    name: str
    columns: dict[str, str]
    indexes: dict[str, str] = field(default_factory=dict)
    triggers: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Schema:
    name: str
    tables: dict[str, Table]
    functions: tuple[str, ...] = ()


def parse_schema(content: str, dialect: str, new_name: str | None = None) -> Schema:
    """Tables with columns of one dialect (pgsql or mysql), in their stated order, from a YAML document."""
    import yaml

    document = yaml.safe_load(content)[0]
    tables = {}
    for t in sorted(document.get("tables") or [], key=lambda t: t.get("order", 0)):
        columns = {c["name"]: c[f"{dialect}_datatype"] for c in sorted(t.get("columns") or [], key=lambda c: c.get("order", 0))}
        indexes = {i["name"]: i["val"] for i in t.get("indexes") or [] if "index" in i["name"] or i["name"] == f"{dialect}_pk"}
        triggers = tuple((x["name"], x["function"]) for x in (t.get("triggers") or {}).get(dialect) or [])
        tables[t["name"]] = Table(t["name"], columns, indexes, triggers)
    return Schema(new_name or document["name"], tables, tuple(v for k, v in (document.get("functions") or {}).items() if k == dialect))


#: Spark types by the leading words of a declared type, the longest first.
SPARK_TYPES = (
    ("timestamp without", T.TimestampNTZType()), ("timestamp with", T.TimestampType()), ("timestamp", T.TimestampType()), ("datetime", T.TimestampNTZType()), ("double", T.DoubleType()), ("real", T.FloatType()), ("float", T.FloatType()),
    ("bigint unsigned", T.DecimalType(20, 0)), ("bigint", T.LongType()), ("bigserial", T.LongType()), ("int unsigned", T.LongType()), ("int", T.IntegerType()), ("serial", T.IntegerType()), ("smallint unsigned", T.IntegerType()), ("smallint", T.ShortType()),
    ("tinyint", T.ShortType()), ("character", T.StringType()), ("varchar", T.StringType()), ("char", T.StringType()), ("text", T.StringType()), ("date", T.DateType()), ("boolean", T.BooleanType()), ("string", T.StringType()),
)


def spark_schema(table: Table) -> T.StructType:
    def kind(declared: str) -> T.DataType:
        low = re.sub(r"\(.*?\)", "", declared.lower())
        return next(t for k, t in SPARK_TYPES if low.startswith(k))

    return T.StructType([T.StructField(n, kind(d), "not null" not in d.lower()) for n, d in table.columns.items()])


def create_sql(schema: Schema, table: str | None = None, dialect: str = "pgsql") -> str:
    """CREATE statements of one table or all, with functions and triggers for pgsql."""
    parts = [f"CREATE SCHEMA {schema.name};"] if table is None else []
    chosen = [schema.tables[table]] if table else list(schema.tables.values())
    if dialect == "pgsql":
        parts += [f"{f.strip()}" for f in schema.functions]
    for t in chosen:
        columns = ",\n".join(f"    {n} {d}" for n, d in t.columns.items())
        tail = " ENGINE=Aria CHARACTER SET=utf8 COLLATE=utf8_bin" if dialect == "mysql" else ""
        parts.append(f"CREATE TABLE {schema.name}.{t.name} (\n{columns}\n){tail};")
        parts += [f"CREATE TRIGGER {name} BEFORE UPDATE ON {schema.name}.{t.name} FOR EACH ROW EXECUTE PROCEDURE {function};" for name, function in t.triggers] if dialect == "pgsql" else []
    return "\n".join(parts)


def drop_sql(schema: Schema, table: str | None = None) -> str:
    return f"DROP TABLE IF EXISTS {schema.name}.{table};" if table else f"DROP SCHEMA IF EXISTS {schema.name} CASCADE;"


def index_sql(schema: Schema) -> str:
    """Index and key statements of all tables, qualified by the schema, index names starting with their table's."""
    out = []
    for t in schema.tables.values():
        for statement in (s.strip() for v in t.indexes.values() for s in v.split(";")):
            if statement.startswith("CREATE INDEX "):
                out.append(f"CREATE INDEX {t.name}_{statement[13:].replace('ON ', f'ON {schema.name}.')};")
            elif statement.startswith("ALTER TABLE "):
                out.append(f"ALTER TABLE {schema.name}.{statement[12:]};")
    return "\n".join(out)


def create_tables(spark: SparkSession, schema: Schema, provider: str = "parquet") -> None:
    """The schema as a Spark database; keys and triggers have no counterpart there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema.name}")
    for t in schema.tables.values():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema.name}.{t.name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in spark_schema(t))}) USING {provider}")


# Images

CARD = "array<struct<pos:int,key:string,value:string,comment:string>>"


def parse_cards(block: bytes | pa.Buffer) -> list[dict]:
    """Cards of 80 characters to END: quoted or plain values, comments; keys may repeat."""
    out: list[dict] = []
    block = memoryview(block)
    for at in range(0, len(block) - 79, 80):
        card = bytes(block[at : at + 80]).decode("latin-1")
        key, rest = card[:8].strip(), card[8:]
        if key == "END":
            break
        value = comment = None
        if rest.startswith("= "):
            quoted = re.match(r"=\s*'((?:[^']|'')*)'\s*(?:/\s?(.*))?", rest)
            if quoted:
                value, comment = quoted[1].replace("''", "'").rstrip(), quoted[2]
            else:
                plain, _, comment = rest[2:].partition("/")
                value = plain.strip() or None
        else:
            value = rest.strip()
        out.append({"pos": len(out), "key": key, "value": value, "comment": (comment or "").strip() or None})
    return out


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("key", pa.string()), ("value", pa.string()), ("comment", pa.string())]))
    for batch in batches:
        cards = [parse_cards(x.as_buffer() if x.is_valid else b"") for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(cards, kind)], names=[*batch.schema.names[1:], "cards"])


def image_headers(spark: SparkSession, path: str, pattern: str = "*.fits") -> DataFrame:
    """path, modified, length, cards of FITS files, in one pass; cards are read to END wherever it is."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    named = files.select("content", "path", F.col("modificationTime").alias("modified"), "length")
    return named.mapInArrow(_headers, f"path string, modified timestamp, length long, cards {CARD}").select("path", "cards", "modified", "length")


def image_files(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """Paths, sizes and times of image files, ordered by path; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime").orderBy("path")


def renamed_catalogue(catalogue: DataFrame, names: dict[str, str]) -> DataFrame:
    """An extractor's catalogue under the source table's names; columns without a name are left out."""
    return catalogue.select(*(F.col(a).alias(b) for a, b in names.items() if a in catalogue.columns))


def xml_table(spark: SparkSession, path: str, row_tag: str = "TR") -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int = 64, **options: str) -> DataFrame:
    """A database table read by ranges of a number column, so that many tasks share the read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options).load()
