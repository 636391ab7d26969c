"""Records on their way to the relational archive: precedence of sources, keys, null rules, projection to a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_DIGITS, PROCESS_DIGITS = 7, 6


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with equal key the last by `order`; one aggregation, no window."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_row")).select(key, *(F.col(f"_row.{c}").alias(c) for c in columns))


def merged(key: str, *sources: DataFrame) -> DataFrame:
    """Keys of the first source with every attribute from the latest source that has it (later ones override)."""
    out = sources[0]
    for k, source in enumerate(sources[1:]):
        shared = [c for c in source.columns if c != key and c in out.columns]
        fresh = source.withColumnsRenamed({c: f"_{k}_{c}" for c in shared})
        out = out.join(fresh, key, "left").withColumns({c: F.coalesce(f"_{k}_{c}", c) for c in shared}).drop(*(f"_{k}_{c}" for c in shared))
    return out


def resolved_keys(scans: DataFrame, plates: DataFrame, listed: DataFrame) -> DataFrame:
    """`scans` (filename, plate_id of the scan's own record or null, wfpdb_id or null) with both keys as far as they can be had.

    The wfpdb_id is the scan's own, else that of the plate's record, else the plate_id if the main list (`listed`: key) has it.
    A scan with neither key is looked for by its file's name without the extension: in the main list, where it is both keys, and among the
    plates (`plates`: plate_id, wfpdb_id), where it is the plate_id. Last, a plate without plate_id has its wfpdb_id. One
    join with the plates and one with the list, each under all the keys that may be needed."""
    from skyledger.operators.fits import checkpointed

    stem = F.regexp_replace("filename", r"(?<=.)\.[^.]*$", "")
    # Stored, so that a row's number is the same wherever it is read.
    named = checkpointed(scans.withColumns({"_stem": stem, "_n": F.monotonically_increasing_id()}))
    known = plates.groupBy("plate_id").agg(F.first("wfpdb_id", True).alias("of_plate")).select(F.col("plate_id").alias("key"), "of_plate", F.lit(True).alias("in_plates"))
    held = known.join(listed.select("key").distinct().withColumn("in_list", F.lit(True)), "key", "full_outer")
    asked = named.select("_n", F.explode(F.array(F.struct(F.lit("p").alias("kind"), F.col("plate_id").alias("key")), F.struct(F.lit("s").alias("kind"), F.col("_stem").alias("key")))).alias("_k")).select("_n", "_k.kind", "_k.key")
    found = asked.join(held, "key").groupBy("_n").agg(*(F.max(F.when(F.col("kind") == kind, F.col(c))).alias(f"_{kind}_{c}") for kind in "ps" for c in ("of_plate", "in_plates", "in_list")))
    c = F.col
    rows = named.join(found, "_n", "left")
    own = F.coalesce(c("wfpdb_id"), c("_p_of_plate"), F.when(c("_p_in_list"), c("plate_id")))
    lost = c("plate_id").isNull() & own.isNull()
    by_list = lost & F.coalesce(c("_s_in_list"), F.lit(False))
    wfpdb = F.when(by_list, c("_stem")).otherwise(own)
    plate = F.when(by_list | lost & F.coalesce(c("_s_in_plates"), F.lit(False)), c("_stem")).otherwise(F.coalesce(c("plate_id"), own))
    return rows.withColumns({"_w": wfpdb, "_p": plate}).select(*(c(x) if x not in ("plate_id", "wfpdb_id") else c("_p" if x == "plate_id" else "_w").alias(x) for x in scans.columns))


def cascaded(items: DataFrame, item: str, sources: list[tuple[DataFrame, list[str]]], fields: list[str]) -> DataFrame:
    """item, fields: each field from the last of `sources` that has it for the item.

    A source is a table (key, and some of `fields`) with the columns of `items` that hold an item's key in it, the first one that
    the table has counting alone. All sources are joined at once, under source and key, and an item's records (as many as
    candidates at most) come together once."""
    every = None
    for n, (rows, _) in enumerate(sources):
        one = rows.dropDuplicates(["key"]).select(F.lit(n).alias("source"), "key", *(F.col(f) if f in rows.columns else F.lit(None).cast("string").alias(f) for f in fields))
        every = one if every is None else every.unionByName(one)
    asked = [F.struct(F.lit(n).alias("source"), F.lit(rank).alias("rank"), F.col(c).cast("string").alias("key")) for n, (_, candidates) in enumerate(sources) for rank, c in enumerate(candidates)]
    keys = items.select(item, F.explode(F.array(*asked)).alias("_k")).select(item, "_k.source", "_k.rank", "_k.key").where("key IS NOT NULL")
    found = keys.join(every, ["source", "key"]).groupBy(item).agg(F.sort_array(F.collect_list(F.struct("source", "rank", *fields))).alias("r"))
    # In order of source and rank: of a source's records the first one counts.
    first = F.filter("r", lambda x, k: (k == 0) | (F.get("r", k - 1)["source"] != x["source"]))
    last = lambda f: F.try_element_at(F.filter("r", lambda x: x[f].isNotNull()), F.lit(-1))[f]
    return items.select(item).join(found.withColumn("r", first).select(item, *(last(f).alias(f) for f in fields)), item, "left")


def filled_from(rows: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`rows` with empty (null or blank) `columns` filled from the source row of equal key."""
    fresh = source.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    blank = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    return rows.join(fresh, key, "left").withColumns({c: F.when(blank(c), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}).drop(*(f"_{c}" for c in columns))


def resolved_ids(rows: DataFrame, plates: DataFrame) -> DataFrame:
    """plate_id of each row: its own if above 0, else that of its archive and plate number, else that of its wfpdb_id."""
    by_number = plates.groupBy("archive_id", "plate_num").agg(F.min("plate_id").alias("_by_number"))
    by_wfpdb = plates.filter("wfpdb_id IS NOT NULL").groupBy("wfpdb_id").agg(F.min("plate_id").alias("_by_wfpdb"))
    joined = rows.join(by_number, ["archive_id", "plate_num"], "left").join(by_wfpdb, "wfpdb_id", "left")
    return joined.withColumn("plate_id", F.coalesce(F.when(F.col("plate_id") > 0, F.col("plate_id")), "_by_number", "_by_wfpdb")).drop("_by_number", "_by_wfpdb")


def source_key(dr: Column, process_id: Column, source_num: Column) -> Column:
    """One number of data release, process and source number, with fixed places for each."""
    ten = lambda n: F.lit(10**n).cast("long")
    return dr.cast("long") * ten(PROCESS_DIGITS + SOURCE_DIGITS) + process_id.cast("long") * ten(SOURCE_DIGITS) + source_num.cast("long")


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def nullified(rows: DataFrame, sentinels: dict[str, float] | None = None, negative: tuple[str, ...] = ()) -> DataFrame:
    """Null for NaN and infinite numbers, for a column's sentinel value, and for negative values of some columns."""
    out = {f.name: finite(F.col(f.name)) for f in rows.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    out |= {c: F.nullif(out.get(c, F.col(c)), F.lit(v)) for c, v in (sentinels or {}).items()}
    out |= {c: F.when(F.col(c) >= 0, out.get(c, F.col(c))) for c in negative}
    return rows.withColumns(out)


def projected(rows: DataFrame, schema: T.StructType, fill: bool = False) -> DataFrame:
    """The schema's columns that `rows` has, in its order and types; booleans become numbers. With `fill` the others are null."""
    have = set(rows.columns)
    chosen = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema if fill or f.name in have]
    return rows.select(*chosen)


def valid_date(text: Column) -> Column:
    """A date from the year 1000 on; others are null."""
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(day >= F.lit("1000-01-01").cast("date"), day)


def exposure_value(values: Column, exposure: Column, time_keyword: bool = False) -> Column:
    """The value for an exposure (from 0): its own if the list is long enough, else a single value for all, but a time's isn't shared."""
    own = F.get(values, exposure)
    return F.when(F.size(values) > exposure, own) if time_keyword else F.when(F.size(values) > exposure, own).when(F.size(values) == 1, F.get(values, F.lit(0)))


def exposures(plates: DataFrame, key: str, columns: list[str], count: str = "numexp") -> DataFrame:
    """A row for each exposure of a plate, with exposure_num from 1 and the exposure's own values."""
    numbered = plates.withColumn("_n", F.explode(F.sequence(F.lit(0), F.greatest(F.col(count), F.lit(1)) - 1)))
    return numbered.select(key, (F.col("_n") + 1).alias("exposure_num"), *(exposure_value(F.col(c), F.col("_n")).alias(c) for c in columns))


def sub_exposures(rows: DataFrame, key: list[str], column: str) -> DataFrame:
    """Parts of an exposure, given as 'a|b|c', with subexposure_num from 1."""
    return rows.select(*key, F.posexplode(F.split(column, r"\|")).alias("_pos", column)).select(*key, (F.col("_pos") + 1).alias("subexposure_num"), column)


def page_links(plates: DataFrame, pages: DataFrame, plate_key: str = "plate_id", names: str = "logpages") -> DataFrame:
    """plate_id, logpage_id, logpage_order: order is the place in the plate's list, blanks and unknown names are left out."""
    listed = plates.select(plate_key, F.posexplode(names).alias("_pos", "filename")).filter("filename <> ''")
    return listed.join(pages.select("filename", "logpage_id"), "filename").select(plate_key, "logpage_id", (F.col("_pos") + 1).alias("logpage_order"))


def latest_state(events: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """For each key the last non-null value of each column, by order: a job's state from its start, updates and end."""
    at = F.struct(*order)
    return events.groupBy(key).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns))


def updated(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """`target` with the columns of `changes` where its key occurs there: an update as a join, to be written anew."""
    shared = [c for c in changes.columns if c != key]
    fresh = changes.select(key, F.lit(True).alias("_hit"), *(F.col(c).alias(f"_{c}") for c in shared))
    return target.join(fresh, key, "left").withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in shared}).drop("_hit", *(f"_{c}" for c in shared))


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, days included."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000)
