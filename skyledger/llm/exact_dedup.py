"""Exact deduplication by counting quotient filters with byte verification.

Each partition of the input counts the 64-bit fingerprints of its normalised texts in a counting quotient
filter: the high bits of a fingerprint (quotient) say where it belongs, the low bits (remainder) are stored in
sorted order, and a counter goes with each remainder. Filters of the same quotient range merge without loss by
merging their sorted remainders and adding counters, so a text with many copies costs one entry per partition.
Only fingerprints whose merged count is above one are passed on; their texts are then compared byte for byte.

Results for special input: a null text counts as the empty text; repeated rows (same id, same text) each give a
result row and exactly one of them stays; a null id sorts last, and stays only if its whole group has null ids;
an empty table gives an empty result; a very long text is one value like any other; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import BROADCAST_ROWS, SPACES, column, partitions, pow2_at_least, table, unused, written


#: Copies of a text that meet their group's row in one task.
SALT_ROWS = 100_000


def normalised(text: Column) -> Column:
    """Runs of white space become one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


class CountingQuotientFilter:
    """A compact, static counting quotient filter over fingerprints of `width` bits.

    The leading qbits of a fingerprint are its quotient. `occupied` has a bit for each quotient, `runend` a bit for each
    stored remainder that ends its quotient's run; remainders are sorted within their run and take as many bytes as their
    bits need. Together they restore every fingerprint, so nothing is lost.
    """

    def __init__(self, width: int, qbits: int, occupied: np.ndarray, runend: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.width, self.qbits, self.occupied, self.runend, self.remainders, self.counts = width, qbits, occupied, runend, remainders, counts

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray, width: int = 64) -> CountingQuotientFilter:
        """From distinct fingerprints in ascending order (unsigned) with their counts."""
        n = len(fingerprints)
        qbits = min(max(1, int(n).bit_length()), width - 1)
        shift = np.uint64(width - qbits)
        quotients = (fingerprints >> shift).astype(np.int64)
        occupied = np.zeros(1 << qbits, dtype=bool)
        occupied[quotients] = True
        runend = np.ones(n, dtype=bool)
        runend[:-1] = quotients[1:] != quotients[:-1]
        return cls(width, qbits, occupied, runend, fingerprints & ((np.uint64(1) << shift) - np.uint64(1)), counts.astype(np.uint64))

    def fingerprints(self) -> np.ndarray:
        """All fingerprints, ascending."""
        quotients = np.flatnonzero(self.occupied)
        run = np.concatenate(([0], np.cumsum(self.runend)[:-1])) if len(self.runend) else np.zeros(0, dtype=np.int64)
        return (quotients[run.astype(np.int64)].astype(np.uint64) << np.uint64(self.width - self.qbits)) | self.remainders

    def to_bytes(self) -> bytes:
        n, each = len(self.remainders), self.width - self.qbits + 7 >> 3
        few = 1 if n and int(self.counts.max()) < 256 else 8
        head = np.array([self.width, self.qbits, n, few], dtype="<i8").tobytes()
        packed = self.remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :each].tobytes()
        return head + np.packbits(self.occupied).tobytes() + np.packbits(self.runend).tobytes() + packed + self.counts.astype(f"<u{few}").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CountingQuotientFilter:
        width, qbits, n, few = (int(x) for x in np.frombuffer(blob, "<i8", 4))
        at, each = 32, width - qbits + 7 >> 3
        size = (1 << qbits) + 7 >> 3
        occupied = np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=1 << qbits).astype(bool)
        at += size
        runend = np.unpackbits(np.frombuffer(blob, np.uint8, n + 7 >> 3, at), count=n).astype(bool)
        at += n + 7 >> 3
        remainders = np.zeros((n, 8), np.uint8)
        remainders[:, :each] = np.frombuffer(blob, np.uint8, n * each, at).reshape(n, each)
        return cls(width, qbits, occupied, runend, remainders.reshape(-1).view("<u8"), np.frombuffer(blob, f"<u{few}", n, at + n * each).astype(np.uint64))

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """One filter with the fingerprints of both and the sums of their counters: a merge of two sorted sequences."""
        a, b = self.fingerprints(), other.fingerprints()
        at = np.searchsorted(a, b)
        old = at < len(a)
        old[old] = a[at[old]] == b[old]
        counts = self.counts.copy()
        counts[at[old]] += other.counts[old]
        return self.of_sorted(np.insert(a, at[~old], b[~old]), np.insert(counts, at[~old], other.counts[~old]), self.width)

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """All filters as one, merged in pairs."""
        while len(filters) > 1:
            filters = [filters[k].merge(filters[k + 1]) if k + 1 < len(filters) else filters[k] for k in range(0, len(filters), 2)]
        return filters[0]


def _filters(ranges: int):
    """Count a partition's fingerprints; one filter for each range of the leading bits that occurs."""
    bits = ranges.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def absorb() -> None:
            nonlocal keys, counts, waiting, n
            fresh, times = np.unique(np.concatenate(waiting), return_counts=True)
            both, where = np.unique(np.concatenate((keys, fresh)), return_inverse=True)
            keys, counts = both, np.bincount(where, np.concatenate((counts, times)), len(both)).astype(np.int64)
            waiting, n = [], 0

        for batch in batches:
            waiting.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            n += len(waiting[-1])
            if n > 1 << 20:
                absorb()
        if waiting:
            absorb()
        where = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        for part in np.unique(where):
            own = where == part
            blob = CountingQuotientFilter.of_sorted(keys[own] & np.uint64((1 << 64 - bits) - 1), counts[own], 64 - bits).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([int(part)], pa.int32()), pa.array([blob], pa.binary())], names=["part", "filter"])

    return run


def _merge_filters(key, group):
    """The fingerprints of one range that occur more than once in all partitions together, with their counts."""
    whole = CountingQuotientFilter.merged([CountingQuotientFilter.from_bytes(x.as_py()) for x in group.column("filter")])
    many = whole.counts > 1
    found = whole.fingerprints()[many]
    if whole.width < 64:
        found |= np.uint64(key[0].as_py()) << np.uint64(whole.width)
    return pa.table({"fp": pa.array(found.view(np.int64), pa.int64()), "met": pa.array(whole.counts[many].astype(np.int64), pa.int64())})


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Distinct values of the one long column of `fingerprints` that occur at least twice, as column `fp`, and their counts, `met`.

    The number of ranges follows the number of shuffle partitions, so a task merges a bounded share of all keys.
    """
    ranges = pow2_at_least(partitions(fingerprints.sparkSession))
    return fingerprints.mapInArrow(_filters(ranges), "part int, filter binary").groupBy("part").applyInArrow(_merge_filters, "fp long, met long")


def _hot(fingerprints: DataFrame) -> DataFrame:
    hot = written(repeated_fingerprints(fingerprints), "repeated")
    # Longs only; beyond the bound both sides are shuffled instead.
    return F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), normalised(column(text_col)).alias("norm"))
    rows = rows.withColumn("fp", F.xxhash64("norm"))
    few = _hot(rows.select("fp"))
    single = rows.join(few, "fp", "left_anti").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.sha2("norm", 256).alias("text_sha256"))
    # Byte verification: grouping by id and text spreads the copies of a hot text over all tasks; the second
    # grouping combines within tasks before its shuffle, so a hot text sends one row per task.
    copies = written(rows.join(few, "fp").groupBy("doc_id", "norm").agg(F.count(F.lit(1)).alias("times"), F.max("met").alias("met")), "copies")
    # The copies of a hot text meet their group in several tasks: by a salt of the id, out of one for each SALT_ROWS copies.
    salts = F.ceil(F.col("met") / SALT_ROWS)
    groups = copies.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.sum("times").alias("group_size"), F.max("met").alias("met"))
    groups = groups.select(F.sha2("norm", 256).alias("text_sha256"), F.col("norm").alias("kept_text"), "keep_id", "group_size", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    members = copies.select("doc_id", "norm", "times", F.sha2("norm", 256).alias("text_sha256"), F.pmod(F.xxhash64("doc_id"), salts).alias("salt")).join(groups, ["text_sha256", "salt"]).filter(F.col("norm") == F.col("kept_text"))
    repeated = members.select("doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"), "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"
    )
    return single.unionByName(repeated)


def one_of_each(rows: DataFrame, keys: list[str], id_col: str, columns: list[str]) -> DataFrame:
    """Of the rows of each value of `keys` one, whole: that of the smallest id (null last); of rows of one id that of the
    smallest digest of all columns. Partial aggregation leaves one row per task of a hot group."""
    whole = F.struct(*(column(c) for c in columns))
    order = F.struct(column(id_col).isNull().alias("unnamed"), column(id_col).alias("name"), F.xxhash64(F.to_json(whole)).alias("digest"))
    return rows.groupBy(*keys).agg(F.min_by(whole, order).alias("whole")).select(*(F.col("whole").getField(c).alias(c) for c in columns))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, that of the smallest id.

    The rows of repeated fingerprints carry all their columns through the grouping by text; no row is looked up by its id.
    A null text is the empty text; a null id comes after all others; of repeated rows one stays; an empty table stays
    empty; other columns may have any names. The input is read three times.
    """
    norm, fp = unused(docs.columns, "norm"), unused(docs.columns, "fp")
    rows = docs.withColumn(norm, normalised(column(text_col)))
    rows = rows.withColumn(fp, F.xxhash64(column(norm)))
    few = _hot(rows.select(column(fp).alias("fp"))).select(F.col("fp").alias(fp))
    single = rows.join(few, fp, "left_anti").select(*map(column, docs.columns))
    return single.unionByName(one_of_each(rows.join(few, fp, "left_semi"), [norm], id_col, docs.columns))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
