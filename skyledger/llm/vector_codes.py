"""Vector code compression: product codes whose codebooks are fitted by Lloyd rounds with heaps of slacks.

A vector is cut into equal consecutive parts; each part position has a codebook, and a vector's code names the nearest
entry for each part. All arithmetic is on whole numbers, so results don't depend on how the table is dealt out.

Vectors are packed once into blocks, rows of a table in the shared folder. A block keeps, for each part position and entry,
a heap of the parts assigned to it, ordered by their slack: the distance to the second nearest entry (lower bound) less that
to their own (upper bound). When entries move, neither bound is touched: the entry's own drift and the largest drift of any
other add up in one number for each entry, and only parts whose slack this sum has used up are popped and scanned
again, exactly (slacks carry a margin above rounding errors, so a tie is always scanned). A round is a map over blocks that
writes their next state, then a sum of what the parts that changed their entry have added and taken away; the driver gets
one number for each component of the codebooks. A lost executor's blocks are read again from the state before.

Results for special input: rows whose vector is null or has a null or non-finite component are dropped; vectors shorter than
the longest count as padded with zeros, and so does a length that the parts don't divide; fewer vectors than entries make
smaller codebooks; of rows with equal ids the one with the lesser vector comes first among the first entries, and null ids
come last; components too large for exact products of doubles are computed with Python's integers and without bounds (an error beyond a long is
the largest long); an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm._common import BROADCAST_ROWS, column, forget, scratch, table, written

#: Production parameters.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components of a block.
BLOCK_VALUES = 1 << 20
#: Parts that are compared with all entries at once.
CHUNK = 4096
LARGEST = (1 << 63) - 1
#: Rows from which a label has its total sent to every task where there are too many labels to send all.
HOT_ROWS = 100_000


class Books(NamedTuple):
    """entries: whole numbers by part, entry, position; used: for each part and entry the drift so far that a slack must exceed;
    exact: doubles are exact on these vectors."""

    entries: np.ndarray
    used: np.ndarray
    exact: bool


class Codes(NamedTuple):
    """rows: (id, label, code, error) for each kept vector; entries: the final codebooks."""

    rows: DataFrame
    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers."""
    return np.array([int(v) * scale if abs(v) >= 1 << 53 else math.floor(v * scale) for v in x.reshape(-1).tolist()], object).reshape(x.shape)


def _pack(scale: int, block_values: int):
    """Arrow batches of (id, label, vector) to blocks (n, width, top, keys, data): data are 16- or 32-bit whole numbers if all fit
    (top, the largest amount, says so), else the doubles."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, n = batch.column("vector"), len(batch)
        sizes = np.diff(vectors.offsets.to_numpy())
        width = int(sizes.max())
        x = np.zeros((n, width))
        x[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        top = float(np.abs(x).max(initial=0)) * scale + 1
        if top < 1 << 31:
            x = np.floor(x * scale).astype("<i2" if top < 1 << 15 else "<i4")
        keys = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.StructArray.from_arrays([batch.column("id"), batch.column("label")], ["id", "label"]))
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([width], pa.int32()), pa.array([top]), keys, pa.array([x.tobytes()])], ["n", "width", "top", "keys", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, values = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                step = max(1, block_values // max(1, len(batch.column("vector")[at])))
                waiting.append(batch.slice(at, step))
                values += len(waiting[-1].column("vector").flatten())
                at += step
                if values >= block_values:
                    yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, values = [], 0
        if waiting:
            yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return run


def _values(row: dict, scale: int, books: Books) -> np.ndarray:
    """A block's whole numbers by part, vector, position: doubles if these are exact, else Python integers."""
    parts, _, each = books.entries.shape
    n, width, top = row["n"], row["width"], row["top"]
    x = np.frombuffer(row["data"], "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8").reshape(n, width)
    if not books.exact:
        x = x.astype(object) if top < 1 << 31 else _whole(x, scale)
    out = np.zeros((n, parts * each), x.dtype if not books.exact else np.float64)
    out[:, :width] = x
    return np.ascontiguousarray(out.reshape(n, parts, each).transpose(1, 0, 2))


def _nearest(x: np.ndarray, book: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower) and slack of each row of `x`."""
    to, slack = np.zeros(len(x), np.int64), np.full(len(x), -np.inf)
    step = CHUNK if exact else 64
    for at in range(0, len(x), step):
        v = x[at : at + step]
        if not exact:
            to[at : at + step] = np.argmin(((v[:, None, :] - book[None]) ** 2).sum(-1), 1) if v.shape[1] else 0
            continue
        b = book.astype(np.float64)
        d = (v * v).sum(1)[:, None] - 2 * (v @ b.T) + (b * b).sum(1)
        own = np.argmin(d, 1)
        upper = np.sqrt(d[np.arange(len(v)), own])
        d[np.arange(len(v)), own] = np.inf
        lower = np.sqrt(d.min(1))
        to[at : at + step] = own
        slack[at : at + step] = np.where(np.isinf(lower), np.inf, lower - upper - 1e-9 * (np.where(np.isinf(lower), 0, lower) + upper + 1))
    return to, slack


def _assigned(row: dict, x: np.ndarray, books: Books) -> tuple[np.ndarray, list[list[list]], list[np.ndarray]]:
    """A block's parts after entries have moved: entry of each by part, heaps by part and entry, and which were given another."""
    parts, entries, _ = books.entries.shape
    n = len(x[0])
    new = row.get("own") is None
    own = np.zeros((parts, n), np.int64) if new else np.frombuffer(row["own"], np.uint16).reshape(parts, n).astype(np.int64)
    if not new:
        order, slack, ends = (np.frombuffer(row[k], t).reshape(parts, -1) for k, t in (("heap", "<i4"), ("slack", "<f8"), ("ends", "<i4")))
    all_heaps, moved = [], []
    for p in range(parts):
        used = books.used[p].tolist()
        if new:
            heaps, popped = [[] for _ in range(entries)], list(range(n))
        else:
            pairs, bounds = list(zip(slack[p].tolist(), order[p].tolist())), [0, *ends[p].tolist()]
            heaps, popped = [pairs[a:b] for a, b in zip(bounds, bounds[1:])], []
            for heap, gone in zip(heaps, used):
                while heap and heap[0][0] <= gone:
                    popped.append(heapq.heappop(heap)[1])
        at = np.array(popped, np.int64)
        to, left = _nearest(x[p][at], books.entries[p], books.exact)
        for k, (i, e, s) in enumerate(zip(popped, to.tolist(), (left + books.used[p][to]).tolist())):
            heapq.heappush(heaps[e], (s, i))
        changed = at[(to != own[p][at]) | new]
        was = own[p].copy()
        own[p][at] = to
        all_heaps.append(heaps)
        moved.append(np.stack([changed, np.full(len(changed), -1) if new else was[changed]]))
    return own, all_heaps, moved


def _round(books: Books, scale: int, names: list[str]):
    """Blocks to their next state. `sums` are (slot, change) of what the parts that changed their entry make in counts and sums."""
    parts, entries, each = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "keys"}
                x = _values(row, scale, books)
                own, heaps, moved = _assigned(row, x, books)
                total = np.zeros((parts, entries, each + 1), np.int64 if books.exact else object)
                for p, (at, was) in enumerate(moved):
                    v = np.concatenate([np.ones((len(at), 1), total.dtype), x[p][at].astype(total.dtype)], 1)
                    np.add.at(total[p], own[p][at], v)
                    np.subtract.at(total[p], was[was >= 0], v[was >= 0])
                flat = total.reshape(-1)
                slots = np.flatnonzero(flat != 0)
                sums = pa.StructArray.from_arrays([pa.array(slots, pa.int32()), pa.array(list(map(str, flat[slots].tolist())), pa.string())], ["slot", "change"])
                state = {
                    "own": own.astype(np.uint16).tobytes(), "heap": np.array([i for part in heaps for h in part for _, i in h], "<i4").tobytes(), "slack": np.array([s for part in heaps for h in part for s, _ in h], "<f8").tobytes(),
                    "ends": np.array([np.cumsum([len(h) for h in part]) for part in heaps], "<i4").tobytes(),
                }
                out = {"keys": batch.column("keys").slice(k, 1), "sums": pa.ListArray.from_arrays(pa.array([0, len(slots)], pa.int32()), sums)}
                yield pa.RecordBatch.from_arrays([out[c] if c in out else pa.array([state.get(c, row.get(c))]).cast({"n": pa.int32(), "width": pa.int32(), "top": pa.float64()}.get(c, pa.binary())) for c in names], names)

    return run


def _coded(books: Books, scale: int):
    """Blocks, after a last assignment, to rows (id, label, code, error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "keys"}
                x = _values(row, scale, books)
                own, _, _ = _assigned(row, x, books)
                far = sum(((x[p] - books.entries[p][own[p]]) ** 2).sum(1) for p in range(len(x)))
                digits = [f"{e:0{2 if books.entries.shape[1] <= 256 else 4}x}" for e in range(books.entries.shape[1])]
                keys = batch.column("keys").slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [*keys.flatten(), pa.array(["".join(digits[e] for e in own[:, i].tolist()) for i in range(row["n"])], pa.string()), pa.array([min(int(e), LARGEST) for e in far.tolist()], pa.int64())], ["id", "label", "code", "error"]
                )

    return run


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"slot": group["slot"].iloc[:1], "change": [str(sum(map(int, group["change"])))]})


def fit_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block_values: int = BLOCK_VALUES) -> Codes:
    """Codebooks of `parts` x `entries` (65,536 at most) after `rounds` rounds over floor(scale * component), and every vector's code."""
    spark = vectors.sparkSession
    label = F.lit(None).cast("string") if label_col is None else column(label_col)
    kept = vectors.select(column(id_col).alias("id"), label.alias("label"), column(vector_col).cast("array<double>").alias("vector"))
    kept = kept.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    kinds = kept.schema
    keys = T.ArrayType(T.StructType([T.StructField(c, kinds[c].dataType) for c in ("id", "label")]))
    blocks = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("top", T.DoubleType()), T.StructField("keys", keys), T.StructField("data", T.BinaryType())])
    state = T.StructType([*blocks, *(T.StructField(c, T.BinaryType()) for c in ("own", "heap", "slack", "ends")), T.StructField("sums", T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("change", T.StringType())])))])
    rows = T.StructType([T.StructField("id", kinds["id"].dataType), T.StructField("label", kinds["label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch(spark, "codes")
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    packed, path = stored(kept.mapInArrow(_pack(scale, block_values), blocks))
    width, top = packed.agg(F.max("width"), F.max("top")).first()
    each = -(-(width or 0) // parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    exact = 4.0 * each * (top or 0) * (top or 0) < 1 << 53
    book = np.zeros((parts, len(first), each), np.int64 if exact else object)
    for e, r in enumerate(first):
        padded = np.zeros(parts * each)
        padded[: len(r.vector)] = r.vector
        book[:, e] = (np.floor(padded * scale) if exact else _whole(padded, scale)).reshape(parts, each).astype(book.dtype)
    if not first:
        return Codes(spark.createDataFrame([], rows), book)
    used = np.zeros(book.shape[:2])
    totals = np.zeros((parts, len(first), each + 1), book.dtype)
    for _ in range(rounds):
        before = path
        packed, path = stored(packed.mapInArrow(_round(Books(book, used, exact), scale, state.names), state))
        forget(spark, before)
        changes = packed.select(F.explode("sums").alias("s")).select("s.slot", "s.change")
        sums = changes.groupBy("slot").agg(F.sum(F.col("change").cast("long")).alias("change")) if exact else changes.groupBy("slot").applyInPandas(_summed, "slot int, change string")
        for r in sums.collect():
            totals.reshape(-1)[r.slot] += int(r.change)
        counts = totals[:, :, :1]
        moved = np.where(counts > 0, totals[:, :, 1:] // np.where(counts > 0, counts, 1), book)
        if exact:
            drift = np.sqrt(((moved - book).astype(np.float64) ** 2).sum(2)) * (1 + 1e-9)
            largest = np.sort(drift, 1)
            second = largest[:, -2:-1] if len(first) > 1 else np.zeros((parts, 1))
            used = used + drift + np.where(drift == largest[:, -1:], np.where((drift == largest[:, -1:]).sum(1, keepdims=True) > 1, largest[:, -1:], second), largest[:, -1:])
        book = moved
    return Codes(packed.mapInArrow(_coded(Books(book, used, exact), scale), rows), book)


def with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` (label, error and others) with label_error, the sum over equal labels, nulls together."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.coalesce(F.try_sum("error"), F.lit(LARGEST)).alias("label_error"), F.count("*").alias("_n"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    if totals.count() <= BROADCAST_ROWS:
        return coded.join(F.broadcast(totals), same).drop("_label", "_n")
    hot = totals.where(F.col("_n") >= HOT_ROWS)
    if hot.count() > BROADCAST_ROWS:
        return coded.join(totals, same).drop("_label", "_n")
    many = coded.join(F.broadcast(hot), same).drop("_label", "_n")
    few = coded.join(F.broadcast(hot.select("_label")), same, "left_anti").join(totals.where(F.col("_n") < HOT_ROWS), same).drop("_label", "_n")
    return many.unionByName(few)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    codes = fit_codes(table(spark, sf_dir, "embeddings"))
    rows = with_label_error(written(codes.rows, "coded"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))
