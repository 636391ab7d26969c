"""Scores of documents by masked pseudo-likelihood.

A network with a window to both sides predicts every word from the words around it, the word itself masked; a
document's score is the sum of the conditional log-probabilities of all its words. The probability of a word is that
of its class given the window, times that of its group within the class given the class and the window, both by the
network, times its share of the group, by counts. Groups are narrow: a frequent word has one of its own.

Corpus statistics cover every document: words are counted in hashed buckets whose number follows the size of the
corpus without a bound, buckets are dealt into classes of about equal counts, and the network is trained in numpy on all
documents. Documents are dealt into chunks by a hash of id and text, and chunks to rounds and trainers, as many as the corpus
needs; each trainer takes stochastic gradient steps over its own chunks, in order of the hash, from the same start, and the
networks are averaged by the number of words they have seen, in two levels of groups. So neither the network nor a score depends on
how the table lies in partitions. Groups, symbols that the network reads and rounds of averaging follow the corpus; each
document belongs to one round. Up to TABLE_BUCKETS each task gets all counts (31 MB); beyond it the counts stay in ranges of
buckets, and each chunk's own words are joined with their counts and stored in the shared folder. Both ways train the same
network, bit by bit; its scores differ by the rounding of single precision alone, which depends on the words that a
matrix product has beside a word (below 1e-8 of a score).

Results for special input: a null or empty text has no words, log-probability 0 and no mean; repeated rows each give
a row, with equal scores, as have rows of equal texts; very long texts are scored whole; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import copy
import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import column, partitions, pow2_at_least, scratch, table, text_of, written
from skyledger.llm.token_files import _map, _put
from skyledger.llm.words import chunks, hashed_words

#: Buckets, at least; so many at most are sent to every task as one table.
MIN_BUCKETS, TABLE_BUCKETS = 1 << 12, 1 << 21
WORDS_PER_BUCKET = 128
#: Words on each side that the network sees; classes it tells apart.
SIDE, CLASSES, HIDDEN = 2, 32, 24
BATCH, RATE, FINE = 4096, 0.1, 16
#: Words that a task counts at once, characters of a chunk of documents whose words are joined with their counts, and
#: characters for each trainer.
COUNTED, CHUNK_CHARS, TRAINER_CHARS = 1 << 21, 20_000_000, 32_000_000


def sizes(n: int) -> tuple[int, int, int]:
    """For n buckets: groups of a class, frequent words that the network reads as themselves (it reads the others in as
    many hashed symbols), rounds of training."""
    return round(8 * n**0.125), min(n, 4 * math.isqrt(n)), 1 + max(0, n.bit_length() - MIN_BUCKETS.bit_length()) // 4


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - n.bit_length())).astype(np.int64)


def _ranges(spark: SparkSession, n: int) -> int:
    """Ranges that buckets are counted in: as many as tasks of a shuffle."""
    return min(n, pow2_at_least(partitions(spark)))


def _merged(buckets: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets in order, and the sums of their counts."""
    found, where = np.unique(np.concatenate(buckets), return_inverse=True)
    return found, np.bincount(where, np.concatenate(counts), len(found)).astype(np.int64)


def _split(buckets: np.ndarray, n: int, ranges: int) -> Iterator[tuple[int, slice]]:
    """(range, slice of the ordered `buckets` in it) where there are any."""
    edges = np.searchsorted(buckets, np.arange(ranges + 1) * (n // ranges))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        yield k, slice(edges[k], edges[k + 1])


def _counter(n: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, waiting = [], 0
        total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                fresh.append(_buckets(hashed_words(texts)[0], n))
                waiting += len(fresh[-1])
                if waiting >= COUNTED:
                    own = np.unique(np.concatenate(fresh), return_counts=True)
                    total = _merged([total[0], own[0]], [total[1], own[1]])
                    fresh, waiting = [], 0
        if fresh:
            own = np.unique(np.concatenate(fresh), return_counts=True)
            total = _merged([total[0], own[0]], [total[1], own[1]])
        for k, own in _split(total[0], n, ranges):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[0][own].tobytes()], pa.binary()), pa.array([total[1][own].tobytes()], pa.binary())], names=["part", "buckets", "counts"])

    return run


def _range_counts(width: int):
    """All counts of a range of `width` buckets."""

    def run(keys, group):
        part = keys[0].as_py()
        total = np.zeros(width, np.int64)
        for buckets, counts in zip(group.column("buckets"), group.column("counts"), strict=True):
            total[np.frombuffer(buckets.as_buffer(), np.int64) - part * width] += np.frombuffer(counts.as_buffer(), np.int64)
        return pa.table({"part": pa.array([part], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    return run


def counted(texts: DataFrame, n: int) -> DataFrame:
    """part, counts: how often the words of each bucket occur in all of `texts` (column text), by ranges; a range
    without words has no row."""
    ranges = _ranges(texts.sparkSession, n)
    return texts.mapInArrow(_counter(n, ranges), "part int, buckets binary, counts binary").groupBy("part").applyInArrow(_range_counts(n // ranges), "part int, counts binary")


def bucket_counts(texts: DataFrame, n: int) -> np.ndarray:
    """How often the words of each bucket occur in all of `texts` (column text)."""
    out = np.zeros((_ranges(texts.sparkSession, n), n // _ranges(texts.sparkSession, n)), np.int64)
    for row in counted(texts, n).collect():
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


class Layout:
    """Group, symbol and share of a bucket by its count. Buckets stand in order of falling count, those of equal count
    in their own order, which is that of a hash; a class is an equal share of all counts in this order, and so is
    a group of a class.

    `values` are the counts that occur and `cells` how many buckets have each, `top` the first buckets."""

    def __init__(self, n: int, values: np.ndarray, cells: np.ndarray, top: np.ndarray):
        self.n, self.values = n, values
        self.subs, self.frequent, _ = sizes(n)
        self.mass = cells * (values + 1e-3)
        self.total = float(self.mass.sum())
        self.before = self.total - np.cumsum(self.mass)
        self.rank = np.argsort(top)
        self.top = top[self.rank]
        self.sums = np.zeros(CLASSES * self.subs)

    def places(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where in the order, from 0 to 1."""
        k = np.searchsorted(self.values, counts)
        return (self.before[k] + (buckets + 0.5) / self.n * self.mass[k]) / self.total

    def groups(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.clip(self.places(buckets, counts) * len(self.sums), 0, len(self.sums) - 1).astype(np.int32)

    def symbols(self, buckets: np.ndarray) -> np.ndarray:
        """Frequent words are symbols of their own, others share hashed ones; the last symbol stands beyond a text."""
        out = (self.frequent + buckets % self.frequent).astype(np.int32)
        at = np.minimum(np.searchsorted(self.top, buckets), len(self.top) - 1)
        hit = self.top[at] == buckets
        out[hit] = self.rank[at[hit]]
        return out


def _first(buckets: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` largest counts; of equal ones the first."""
    return np.argsort(-counts, kind="stable")[:most]


def _over_ranges(table: DataFrame, n: int, schema: str, f) -> DataFrame:
    """Rows of `f(buckets, counts)`, a tuple of columns, for each range of counts."""
    width = n // _ranges(table.sparkSession, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                counts = np.frombuffer(blob.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in f(part * width + np.arange(width), counts)], names=[k.split()[0] for k in schema.split(", ")])

    return table.mapInArrow(run, schema)


def _missing(table: DataFrame, n: int) -> list[int]:
    """Ranges without words."""
    return sorted(set(range(_ranges(table.sparkSession, n))) - {r["part"] for r in table.select("part").collect()})


def layout_of(table: DataFrame, n: int) -> Layout:
    """The layout by counts that stay in ranges; the driver gets one row for each count that occurs."""
    held = np.array([(r["value"], r["cells"]) for r in _over_ranges(table, n, "value long, cells long", lambda _, c: np.unique(c, return_counts=True)).groupBy("value").agg(F.sum("cells").alias("cells")).collect()], np.int64).reshape(-1, 2)
    missing = n - int(held[:, 1].sum())
    held = np.concatenate((held, [[0, missing]])) if missing else held  # ranges without words
    values, where = np.unique(held[:, 0], return_inverse=True)
    cells = np.bincount(where, held[:, 1]).astype(np.int64)
    most = sizes(n)[1]
    largest = _over_ranges(table, n, "bucket long, count long", lambda b, c: (b[k := _first(b, c, most)], c[k]))
    top = np.array([r["bucket"] for r in largest.orderBy(F.col("count").desc(), "bucket").limit(most).collect()], np.int64)
    layout = Layout(n, values, cells, top)

    def by_group(buckets, counts):
        found, where = np.unique(layout.groups(buckets, counts), return_inverse=True)
        return found, np.bincount(where, counts), np.bincount(where)

    for r in _over_ranges(table, n, "own long, count long, cells long", by_group).groupBy("own").agg(F.sum("count").alias("count"), F.sum("cells").alias("cells")).collect():
        layout.sums[r["own"]] = r["count"] + 0.5 * r["cells"]
    width = n // _ranges(table.sparkSession, n)
    for part in _missing(table, n):
        buckets = part * width + np.arange(width)
        layout.sums += 0.5 * np.bincount(layout.groups(buckets, np.zeros(len(buckets), np.int64)), minlength=len(layout.sums))
    return layout


WEIGHTS = ("embed", "out", "bias", "prior", "fine", "fine_prior")


class Network:
    """log P(word | window) = log softmax(h U + d)[class] + log softmax(h V[class] + e[class])[group] + log share of the
    group, where h = tanh(sum of window embeddings + a)."""

    #: On the driver, where counts are too many for a table in every task: these in ranges, and the documents of `fit`
    #: with their chunks and the folder of the chunks' words.
    table: DataFrame | None = None
    fitted: tuple[tuple[DataFrame, str, str], DataFrame, str] | None = None

    def __init__(self, counts: np.ndarray | None, layout: Layout | None = None, seed: int = 7):
        self.buckets = None
        if counts is not None:
            buckets = np.arange(len(counts))
            layout = Layout(len(counts), *np.unique(counts, return_counts=True), _first(buckets, counts, sizes(len(counts))[1]))
            layout.sums = np.bincount(layout.groups(buckets, counts), counts + 0.5, len(layout.sums))
        self.layout = layout
        if counts is not None:
            self._tabulate(buckets, counts)
        dice = np.random.default_rng(seed)
        self.embed = (dice.standard_normal((2 * SIDE, 2 * layout.frequent + 1, HIDDEN), np.float32) * np.float32(0.1))
        self.out = (dice.standard_normal((HIDDEN, CLASSES)) * 0.1).astype(np.float32)
        self.bias = np.zeros(HIDDEN, np.float32)
        mass = layout.sums.reshape(CLASSES, -1)
        mass_of = mass.sum(axis=1) + 1.0
        self.prior = np.log(mass_of / mass_of.sum()).astype(np.float32)
        # A group without buckets gets no probability worth mention.
        self.fine = np.zeros((CLASSES, HIDDEN, layout.subs), np.float32)
        self.fine_prior = np.log(np.maximum(mass / mass_of[:, None], 1e-30)).astype(np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "fitted")}

    def _tabulate(self, buckets: np.ndarray, counts: np.ndarray) -> None:
        groups = self.layout.groups(buckets, counts)
        self.classes, self.subs = (groups // self.layout.subs).astype(np.uint8), (groups % self.layout.subs).astype(np.int16)
        self.symbols = self.layout.symbols(buckets)
        self.within = np.log((counts + 0.5) / self.layout.sums[groups]).astype(np.float32)
        self.share = np.log((counts + 0.5) / self.layout.sums.reshape(CLASSES, -1).sum(axis=1)[self.classes]).astype(np.float32)

    def over(self, buckets: np.ndarray, counts: np.ndarray) -> Network:
        """This network, with the same weights, and a table of the given buckets, in order, alone."""
        own = copy.copy(self)
        own.buckets = buckets
        own._tabulate(buckets, counts)
        return own

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in map(self.__dict__.get, WEIGHTS)])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for name in WEIGHTS:
            own = getattr(self, name)
            setattr(self, name, flat[at : at + own.size].reshape(own.shape).astype(np.float32))
            at += own.size

    def windows(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words' buckets in the table, and for each word the symbols around it; beyond a text's ends stands the last symbol."""
        buckets = _buckets(hashes, self.layout.n)
        if self.buckets is not None:
            buckets = np.searchsorted(self.buckets, buckets)
        ends = np.cumsum(counts)
        shift = np.repeat(np.arange(len(counts)) * SIDE + SIDE, counts)
        padded = np.full(len(buckets) + (len(counts) + 1) * SIDE, 2 * self.layout.frequent, np.int32)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + shift
        padded[place] = self.symbols[buckets]
        offsets = [*range(-SIDE, 0), *range(1, SIDE + 1)]
        return buckets, np.stack([padded[place + o] for o in offsets]) if len(buckets) else np.zeros((2 * SIDE, 0), np.int32)

    def _forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = self.embed[0][around[0]]
        for k in range(1, 2 * SIDE):
            hidden += self.embed[k][around[k]]
        hidden = np.tanh(hidden + self.bias)
        logits = hidden @ self.out + self.prior
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits

    def _by_class(self, classes: np.ndarray, hidden: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(class, places of its words, their hidden rows, logits of its groups)."""
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(CLASSES + 1)).tolist()
        for c in range(CLASSES):
            if edges[c] < edges[c + 1]:
                own = order[edges[c] : edges[c + 1]]
                rows = hidden[own]
                logits = rows @ self.fine[c]
                logits += self.fine_prior[c]
                np.minimum(logits, 60, out=logits)  # for exp
                yield c, own, rows, logits

    def log_probabilities(self, buckets: np.ndarray, around: np.ndarray) -> np.ndarray:
        found = np.empty(len(buckets), np.float32)
        for a in range(0, len(buckets), 4 * BATCH):
            own = buckets[a : a + 4 * BATCH]
            classes, subs = self.classes[own], self.subs[own]
            hidden, logits = self._forward(around[:, a : a + 4 * BATCH])
            part = logits[np.arange(len(own)), classes] + self.within[own]
            part -= np.log(np.exp(logits, out=logits).sum(axis=1))
            for _, at, _, logits in self._by_class(classes, hidden):
                picked = logits[np.arange(len(at)), subs[at]]
                part[at] += picked - np.log(np.exp(logits, out=logits).sum(axis=1))
            found[a : a + 4 * BATCH] = part
        return found

    def train(self, buckets: np.ndarray, around: np.ndarray, rate: float) -> None:
        """A gradient step on each batch of words."""
        for a in range(0, len(buckets), BATCH):
            seen = around[:, a : a + BATCH]
            classes, subs = self.classes[buckets[a : a + BATCH]], self.subs[buckets[a : a + BATCH]]
            hidden, logits = self._forward(seen)
            n = len(logits)
            step = rate * min(1.0, n / BATCH) / n
            np.exp(logits, out=logits)
            logits /= logits.sum(axis=1, keepdims=True)
            logits[np.arange(n), classes] -= 1
            back = logits @ self.out.T
            self.out -= step * 4 * (hidden.T @ logits)
            self.prior -= step * logits.sum(axis=0)
            # A class has few of a batch's words, so its groups take longer steps.
            for c, at, rows, fine in self._by_class(classes, hidden):
                np.exp(fine, out=fine)
                fine /= fine.sum(axis=1, keepdims=True)
                fine[np.arange(len(at)), subs[at]] -= 1
                back[at] += fine @ self.fine[c].T
                self.fine[c] -= step * 4 * FINE * (rows.T @ fine)
                self.fine_prior[c] -= step * FINE * fine.sum(axis=0)
            back *= 1 - hidden * hidden
            self.bias -= step * back.sum(axis=0)
            back *= step * 16
            narrow = np.uint16 if 2 * self.layout.frequent < 1 << 16 else np.int32  # two bytes are sorted by radix
            for k in range(2 * SIDE):
                order = np.argsort(seen[k].astype(narrow), kind="stable")
                read = seen[k][order]
                first = np.flatnonzero(np.concatenate(([True], read[1:] != read[:-1])))
                self.embed[k][read[first]] -= np.add.reduceat(back[order], first, axis=0)


def _chunk_buckets(n: int, ranges: int):
    """The distinct buckets of each chunk, by ranges; rows of a chunk stand together."""

    def packed(chunk: int, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        # A chunk without words has a row too.
        for k, own in _split(found, n, ranges) if len(found) else [(0, slice(0))]:
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([k], pa.int32()), pa.array([found[own].tobytes()], pa.binary())], names=["chunk", "part", "buckets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found = None, []
        for batch in batches:
            at = batch.column("chunk").to_numpy()
            for own in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
                if not len(own):
                    continue
                if at[own[0]] != chunk:
                    if found:
                        yield from packed(chunk, np.unique(np.concatenate(found)))
                    chunk, found = int(at[own[0]]), []
                for _, texts in chunks(batch.column("text").slice(own[0], len(own)).to_pylist()):
                    found.append(np.unique(_buckets(hashed_words(texts)[0], n)))
        if found:
            yield from packed(chunk, np.unique(np.concatenate(found)))

    return run


def _looked_up(width: int):
    def run(keys, pieces, counts):
        part = keys[0].as_py()
        # Every bucket asked for may be one that the counted corpus lacks.
        own = np.frombuffer(counts.column("counts")[0].as_buffer(), np.int64) if counts.num_rows else np.zeros(width, np.int64)
        found = [own[np.frombuffer(b.as_buffer(), np.int64) - part * width].tobytes() for b in pieces.column("buckets")]
        return pa.table({"chunk": pieces.column("chunk"), "part": pieces.column("part"), "buckets": pieces.column("buckets"), "counts": pa.array(found, pa.binary())})

    return run


def _store(folder: str):
    """Write a chunk's buckets and counts; a task that runs again writes the same file."""

    def run(keys, words):
        words = words.sort_by("part")
        _put(f"{folder}/{keys[0].as_py()}.bin", [x.as_buffer().to_pybytes() for c in ("buckets", "counts") for x in words.column(c)])
        return words.select(["chunk"]).slice(0, 1)

    return run


def _with_words(rows: DataFrame, table: DataFrame, n: int, number: int = 0) -> tuple[DataFrame, str]:
    """`rows` (doc_id, text, turn) with a column chunk, and the folder that has the words of each chunk (of `number`, or as many as
    the texts need) with counts."""
    number = number or math.ceil((rows.agg(F.sum(F.length("text"))).first()[0] or 0) / CHUNK_CHARS) or 1
    chunked = rows.withColumn("chunk", F.pmod("turn", F.lit(number)))
    rows = written(chunked.repartition(partitions(rows.sparkSession), "chunk").sortWithinPartitions("chunk", "turn", "doc_id"), "chunks")
    ranges, folder = _ranges(rows.sparkSession, n), scratch(rows.sparkSession, "words")
    pieces = rows.select("chunk", "text").mapInArrow(_chunk_buckets(n, ranges), "chunk long, part int, buckets binary")
    words = pieces.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_looked_up(n // ranges), "chunk long, part int, buckets binary, counts binary")
    words.groupBy("chunk").applyInArrow(_store(folder), "chunk long").count()
    return rows, folder


def _by_chunk(batches: Iterator[pa.RecordBatch], network: Network, folder: str | None) -> Iterator[tuple[Network, pa.RecordBatch]]:
    """(network with the table for these rows, rows), by chunks where rows have one."""
    chunk, own = None, network
    for batch in batches:
        if "chunk" not in batch.schema.names:
            yield network, batch
            continue
        at = batch.column("chunk").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1, [len(at)])).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a < b:
                if folder is not None and at[a] != chunk:
                    chunk = at[a]
                    own = network.over(*np.asarray(_map(f"{folder}/{chunk}.bin", "<i8")).reshape(2, -1))
                yield own, batch.slice(a, b - a)


def _one_thread() -> None:
    """Keep this worker's matrix products on one thread: a task has one core, and idle threads of the library spin."""
    try:
        with open("/proc/self/maps") as maps:
            found = {line.split()[-1] for line in maps if "openblas" in line}
    except OSError:
        return
    for library in map(ctypes.CDLL, found):
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


SUMS = "part int, task int, sums binary"


def _trainer(start: Network, groups: int, folder: str | None):
    """Weights after a pass over a task's texts, times the number of words, and that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        network, seen, steps = copy.deepcopy(start), 0, 0
        for own, batch in _by_chunk(batches, network, folder):
            for _, texts in chunks(batch.column("text").to_pylist()):
                hashes, counts = hashed_words(texts)
                own.train(*own.windows(hashes, counts), RATE / math.sqrt(1 + steps / 200))
                seen, steps = seen + len(hashes), steps + math.ceil(len(hashes) / BATCH)
        if seen:
            part = TaskContext.get().partitionId()
            blob = np.append(network.weights() * np.float32(seen), np.float32(seen)).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part % groups], pa.int32()), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names=["part", "task", "sums"])

    return run


def _sized(size: int) -> int:
    """Buckets for so many characters, of about six a word."""
    return max(MIN_BUCKETS, pow2_at_least(size // (6 * WORDS_PER_BUCKET)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, turn (a hash of both that deals rows out)."""
    rows = docs.select((column(id_col).cast("long") if id_col in docs.columns else F.lit(None).cast("long")).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.withColumn("turn", F.xxhash64("doc_id", "text"))


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Network:
    """A network trained on every text of `docs`."""
    rows = _rows(docs, id_col, text_col)
    texts = rows.select("text")
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n, folder = _sized(size), None
    rounds = sizes(n)[2]
    trainers = math.ceil(size / rounds / TRAINER_CHARS) or 1
    hands = rounds * trainers
    number = hands * (math.ceil(size / hands / CHUNK_CHARS) or 1)
    if n <= TABLE_BUCKETS:
        network = Network(bucket_counts(texts, n))
    else:
        table = written(counted(texts, n), "counts")
        network = Network(None, layout_of(table, n))
        network.table = table
        rows, folder = _with_words(rows, table, n, number)
        network.fitted = (docs, id_col, text_col), rows, folder
    if folder is None:
        rows = rows.withColumn("chunk", F.pmod("turn", F.lit(number)))
    own_of = F.col("chunk") % hands
    for k in range(rounds):
        own = rows.filter(own_of % rounds == k).repartitionById(trainers, F.floor(own_of / rounds).cast("int")).sortWithinPartitions("chunk", "turn", "doc_id", "text")
        groups = math.isqrt(max(trainers, partitions(docs.sparkSession)))
        trained = own.select("chunk", "text").mapInArrow(_trainer(network, groups, folder), SUMS)
        by_group = trained.groupBy("part").applyInArrow(_ordered_sum, "part int, sums binary").select(F.lit(0).alias("part"), F.col("part").alias("task"), "sums")
        for row in by_group.groupBy("part").applyInArrow(_ordered_sum, "part int, sums binary").collect():
            total = np.frombuffer(row["sums"], "<f4").astype(np.float64)
            network.set_weights(total[:-1] / total[-1])
    return network


def _ordered_sum(keys, group):
    """Sums in order of task, in double precision, so that a rerun gives the same network: networks, or sums of networks."""
    group = group.sort_by("task")
    total: np.ndarray | None = None
    for blob in group.column("sums"):
        data = np.frombuffer(blob.as_buffer(), "<f4")
        total = data.astype(np.float64) if total is None else total + data
    return pa.table({"part": pa.array([keys[0].as_py()], pa.int32()), "sums": pa.array([total.astype("<f4").tobytes()], pa.binary())})


SCORES = "doc_id long, n_words long, log_prob double, mean_log_prob double"


def _scores(network: Network, ids: pa.Array, rows: list[str]) -> pa.RecordBatch:
    n = np.zeros(len(rows), np.int64)
    total = np.zeros(len(rows))
    for first, texts in chunks(rows):
        hashes, counts = hashed_words(texts)
        found = network.log_probabilities(*network.windows(hashes, counts)).astype(np.float64)
        some = np.flatnonzero(counts)
        n[first : first + len(texts)] = counts
        if len(some):
            total[first + some] = np.add.reduceat(found, (np.cumsum(counts) - counts)[some])
    mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(total, pa.float64()), pa.array(mean, pa.float64(), mask=n == 0)], names=["doc_id", "n_words", "log_prob", "mean_log_prob"])


def _scorer(network: Network, folder: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _one_thread()
        for own, batch in _by_chunk(batches, network, folder):
            yield _scores(own, batch.column("doc_id"), batch.column("text").to_pylist())

    return run


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_prob (sum over all words) and mean_log_prob of every text."""
    rows, folder = _rows(docs, id_col, text_col), None
    if network.table is not None:
        rows, folder = network.fitted[1:] if network.fitted[0][0] is docs and network.fitted[0][1:] == (id_col, text_col) else _with_words(rows, network.table, network.layout.n)
    return rows.select("doc_id", "text", *(("chunk",) if folder else ())).mapInArrow(_scorer(network, folder), SCORES)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs))
