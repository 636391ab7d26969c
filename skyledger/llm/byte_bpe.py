"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary resolves pre-tokens that are vocabulary entries as a whole
(no merge order can give a different result: such a pre-token ends as that one token). Second tier: the bytes of
any other pre-token are a linked list, and a heap of adjacent pairs by rank gives the next merge; n bytes take
n log n steps, so a very long run of letters is no problem. Distinct pre-tokens are looked up once in a chunk.

Results for special input: a null text counts as the empty text and gives no ids; repeated rows each give a row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import column, table, text_of
from skyledger.llm.pretoken import CachedEncoder, Splitter, mixed

RANKS = "byte_bpe_50k.tiktoken"
OUTPUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash of 64-bit keys: buckets, largest first, get a displacement under which all their keys
    fall on free slots; buckets of one key name their slot outright."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.size, self.buckets = max(1, n), max(1, n // 4)
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(self.size, bool)
        where = (keys >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(where, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if n else []
        groups.sort(key=len, reverse=True)
        lone = [g for g in groups if len(g) == 1]
        tries = np.arange(256, dtype=np.uint64)
        for g in groups[: len(groups) - len(lone)]:
            base = np.uint64(0)
            while True:
                slots = self._slot(keys[g][None, :], tries[:, None] + base)
                good = ~taken[slots].any(axis=1)
                good &= (np.diff(np.sort(slots, axis=1), axis=1) != 0).all(axis=1)
                if good.any():
                    k = int(good.argmax())
                    self.shift[int(where[g[0]])] = int(base) + k
                    taken[slots[k]] = True
                    break
                base += np.uint64(256)
        for g, free in zip(lone, np.flatnonzero(~taken), strict=False):
            self.shift[int(where[g[0]])] = -int(free) - 1

    def _slot(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mixed(keys ^ (shift * np.uint64(0xD6E8FEB86659FD93))) % np.uint64(self.size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        shift = self.shift[((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -shift - 1, self._slot(keys, np.maximum(shift, 0).astype(np.uint64)))


class ByteBPE:
    """Encoder and decoder for a vocabulary given as ranks of byte strings; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        #: Rank of what two adjacent tokens merge to.
        self.pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    self.pairs[a << 24 | b] = rank
        words = []
        for token in ranks:
            try:
                if token:
                    words.append(token.decode())
            except UnicodeDecodeError:
                pass  # no pre-token is a part of a character
        splitter = Splitter()
        hashes = self._hashes(splitter, words)
        self.perfect = PerfectHash(hashes)
        slots = self.perfect.slots(hashes)
        self.keys, self.ids = np.zeros(self.perfect.size, np.uint64), np.full(self.perfect.size, -1, np.int64)
        self.keys[slots], self.ids[slots] = hashes, [ranks[w.encode()] for w in words]
        self.words = {ranks[w.encode()]: w for w in words}
        self.encoder = CachedEncoder(lambda token: self.merge(token.encode()), self.known)

    @staticmethod
    def _hashes(splitter: Splitter, words: list[str]) -> np.ndarray:
        """The hash of each whole word, as the splitter gives it for a pre-token."""
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        splitter._powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(splitter.noise[codes] * splitter.power[: len(codes)], out=sums[1:])
        stops = np.cumsum(sizes)
        begins = stops - sizes
        return mixed((sums[stops] - sums[begins]) * splitter.inverse[begins] + sizes.astype(np.uint64))

    def known(self, hashes: np.ndarray, tokens: list[str]) -> np.ndarray:
        """First tier: the id of each pre-token that is in the vocabulary, -1 for others."""
        slots = self.perfect.slots(hashes)
        ids = np.where(self.keys[slots] == hashes, self.ids[slots], -1)
        for k in np.flatnonzero(ids >= 0).tolist():
            if self.words[int(ids[k])] != tokens[k]:  # equal hashes of different words
                ids[k] = -1
        return ids

    def merge(self, word: bytes) -> list[int]:
        """Second tier: merge the pair of lowest rank, the leftmost of equals, until no pair is in the vocabulary."""
        ids = [self.single[b] for b in word]
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for k in range(n - 1):
            rank = pairs.get(ids[k] << 24 | ids[k + 1])
            if rank is not None:
                heap.append(rank << 32 | k)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            k, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[k]
            if ids[k] < 0 or j >= n or pairs.get(ids[k] << 24 | ids[j]) != rank:
                continue  # a neighbour has been merged meanwhile
            ids[k], ids[j] = rank, -1
            j = after[k] = after[j]
            if j < n:
                before[j] = k
                found = pairs.get(rank << 24 | ids[j])
                if found is not None:
                    heappush(heap, found << 32 | k)
            i = before[k]
            if i >= 0:
                found = pairs.get(ids[i] << 24 | rank)
                if found is not None:
                    heappush(heap, found << 32 | i)
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        return self.encoder.texts(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


_MADE: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    """The tokenizer of a rank file, made once in a Python process."""
    if path not in _MADE:
        _MADE[path] = ByteBPE(load_ranks(path))
    return _MADE[path]


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            sizes, coded, decoded = [], [], []
            for ids in bpe.encode(batch.column(1).to_pylist()):
                sizes.append(len(ids))
                coded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            arrays = [pa.array(x.astype(np.int32), pa.int32()) for x in bpe.encode(batch.column(1).to_pylist())]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
            values = pa.concat_arrays(arrays) if arrays else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["doc_id", "ids"])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = [b"".join(map(bpe.vocabulary.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    return _rows(docs, id_col, text_col).mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and decoded (binary) of every list of ids; null gives empty bytes."""
    return coded.select(column(id_col).cast("long").alias("doc_id"), column(ids_col).cast("array<int>").alias("ids")).mapInArrow(_decoded(path), "doc_id long, decoded binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes they decode to."""
    return _rows(docs, id_col, text_col).mapInArrow(_digests(path), OUTPUT)


def default_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_path())
