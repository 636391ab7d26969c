"""Token ids as flat binary files with document offsets.

Documents are dealt into ranges of ascending id; each task encodes its documents in order and writes a shard:

    shard-<k>.bin   ids as little-endian unsigned integers, 16 bits if the vocabulary allows it, else 32
    shard-<k>.idx   n + 1 little-endian 64-bit offsets, in ids, from the shard's start
    shard-<k>.doc   n little-endian 64-bit document ids

and a manifest row. A shard's base (the ids in all shards before it) is a prefix sum over the manifest. Readers map
the files into memory and touch the documents they want. A task that runs again writes the same names with the
same bytes, each written under a temporary name and put in place by a rename, so lost executors and duplicate attempts do
no harm.

Results for special input: a null text counts as the empty text and has the end id alone; a null id comes first and
is stored as the smallest 64-bit integer; repeated ids are ordered by text; a very long text is a document like any other;
an empty table has no shards; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm._common import column, partitions, scratch, table, text_of, written
from skyledger.llm.pretoken import CachedEncoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
NULL_ID = -(1 << 63)
MANIFEST = "shard int, path string, docs long, ids long, width int"


class LibraryEncoder:
    """Ids by the tokenizers library. Where the file's pre-tokenizer is plain byte-level BPE, the library's model gets
    each distinct pre-token once, and texts that hold an added token go through the library; else all texts do."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as text:
            parts = json.load(text)
        pre = parts.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not parts.get("normalizer") and parts["model"]["type"] == "BPE"
        self.added = [t["content"] for t in parts.get("added_tokens") or [] if t["content"]]
        self.cached = CachedEncoder(self._piece) if plain else None
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for code points from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {**{b: b for b in shown}, **{b: 256 + k for k, b in enumerate(rest)}}

    def _piece(self, token: str) -> list[int]:
        return [t.id for t in self.library.model.tokenize(token.encode().decode("latin-1").translate(self.alphabet))]

    def _whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        return (np.array(x.ids, "<u4") for x in self.library.encode_batch(texts, add_special_tokens=False))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if self.cached is None:
            yield from self._whole(texts)
            return
        marked = [any(a in t for a in self.added) for t in texts]
        plain = self.cached.texts([t for t, m in zip(texts, marked, strict=True) if not m])
        whole = self._whole([t for t, m in zip(texts, marked, strict=True) if m])
        for m in marked:
            yield next(whole if m else plain)


_MADE: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _MADE:
        _MADE[path] = LibraryEncoder(path)
    return _MADE[path]


def _local(path: str) -> str | None:
    """The path for open() where the shared folder is a mounted one."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


@contextmanager
def _output(path: str) -> Iterator[Callable[[bytes], object]]:
    """A writer to a file that appears under its name when all is written: each attempt has a temporary file of its own."""
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(own), "wb") as out:
            yield out.write
        os.replace(_local(own), local)
        return
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    other = fs.FileSystem.from_uri(own)[1]
    store.create_dir(place.rpartition("/")[0])
    with store.open_output_stream(other) as out:
        yield out.write
    store.move(other, place)


def _put(path: str, parts: list[bytes]) -> None:
    with _output(path) as write:
        for part in parts:
            write(part)


def _map(path: str, kind: str) -> np.ndarray:
    if local := _local(path):
        return np.memmap(local, kind, "r") if os.path.getsize(local) else np.zeros(0, kind)
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_file(place) as data:
        return np.frombuffer(data.read(), kind)


def _writer(folder: str, tokenizer: str, end_id: int, width: int):
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        end = np.array([end_id], kind).tobytes()
        first = next(batches, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}"
        sizes, names = array("q"), array("q")
        # Ids go to the file as they come; a task holds a batch, and 16 bytes for each document.
        with _output(f"{path}.bin") as write:
            for batch in chain((first,), batches):
                names.frombytes(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for ids in encoder.encode(batch.column(1).to_pylist()):
                    write(ids.astype(kind).tobytes())
                    write(end)
                    sizes.append(len(ids) + 1)
        if not sizes:
            return
        _put(f"{path}.idx", [np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int64)))).astype("<i8").tobytes()])
        _put(f"{path}.doc", [names.tobytes()])
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "docs": pa.array([len(sizes)], pa.int64()), "ids": pa.array([sum(sizes)], pa.int64()), "width": pa.array([width], pa.int32())})

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write `docs` below `folder`; the manifest, with each shard's base."""
    from tokenizers import Tokenizer

    width = 2 if max(end_id + 1, Tokenizer.from_file(tokenizer).get_vocab_size()) <= 1 << 16 else 4
    rows = docs.select(F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_of(text_col).alias("text"))
    ordered = rows.repartitionByRange(shards or partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = written(ordered.mapInArrow(_writer(folder, tokenizer, end_id, width), MANIFEST), "manifest")
    # One row for each shard.
    return manifest.withColumn("base", F.sum("ids").over(Window.orderBy("shard")) - F.col("ids"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = _map(row["path"] + ".bin", {2: "<u2", 4: "<u4"}[row["width"]])
            edges = np.asarray(_map(row["path"] + ".idx", "<i8"))
            names = np.asarray(_map(row["path"] + ".doc", "<i8"))
            sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64(), mask=names == NULL_ID), pa.array(edges[:-1] + row["base"], pa.int64()), pa.array(np.diff(edges), pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; a task for each few shards."""
    parts = partitions(manifest.sparkSession)
    return manifest.select("shard", "path", "width", "base").repartition(parts, "shard").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


class TokenFiles:
    """Random access to written shards, by memory mapping: `ids(shard_path, k)` are those of a shard's k-th document."""

    def __init__(self, path: str, width: int):
        self.data, self.edges = _map(path + ".bin", {2: "<u2", 4: "<u4"}[width]), _map(path + ".idx", "<i8")

    def __len__(self) -> int:
        return len(self.edges) - 1

    def __getitem__(self, k: int) -> np.ndarray:
        return np.asarray(self.data[self.edges[k] : self.edges[k + 1]])


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark, "tokens")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER)))
