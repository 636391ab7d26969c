"""Vectorised splitting of texts into words and hashing of them, on the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np

from skyledger.llm.pretoken import mixed

#: Characters of a chunk, unless a single text has more; its arrays then fit in a processor's cache.
CHUNK = 1 << 17

#: Words of more bytes get a cryptographic digest: sums of powers modulo 2^64 are equal for some unlike long words.
LONG = 64

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_NOISE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_LOWER = _NOISE.copy()
_LOWER[65:91] = _NOISE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def hashed_words(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and the number of words of each text.

    Words are runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return;
    `lower` makes A-Z equal to a-z. Words are told apart by these hashes; any two differ but for a chance of about 2^-64.
    """
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b" " + b" ".join(coded) + b" ", np.uint8)
    blank = _SPACE[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins, stops = edge[0::2], edge[1::2]
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _NOISE)[data] * power[: len(data)], out=sums[1:])
    hashes = mixed((sums[stops] - sums[begins]) * inverse[begins] + (stops - begins).astype(np.uint64))
    for k in np.flatnonzero(stops - begins > LONG).tolist():
        word = data[begins[k] : stops[k]].tobytes()
        hashes[k] = int.from_bytes(blake2b(word.lower() if lower else word, digest_size=8).digest(), "little")
    ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
    counts = np.diff(np.concatenate(([0], np.searchsorted(begins, ends))))
    return hashes, counts


def chunks(texts: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) of chunks of about CHUNK characters."""
    chunk: list[str] = []
    size = first = 0
    for k, text in enumerate(texts):
        chunk.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield first, chunk
            chunk, size, first = [], 0, k + 1
    if chunk:
        yield first, chunk


def shingles(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words of each text, and how many each has; a shorter text's words are one run,
    and a text without words has none."""
    n = len(words)
    steps = np.array([mixed(np.array([k + 77], np.uint64))[0] | np.uint64(1) for k in range(size)], np.uint64)
    ends = np.cumsum(counts)
    begins = ends - counts
    full = np.maximum(counts - size + 1, 0)
    if n >= size:
        runs = words[: n - size + 1] * steps[0]
        for k in range(1, size):
            runs += words[k : n - size + 1 + k] * steps[k]
        runs = mixed(runs)
    else:
        runs = np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    own = np.where((counts > 0) & (counts < size), 1, full)
    at = np.cumsum(own) - own
    out = np.empty(int(own.sum()), np.uint64)
    whole = np.flatnonzero(full)
    each = full[whole]
    inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    out[np.repeat(at[whole], each) + inside] = runs[np.repeat(begins[whole], each) + inside]
    for k in short.tolist():
        value = np.uint64(0x5851F42D4C957F2D) + np.uint64(int(counts[k]))
        for w in words[begins[k] : ends[k]].tolist():
            value = mixed(np.array([(int(value) * 0x2545F4914F6CDD1D + w) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]
        out[at[k]] = value
    return out, own
