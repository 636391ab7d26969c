"""Vectorised splitting of texts into the pre-tokens of the byte-level BPE pattern.

The pattern ('s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+) is settled by the
classes of neighbouring code points alone, so all texts of a chunk are split at once on an array of code points.
Equal pre-tokens are sought by a 64-bit polynomial hash and then compared code point by code point; only distinct ones
become Python strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex

#: Code points of a chunk, unless a single text has more.
CHUNK = 1 << 17
#: Entries in each of the two generations of a cache of encoded pre-tokens.
CACHE = 200_000

OTHER, LETTER, NUMBER, SPACE, END = range(5)
_ODD, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Splitter:
    def __init__(self) -> None:
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.classes = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(pattern, points):
                a, b = ord(found[0][0]), ord(found[0][-1])
                self.classes[a : b + 1] = kind  # runs over the gap of surrogates can't be letters on both sides
        self.classes[0xD800:0xE000] = OTHER
        self.noise = mixed(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            steps = np.full(n, _ODD, np.uint64), np.full(n, _INVERSE, np.uint64)
            for x in steps:
                x[0] = 1
            self.power, self.inverse = (np.multiply.accumulate(x) for x in steps)

    def split(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined texts; start and end of each pre-token in it; its hash; the number of pre-tokens of each text; all code points."""
        whole = "\0".join(texts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        kind = self.classes[codes]
        kind[ends] = END
        n = len(codes)
        space, blank = kind == SPACE, codes == 32
        start = np.empty(n, bool)
        start[0] = True
        start[1:] = kind[1:] != kind[:-1]
        # What follows a plain space is a piece with it; the last of several white space characters stands alone.
        after_blank = np.zeros(n, bool)
        after_blank[1:] = blank[:-1] & (kind[:-1] == SPACE) & (kind[1:] < SPACE)
        start &= ~after_blank
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & (kind[1:] < SPACE)
        start |= last
        start[ends] = True
        start[np.minimum(ends + 1, n - 1)] = True
        quote = np.flatnonzero((codes == 39) & start & (kind == OTHER))
        if len(quote):
            padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
            one, two = padded[quote + 1], padded[quote + 2]
            is_ = lambda x, c: x == ord(c)
            short = is_(one, "s") | is_(one, "t") | is_(one, "m") | is_(one, "d")
            long = ~short & (is_(one, "r") & is_(two, "e") | is_(one, "v") & is_(two, "e") | is_(one, "l") & is_(two, "l"))
            for found, size in ((quote[short], 2), (quote[long], 3)):
                start[found + 1] = False
                start[found + size] = True
        begins = np.flatnonzero(start)
        stops = np.append(begins[1:], n)
        real = kind[begins] != END
        begins, stops = begins[real], stops[real]
        self._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.noise[codes] * self.power[:n], out=sums[1:])
        hashes = mixed((sums[stops] - sums[begins]) * self.inverse[begins] + (stops - begins).astype(np.uint64))
        counts = np.diff(np.concatenate(([0], np.searchsorted(begins, ends))))
        return whole, begins, stops, hashes, counts, codes


def chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def same_as_first(codes: np.ndarray, begins: np.ndarray, stops: np.ndarray, first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Whether each pre-token has the code points of the one that stands for its hash."""
    size = stops - begins
    of = first[which]
    same = size == size[of]
    rest = np.flatnonzero(same & (of != np.arange(len(of))))
    if len(rest):
        each = size[rest]
        ends = np.cumsum(each)
        steps = np.arange(int(ends[-1]))
        unlike = codes[steps + np.repeat(begins[rest] - ends + each, each)] != codes[steps + np.repeat(begins[of[rest]] - ends + each, each)]
        if unlike.any():
            same[rest[np.searchsorted(ends, np.flatnonzero(unlike), "right")]] = False
    return same


class CachedEncoder:
    """Encodes texts by distinct pre-tokens: `known` answers what a fixed table has (-1 else), `encode` the rest."""

    def __init__(self, encode: Callable[[str], list[int]], known: Callable[[np.ndarray, list[str]], np.ndarray] | None = None):
        self.splitter, self.encode, self.known = Splitter(), encode, known
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, token: str) -> bytes:
        found = self.young.get(token)
        if found is None:
            found = self.old.get(token)
            if found is None:
                found = np.array(self.encode(token), "<u4").tobytes()
            if len(self.young) >= CACHE:
                self.young, self.old = {}, self.young
            if len(token) < 64:
                self.young[token] = found
        return found

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as little-endian 32-bit unsigned integers."""
        for chunk in chunks(texts):
            whole, begins, stops, hashes, counts, codes = self.splitter.split(chunk)
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            others: dict[str, int] = {}
            for k in np.flatnonzero(~same_as_first(codes, begins, stops, first, which)).tolist():
                which[k] = others.setdefault(whole[begins[k] : stops[k]], len(first))
                if which[k] == len(first):
                    first = np.append(first, k)
            tokens = [whole[a:b] for a, b in zip(begins[first].tolist(), stops[first].tolist(), strict=True)]
            if self.known is None:
                packed = list(map(self._ids, tokens))
            else:
                table = self.known(hashes[first], tokens).tolist()
                packed = [self._ids(t) if k < 0 else k.to_bytes(4, "little") for t, k in zip(tokens, table, strict=True)]
            flat = np.frombuffer(b"".join(packed), "<u4")
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
            at = np.cumsum(sizes) - sizes
            each = sizes[which]
            upto = np.concatenate(([0], np.cumsum(each)))
            ids = flat[np.repeat(at[which] - upto[:-1], each) + np.arange(upto[-1])]
            edges = upto[np.concatenate(([0], np.cumsum(counts)))]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield ids[a:b]
