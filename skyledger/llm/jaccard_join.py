"""Exact set-similarity join on word shingles by partitioning the universe (pigeonhole), and its components.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Sets of Jaccard similarity 0.75 or more
differ in (|r| + |s|) / 7 elements at most. Sizes are dealt into bands of ratio 4/3, so that similar sets lie in one
band or in neighbouring ones; a level joins a band with itself and with the next. At a level with at most H
differences the universe is hashed into H + 1 segments: two similar sets agree on some segment, so each set is
indexed under a hash of its part (subset) in every segment.

Allocation by cost: a sketch of document frequencies over all documents estimates the list a subset would meet (the
least frequency of its elements). Empty subsets and those of frequent elements are skipped; for each skipped
segment another one allows a difference of one element, by indexing the subset's one-deletion neighbourhood too.
That is for subsets of two rare elements or more, so that each neighbour keeps a rare one; of these the first by
number serve (the set's reach). Where too few can make up for the skipped ones, the cheapest skipped ones are
used, empty subsets last; but a set of many rare elements, more than a similar set may lack, uses those elements
as subsets of their own instead (sets with a fair share of frequent elements index them). Skipped entries are indexed too, but as such: of two similar
sets the one of shorter reach is sure to meet the other by an entry that it uses itself, as the other one's reach
covers its own. So only such meetings count, which spares pairs of a set of rare elements with one of frequent ones.

Buckets of the index never give all their pairs. First every member is verified against one pivot of its bucket;
members then in one component need no further comparison, and a pair (x, y) is ruled out by the triangle inequality
of Jaccard distance, |d(pivot, x) - d(pivot, y)| > 0.25. Members of crowded buckets that
are still open meet by a prefix filter instead: each set's rare elements, by counts among these sets alone. What is left
is compared pair by pair: first by bitmaps of half a byte an element, which bound the intersection from above and rule out
nearly all unlike pairs, then exactly, on the whole sets of the few documents that remain. Documents of equal sets are one
node from the start.

Results for special input: a null text, or one without words, has an empty set and is linked with nothing (its
component is its own id); fewer than five words make one shingle; repeated rows each give a row; a null id counts
as larger than all others (a component of null ids only has a null id); an empty table gives an empty result; other
columns are ignored. A very long text is one set like any other. Sets and nodes are told apart by 64-bit hashes, of
shingles of words (a cryptographic digest stands for a word of more than 64 bytes).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import BROADCAST_ROWS, column, partitions, pow2_at_least, shuffles_freed, table, text_key, text_of, unused, written
from skyledger.llm.components import components
from skyledger.llm.exact_dedup import one_of_each
from skyledger.llm.pretoken import mixed
from skyledger.llm.words import chunks, hashed_words, shingles

WORDS = 5
#: 100 * intersection >= PERCENT * union links two sets.
PERCENT = 75
#: Counters of the sketch of document frequencies, and the estimated frequency from which an element is frequent.
COUNTERS, FREQUENT = 1 << 20, 256
#: Buckets of more members form pairs by shared elements outside their pivot.
SMALL = 32
#: Entries that a task gathers before it sends them on.
FLUSH = 500_000
RANGES = 16
#: Parts of the index for each shuffle partition: a part is sorted in a task's memory.
PARTS = 2
#: The index is made and shuffled in so many passes over the texts, each with its share of the parts, of which one is on disk at a time.
PASSES = 2
NO_ID = (1 << 63) - 1
EXACT_SKIPPED, EXACT, DELETION = 0, 1, 2
#: The reach of an entry's set is stored doubled, plus this if the set is of the level's upper band.
UPPER = 1


@cache
def levels() -> tuple[np.ndarray, np.ndarray]:
    """First sizes of the bands, and the number of segments of each level."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, -(-first[-1] * 4 // 3)))
    segments = []
    for k in range(len(first) - 2):
        r = first[k + 1] - 1
        segments.append((r + min(first[k + 2] - 1, r * 4 // 3)) // 7 + 1)
    return np.array(first, np.int64), np.array(segments, np.int64)


def sets_of(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = hashed_words(texts, lower=True)
    runs, own = shingles(words, counts, WORDS)
    ends = np.cumsum(own)
    begins = ends - own
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        runs[a:b].sort()
    fresh = np.ones(len(runs), bool)
    fresh[1:] = runs[1:] != runs[:-1]
    fresh[begins[own > 0]] = True
    before = np.concatenate(([0], np.cumsum(fresh)))
    runs = runs[fresh]
    return [runs[a:b] for a, b in zip(before[begins].tolist(), before[ends].tolist(), strict=True)]


def nodes_of(sets: list[np.ndarray]) -> np.ndarray:
    """Hashes of whole sets, as signed 64-bit integers."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    ends = np.cumsum(sizes)
    sums = np.zeros(int(sizes.sum()) + 1, np.uint64)
    if len(sums) > 1:
        np.cumsum(mixed(np.concatenate(sets) ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    return mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


def _counter_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def bitmap_of(tokens: np.ndarray) -> bytes:
    """Four to eight bits for each element, a power of two in all; a longer bitmap folds onto a shorter one."""
    bits = np.zeros(max(64, 1 << (4 * max(1, len(tokens)) - 1).bit_length()), bool)
    bits[(tokens & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: np.ndarray, n: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, n), axis=0)


def shared_at_most(a: bytes, b: bytes, a_size: int, b_size: int) -> int:
    """An upper bound of the size of the intersection of two sets: a bit that only one of them has stands for an
    element that the other lacks."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    own, other = (_folded(x, n) if len(x) > n else x), (_folded(y, n) if len(y) > n else y)
    lacking = int(np.bitwise_count(own & ~other).sum()), int(np.bitwise_count(other & ~own).sum())
    return min(a_size - lacking[0], b_size - lacking[1])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, maps = [], [], []
        for _, texts in chunks(batch.column(1).to_pylist()):
            sets = sets_of(texts)
            sizes.extend(map(len, sets))
            nodes.append(nodes_of(sets))
            maps.extend(map(bitmap_of, sets))
        node = np.concatenate([np.zeros(0, np.int64), *nodes])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(node), pa.array(maps, pa.binary())], names=["doc_id", "key", "n_shingles", "node", "bits"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for _, texts in chunks(batch.column(0).to_pylist()):
            np.add.at(counts, _counter_of(np.concatenate(sets_of(texts))), 1)
    yield from _split_counts(counts)


def _split_counts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k, part in enumerate(np.split(counts, RANGES)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())], names=["part", "counts"])


def _add_up(keys, group):
    total = np.zeros(COUNTERS // RANGES, np.int64)
    for blob in group.column("counts"):
        total += np.frombuffer(blob.as_buffer(), "<i8")
    return pa.table({"part": pa.array([keys[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _summed(sketches: DataFrame) -> np.ndarray:
    """The counters of all partitions together: COUNTERS numbers, whatever the table."""
    counts = np.zeros((RANGES, COUNTERS // RANGES), np.int64)
    for row in sketches.groupBy("part").applyInArrow(_add_up, "part int, counts binary").collect():
        counts[row["part"]] = np.frombuffer(row["counts"], "<i8")
    return counts.reshape(-1)


def frequency_costs(texts: DataFrame) -> np.ndarray:
    """For each counter 0 if its elements are rare, else a logarithmic estimate of their document frequency.

    A counter holds many elements; what it has above the mean and eight deviations counts as one element's."""
    counts = _summed(texts.mapInArrow(_sketch, "part int, counts binary"))
    middle = float(np.median(counts))
    above = counts - middle - 8 * np.sqrt(middle)
    return np.where(above >= FREQUENT, np.maximum(np.clip(8 * np.log2(np.maximum(above, 1)), 0, 255), 1), 0).astype(np.uint8)


def _allocate(owner: np.ndarray, base: np.ndarray, m: np.ndarray, size: np.ndarray, rare: np.ndarray, cost: np.ndarray, rich: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per segment: whether it is used exactly, and whether it is in the set's reach that allows one difference; each
    set's reach; and which of the `rich` sets use their rare elements instead, as too few segments can make up."""
    used = rare > 0
    able = rare > 1
    before = np.concatenate(([0], np.cumsum(able)))
    have = before[base + m] - before[base]
    lack = m - np.add.reduceat(used.astype(np.int64), base)
    short = have < lack
    instead = short & rich
    used &= ~instead[owner]
    for d in np.flatnonzero(short & ~rich).tolist():
        own = slice(base[d], base[d] + m[d])
        skipped = np.flatnonzero(~used[own])
        more = int(lack[d] - have[d])
        order = np.lexsort((cost[own][skipped], size[own][skipped] == 0))  # cheapest first, empty subsets last
        used[base[d] + skipped[order[:more]]] = True
    # Sets that use costly subsets reach farthest, then those that use their elements: the other set of a pair must meet them.
    within = (before[:-1] - before[base][owner] < lack[owner]) | short[owner]
    return used, within, np.add.reduceat(within.astype(np.int64), base) + (short & ~rich), instead


def index_entries(sets: list[np.ndarray], costs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(signatures, numbers of the sets, kinds, reaches) of non-empty sets at their two levels."""
    first, segments = levels()
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    weight = mixed(tokens ^ np.uint64(0x8EBC6AF09C88C6E3))
    price = costs[_counter_of(tokens)]
    band = np.searchsorted(first, sizes, "right") - 1
    for step in (0, 1):
        level = band - step
        live = (level >= 0) & (segments[np.maximum(level, 0)] > 1)  # one segment: only equal sets are similar
        if not live.any():
            continue
        number = np.flatnonzero(live)
        m = segments[level[number]]
        base = np.cumsum(m) - m
        place = np.zeros(len(sets), np.int64)
        place[number] = np.arange(len(number))
        of = live[owner]
        tok, w, who = tokens[of], weight[of], place[owner[of]]
        salt = mixed(level[number].astype(np.uint64) + np.uint64(0x1D8E4E27C47D124F))
        segment = ((mixed(tok ^ salt[who]) >> np.uint64(32)) * m[who].astype(np.uint64)) >> np.uint64(32)
        at = base[who] + segment.astype(np.int64)
        total = int(m.sum())
        owners = np.repeat(np.arange(len(number)), m)
        subset, size, cost = np.zeros(total, np.uint64), np.bincount(at, minlength=total), np.full(total, 255, np.uint8)
        np.add.at(subset, at, w)
        np.minimum.at(cost, at, price[of])
        cheap = price[of] == 0
        rare = np.bincount(at[cheap], minlength=total)
        elements = sizes[number]
        common = np.bincount(who[~cheap], minlength=len(number))
        rich = (elements - common > elements // 4) & (2 * common >= elements)
        used, within, reach, instead = _allocate(owners, base, m, size, rare, cost, rich)
        reach = (reach * 2 + (UPPER if step else 0)).astype(np.int32)
        name = mixed(salt[owners] + (np.arange(total) - base[owners]).astype(np.uint64))
        yield mixed(subset + name), number[owners], np.where(used, EXACT, EXACT_SKIPPED).astype(np.uint8), reach[owners]
        # A set similar to one that uses its elements has at least 3/16 frequent ones.
        shown = cheap & (16 * common >= 3 * elements)[who]
        if shown.any():
            yield mixed(tok[shown] + name[base][who[shown]]), number[who[shown]], np.where(instead[who[shown]], EXACT, EXACT_SKIPPED).astype(np.uint8), reach[who[shown]]
        out = within[at] & (rare[at] - cheap > 0) & (size[at] > 1)
        if out.any():
            yield mixed(subset[at[out]] - w[out] + name[at[out]]), number[who[out]], np.full(int(out.sum()), DELETION, np.uint8), reach[who[out]]


def _indexer(costs: np.ndarray, parts: int, turn: int = 0, turns: int = 1):
    """Entries of the index in the parts of one turn, in one row for each part and flush: nodes, sizes, entries of each, signatures
    with kinds. Parts are dealt over turns by the first bits of a signature; turns is a power of two, and not more than parts."""
    bits = parts.bit_length() - 1
    lead = turns.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        held = gathered = 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, seen, held, gathered
            signature, number, kind, reach = (np.concatenate(x) for x in zip(*waiting, strict=True))
            node, size = (np.concatenate(x) for x in zip(*seen, strict=True))
            waiting, seen, held, gathered = [], [], 0, 0
            part = (signature >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(signature), np.int64)
            # A set's entries at one level have one reach, whose last bit tells the two levels apart.
            run = part << 40 | number << 1 | reach & 1
            order = np.argsort(run)
            run = run[order]
            start = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
            each = np.diff(np.append(start, len(run)))
            node, size, reach = node[number[order[start]]], size[number[order[start]]], reach[order[start]]
            # 46 bits below those of the part, and two for the kind: chance meetings are settled by verification.
            short = ((signature[order] << np.uint64(bits)) >> np.uint64(18) << np.uint64(2)) | kind[order]
            high, low = (short >> np.uint64(16)).astype("<u4"), short.astype("<u2")
            edges = np.searchsorted(run, np.arange(parts + 1) << 40)
            begins = np.searchsorted(start, edges)
            names, blobs = np.flatnonzero(np.diff(edges)).tolist(), []
            for k in names:
                entries, sets = slice(edges[k], edges[k + 1]), slice(begins[k], begins[k + 1])
                numbers = [_narrow(x[sets]) for x in (size, reach, each)]
                head = np.array([len(node[sets]), len(low[entries]), int.from_bytes([x.itemsize for x in numbers], "little"), 0], "<i4")
                blobs.append(b"".join(x.tobytes() for x in (head, node[sets].astype("<i8"), *numbers, high[entries], low[entries])))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "entries"])

        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                sets = [s for s in sets_of(texts) if len(s)]
                if not sets:
                    continue
                known: dict[int, np.ndarray] = dict(zip(nodes_of(sets).tolist(), sets, strict=True))
                seen.append((np.fromiter(known, np.int64, len(known)), np.fromiter(map(len, known.values()), np.int64, len(known))))
                for signature, number, kind, reach in index_entries(list(known.values()), costs):
                    if lead:
                        own = np.flatnonzero(signature >> np.uint64(64 - lead) == turn)
                        signature, number, kind, reach = signature[own], number[own], kind[own], reach[own]
                    waiting.append((signature, number + held, kind, reach))
                    gathered += len(signature)
                held += len(known)
                if gathered >= FLUSH:
                    yield flush()
        if gathered:
            yield flush()

    return run


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Non-negative numbers in as few bytes each as the largest needs: one, two or four."""
    most = int(numbers.max())
    return numbers.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


BUCKETS = "bucket long, node long, size long, kind byte, reach int"
COUNTED = "a long, b long, common long, sizes long"


def _buckets(keys, group):
    """Buckets of one part in which some pair must be compared, equal ones once."""
    signatures, nodes, sizes, reaches = [], [], [], []
    for blob in group.column("entries"):
        data = blob.as_buffer()
        docs, n, widths, _ = (int(x) for x in np.frombuffer(data, "<i4", 4))
        own, at = np.frombuffer(data, "<i8", docs, 16), 16 + 8 * docs
        numbers = []
        for width in widths.to_bytes(3, "little"):
            numbers.append(np.frombuffer(data, f"<u{width}", docs, at).astype(np.int32))
            at += width * docs
        size, reach, each = numbers
        signatures.append(np.frombuffer(data, "<u4", n, at).astype(np.uint64) << np.uint64(16) | np.frombuffer(data, "<u2", n, at + 4 * n))
        for out, values in ((nodes, own), (sizes, size), (reaches, reach)):
            out.append(np.repeat(values, each))
    packed, node, size, reach = (np.concatenate(x) for x in (signatures, nodes, sizes, reaches))
    del signatures, nodes, sizes, reaches
    order = np.argsort(packed >> np.uint64(2))
    signature = packed[order] >> np.uint64(2)
    same = signature[1:] == signature[:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order = order[shared]
    packed, node, size, reach = packed[order], node[order], size[order], reach[order]
    signature, kind = packed >> np.uint64(2), (packed & np.uint64(3)).astype(np.int8)
    order = np.lexsort((kind, node, signature))
    columns = [x[order] for x in (signature, node, size, kind, reach)]

    def distinct() -> np.ndarray:
        signature, node, _, kind, _ = columns
        once = np.ones(len(node), bool)
        once[1:] = (signature[1:] != signature[:-1]) | (node[1:] != node[:-1]) | (kind[1:] != kind[:-1])
        return once

    def starts() -> np.ndarray:
        return np.flatnonzero(np.concatenate(([True], columns[0][1:] != columns[0][:-1])))

    columns = [x[distinct()] for x in columns]
    if len(columns[0]):
        # A skipped entry counts only if some entry in use has no longer reach.
        signature, node, size, kind, reach = columns
        start = starts()
        least = np.minimum.reduceat(np.where(kind == EXACT_SKIPPED, np.iinfo(np.int32).max, reach >> 1), start)
        wanted = (kind != EXACT_SKIPPED) | (reach >> 1 >= np.repeat(least, np.diff(np.append(start, len(node)))))
        columns = [x[wanted] for x in columns]
    if len(columns[0]):
        signature, node, size, kind, reach = columns
        start = starts()
        some = lambda v: np.bitwise_or.reduceat(v.astype(np.int8), start) > 0
        wanted = (np.minimum.reduceat(node, start) != np.maximum.reduceat(node, start)) & some(reach & 1 != UPPER) & (some(kind == EXACT) | some(kind == DELETION) & some(kind == EXACT_SKIPPED))
        content = np.add.reduceat(mixed((node.astype(np.uint64) << np.uint64(2)) + kind.astype(np.uint64)) ^ mixed(reach.astype(np.uint64)), start)
        _, first = np.unique(np.where(wanted, content, np.uint64(0)), return_index=True)
        keep = np.zeros(len(start), bool)
        keep[first] = True
        keep &= wanted
        each = np.diff(np.append(start, len(node)))
        rows = np.repeat(keep, each)
        columns = [np.repeat(content.view(np.int64), each)[rows], node[rows], size[rows], kind[rows], reach[rows]]
    else:
        columns = [columns[0].view(np.int64), *columns[1:]]
    kinds = (("bucket", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("kind", pa.int8()), ("reach", pa.int32()))
    return pa.table({n: pa.array(v.astype(t.to_pandas_dtype()), t) for (n, t), v in zip(kinds, columns, strict=True)})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s for _, texts in chunks(batch.column(0).to_pylist()) for s in sets_of(texts)]
        yield pa.RecordBatch.from_arrays([pa.array(nodes_of(found)), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "tokens"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {n: batch.column(n) for n in ("a", "b", "a_tokens", "b_tokens")}
        sizes, common = [], []
        for x, y in zip(columns["a_tokens"], columns["b_tokens"], strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            sizes.append(len(x) + len(y))
            both = np.concatenate((x, y))
            both.sort()
            common.append(int((both[1:] == both[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([columns["a"], columns["b"], pa.array(common, pa.int64()), pa.array(sizes, pa.int64())], names=["a", "b", "common", "sizes"])


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a_size, b_size = batch.column("a_size").to_pylist(), batch.column("b_size").to_pylist()
        most = [shared_at_most(x.as_buffer(), y.as_buffer(), n, m) for x, y, n, m in zip(batch.column("a_bits"), batch.column("b_bits"), a_size, b_size, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(most, pa.int64()), pa.array([n + m for n, m in zip(a_size, b_size, strict=True)], pa.int64())], names=["a", "b", "common", "sizes"])


def _both(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of both nodes as a_<column> and b_<column>."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)), side)
    return pairs


def _linked() -> Column:
    return F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * PERCENT


def _distance() -> Column:
    return F.lit(1.0) - F.col("common") / (F.col("sizes") - F.col("common"))


def whole_sets(nodes: DataFrame, held: DataFrame, rows: DataFrame) -> DataFrame:
    """node, tokens of some nodes, from their documents' texts."""
    needed = written(held.join(nodes.distinct(), "node").select("held_id").distinct(), "needed")
    # Ids only; beyond the bound both sides are shuffled instead.
    few = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    return written(rows.join(few, "held_id", "left_semi").select("text").mapInArrow(_sets, "node long, tokens binary").dropDuplicates(["node"]), "sets")


def compared(pairs: DataFrame, held: DataFrame, rows: DataFrame) -> DataFrame:
    """a, b, linked, low, high, common for distinct pairs of nodes: bounds of their distance, equal where the whole sets were
    compared, and an upper bound of their common elements.

    held: node, held_id, size, bits; rows: held_id, text.
    """
    bounded = written(_both(pairs, held, "size", "bits").mapInArrow(_bounds, COUNTED), "bounds")
    likely = bounded.filter(_linked()).select("a", "b")
    sets = whole_sets(likely.select(F.col("a").alias("node")).union(likely.select("b")), held, rows)
    exact = _both(likely, sets, "tokens").select("a", "b", "a_tokens", "b_tokens").mapInArrow(_common, COUNTED)
    unlike = bounded.filter(~_linked()).select("a", "b", F.lit(False).alias("linked"), _distance().alias("low"), F.lit(1.0).alias("high"), "common")
    return written(exact.select("a", "b", _linked().alias("linked"), _distance().alias("low"), _distance().alias("high"), "common").unionByName(unlike), "compared")


def node_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), n_shingles, comp (a number that the documents of a component share) per row of `docs`,
    which is read PASSES + 4 times."""
    with shuffles_freed(docs.sparkSession):
        members, found = _node_components(docs, id_col, text_col)
    return members.join(found, "node", "left").select("doc_id", "key", "n_shingles", F.coalesce("comp", "node").alias("comp"))


def indexed(texts: DataFrame, costs: np.ndarray, turns: int = PASSES) -> DataFrame:
    """The buckets of the index, equal ones once, from as many passes over the texts."""
    parts = pow2_at_least(max(turns, PARTS * partitions(texts.sparkSession)))
    found = None
    for turn in range(turns):
        index = texts.mapInArrow(_indexer(costs, parts, turn, turns), "part int, entries binary")
        own = written(index.groupBy("part").applyInArrow(_buckets, BUCKETS).distinct(), "buckets")
        found = own if found is None else found.union(own)
    return written(found.distinct(), "buckets")


def _node_components(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    members = written(rows.withColumn("key", text_key(F.col("text"))).mapInArrow(_members, "doc_id long, key struct<one:long,two:long>, n_shingles long, node long, bits binary"), "members")
    texts = rows.select("text")
    costs = frequency_costs(texts)
    buckets = written(with_pivots(indexed(texts, costs)), "pivots")

    # Of each node in a bucket one document, for its bitmap and, if need be, its text.
    held_id = F.coalesce("doc_id", F.lit(NO_ID))
    first_of = members.groupBy("node").agg(F.min(held_id).alias("held_id")).join(buckets.select("node").distinct(), "node")
    held = written(members.withColumn("held_id", held_id).join(first_of, ["node", "held_id"]).select("node", "held_id", F.col("n_shingles").alias("size"), "bits").dropDuplicates(["node"]), "held")
    named_rows = rows.select(held_id.alias("held_id"), "text")

    stars = buckets.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    first = compared(stars, held, named_rows)
    known = components(first.filter("linked"))
    rest = compared(remaining_pairs(buckets, first, known, held, named_rows), held, named_rows)
    return members, components(rest.filter("linked"), known)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    named = node_components(docs, id_col, text_col)
    least = named.filter("n_shingles > 0").groupBy("comp").agg(F.min("doc_id").alias("least_id")).withColumnRenamed("comp", "least_comp")
    joined = named.join(least, (named["comp"] == least["least_comp"]) & (named["n_shingles"] > 0), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"))


def with_pivots(buckets: DataFrame) -> DataFrame:
    """`buckets` with a pivot: of a bucket's members the one that meets most others in all buckets, so that a text from
    which a group of copies was made is compared with all of them first."""
    sizes = buckets.groupBy(F.col("bucket").alias("s_bucket")).agg(F.count(F.lit(1)).alias("met"))
    scores = buckets.join(sizes, buckets["bucket"] == sizes["s_bucket"]).groupBy(F.col("node").alias("s_node")).agg(F.sum("met").alias("score"))
    best = buckets.join(scores, buckets["node"] == scores["s_node"]).groupBy(F.col("bucket").alias("p_bucket")).agg(F.max(F.struct("score", "node"))["node"].alias("pivot"))
    return buckets.join(best, buckets["bucket"] == best["p_bucket"]).select("bucket", "node", "size", "kind", "reach", "pivot")


PREFIX = np.dtype([("key", "<u8"), ("node", "<i8"), ("comp", "<i8"), ("size", "<i4"), ("place", "<i4")])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            np.add.at(counts, _counter_of(np.frombuffer(x.as_buffer(), np.uint64)), 1)
    yield from _split_counts(counts)


def _prefixes(parts: int, counts: np.ndarray):
    """The first size / 4 + 1 elements of each set, rare ones first, with their places; in one row for each part and flush.

    Linked x and y have at least a = 3 (|x| + |y|) / 7 common elements, so that by any order of elements the first one they
    share is among the first |x| - a + 1 of x, which are |x| / 4 + 1 at most, and among the first |y| - a + 1 of y."""
    bits = parts.bit_length() - 1

    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(found)
        part = (rows["key"] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rows), np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        used = np.flatnonzero(np.diff(edges)).tolist()
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([rows[order[edges[k] : edges[k + 1]]].tobytes() for k in used], pa.binary())], names=["part", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, gathered = [], 0
        for batch in batches:
            for x, node, comp in zip(batch.column("tokens"), batch.column("node").to_pylist(), batch.column("comp").to_pylist(), strict=True):
                own = np.frombuffer(x.as_buffer(), np.uint64)
                first = own[np.lexsort((own, counts[_counter_of(own)]))[: len(own) // 4 + 1]]
                rows = np.empty(len(first), PREFIX)
                rows["key"], rows["node"], rows["comp"], rows["size"], rows["place"] = mixed(first), node, comp, len(own), np.arange(len(first))
                found.append(rows)
                gathered += len(rows)
                if gathered >= FLUSH:
                    yield packed(found)
                    found, gathered = [], 0
        if found:
            yield packed(found)

    return run


def _sharing(keys, group):
    """Pairs of a part, of different components, that share an element where the first one they share can be."""
    rows = np.concatenate([np.frombuffer(x.as_buffer(), PREFIX) for x in group.column("entries")])
    rows = rows[np.lexsort((rows["comp"], rows["key"]))]
    start = np.flatnonzero(np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))) if len(rows) else np.zeros(0, np.int64)
    stop = np.append(start, len(rows))[1:]
    live = rows["comp"][start] != rows["comp"][stop - 1] if len(start) else np.zeros(0, bool)
    found: list[np.ndarray] = []
    for a, b in zip(start[live].tolist(), stop[live].tolist(), strict=True):
        own = rows[a:b]
        size, rest = own["size"].astype(np.int64), own["size"].astype(np.int64) - own["place"]
        # Rows are ordered by component: each run meets all later ones.
        nexts = np.searchsorted(own["comp"], own["comp"], "right")
        for k in np.flatnonzero(nexts < len(own)).tolist():
            n = nexts[k]
            y = own["node"][n:][np.minimum(rest[k], rest[n:]) * 7 >= 3 * (size[k] + size[n:])]
            if len(y):
                found.append(np.stack((np.minimum(y, own["node"][k]), np.maximum(y, own["node"][k]))))
        if len(found) > 10_000:
            found = [np.unique(np.concatenate(found, axis=1), axis=1)]
    both = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(both[0], pa.int64()), "b": pa.array(both[1], pa.int64())})


def remaining_pairs(buckets: DataFrame, stars: DataFrame, known: DataFrame, held: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of a bucket that neither a component nor the distances to the pivot settle.

    In a bucket of more than SMALL members pairs are not simply formed: the members of all such buckets are joined by the
    rare elements of their sets (prefix filter), with elements ordered by their counts among these sets alone. What edits
    have put into copies of one text comes first by that order, what the copies share comes last.
    """
    c = F.col
    near = stars.select(c("a").alias("one"), c("b").alias("other"), "low", "high")
    near = near.unionByName(near.select(c("other").alias("one"), c("one").alias("other"), "low", "high")).withColumnsRenamed({"one": "pivot", "other": "node"})
    own = ("node", "size", "kind", "reach")
    placed = buckets.filter("node <> pivot").join(near, ["pivot", "node"]).join(known, "node", "left")
    placed = placed.select("bucket", *own, "low", "high", F.coalesce("comp", "node").alias("comp"))
    open_ = placed.groupBy(c("bucket").alias("open_bucket")).agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("met")).filter("least < most").select("open_bucket", "met")
    inside = written(placed.join(open_, placed["bucket"] == open_["open_bucket"]).drop("open_bucket"), "open")
    side = lambda df, t: df.select("bucket", *(c(f).alias(f"{t}_{f}") for f in (*own, "low", "high", "comp")))
    slack = (100 - PERCENT) / 100 + 1e-9
    half = lambda t: F.shiftright(c(f"{t}_reach"), 1)
    uses = lambda t, u: (F.struct(half(t), f"{t}_node") < F.struct(half(u), f"{u}_node")) & ((c(f"{t}_kind") == EXACT) | (c(f"{t}_kind") == DELETION) & (c(f"{u}_kind") != DELETION))
    unlike = (c("x_comp") != c("y_comp")) & (F.least("x_size", "y_size") * 100 >= F.greatest("x_size", "y_size") * PERCENT)
    # The set of shorter reach must use the entry by which the two meet; two of the upper band meet at their own level.
    meet = (
        (uses("x", "y") | uses("y", "x"))
        & unlike
        & ((c("x_reach").bitwiseAND(1) != UPPER) | (c("y_reach").bitwiseAND(1) != UPPER))
        & (c("x_low") - c("y_high") <= slack)
        & (c("y_low") - c("x_high") <= slack)
    )
    pair = (F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))
    few, many = inside.filter(c("met") <= SMALL), inside.filter(c("met") > SMALL)
    formed = side(few, "x").join(side(few, "y"), "bucket").filter(meet & (c("x_node") < c("y_node"))).select(*pair)

    apart = written(many.groupBy("node").agg(F.max("comp").alias("comp")), "apart")
    sets = whole_sets(apart.select("node"), held, rows)
    counts = _summed(sets.select("tokens").mapInArrow(_finer, "part int, counts binary"))
    parts = pow2_at_least(partitions(buckets.sparkSession))
    sharing = apart.join(sets, "node").select("node", "comp", "tokens").mapInArrow(_prefixes(parts, counts), "part int, entries binary").groupBy("part").applyInArrow(_sharing, "a long, b long")
    return formed.union(sharing).distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each component, that of the smallest id; documents without words all stay.

    Rows are told apart by their id and 128 bits of their text: rows alike in both have the same set, so that at most one
    of them stays anyway. A null id comes after all others; of repeated rows one stays; an empty table stays empty; other
    columns may have any names.
    """
    c = F.col
    named = node_components(docs, id_col, text_col).filter("n_shingles > 0").groupBy("comp", "doc_id", "key").agg(F.count(F.lit(1)).alias("times"))
    order = F.struct(c("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    groups = named.groupBy(c("comp").alias("g_comp")).agg(F.min(order).alias("first"), F.sum("times").alias("members")).filter("members > 1")
    verdicts = named.join(groups, named["comp"] == groups["g_comp"]).select("doc_id", "key", (order == c("first")).alias("stays"), "times")
    verdicts = written(verdicts.filter("not stays or times > 1"), "verdicts")
    own, key = unused(docs.columns, "own_id"), unused(docs.columns, "text_key")
    rows = docs.withColumns({own: column(id_col).cast("long"), key: text_key(text_of(text_col))})
    alike = rows[own].eqNullSafe(verdicts["doc_id"]) & (rows[key] == verdicts["key"])
    rest = rows.join(verdicts.select("doc_id", "key"), alike, "left_anti").select(*map(column, docs.columns))
    repeated = verdicts.filter("stays")
    if not repeated.limit(1).count():
        return rest
    return rest.unionByName(one_of_each(rows.join(repeated, alike, "left_semi"), [own, key], id_col, docs.columns))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
