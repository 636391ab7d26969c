"""Benchmark decontamination by a distributed positional inverted index.

`build_index` stores for every word of the texts a posting (word's number, document, position), as Parquet in the shared
folder. Documents keep together, so building moves nothing between tasks: the words meet a vocabulary, which is sent to the
tasks if its counted size allows and joined otherwise. The vocabulary is that of the test items, as no other posting is
ever asked for, or that of the texts themselves.

`phrase_matches` finds every run of `window` consecutive words of an item. Each window is stood for by the posting lists
of its two rarest words (by the index's own counts; a window with a word that no document has is gone at once). The
rarest list, moved back by the word's place in its item, gives the places where the item could lie; the list of the next
one, moved alike, is intersected with it. The other words of the item are looked up at what is left alone, and runs of
found words of a window's length at least are the matches, exactly. `proximity_matches` begins with the rarest list too and
returns the shortest stretches of a document that have all of an item's words in any order.

Results for special input: a null or empty text, or one without a word, has no posting, and as an item matches nothing;
an item of fewer than `window` words is one window; rows of a repeated id and text each get the same result; a null
document id is an id like any other; items of the same id count once, and a null item id is written 'null'; empty tables
give no matches; a very long text has postings like any other; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm._common import BROADCAST_ROWS, column, table, text_of, written

#: Consecutive words that count as copied.
WINDOW = 10

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text whose A-Z aren't lower-cased yet.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Index(NamedTuple):
    """vocabulary: (term, word, n): its number, the word, its postings. postings: (doc_id, text_hash, pos, term), where doc_id
    and text_hash (64 bits) tell a document; a position counts words, and starts at 0 or 1."""

    vocabulary: DataFrame
    postings: DataFrame


DOC = ("doc_id", "text_hash")


def _words(text: Column) -> Column:
    """Words between separators; the first and the last may be empty."""
    return F.split(F.translate(text, UPPER, UPPER.lower()), SEPARATORS, -1)


def _sent(df: DataFrame, rows: int) -> DataFrame:
    """`df`, to be sent to every task if its rows are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Equality join in which nulls are equal, with the left side's keys. rows: of the right side, where they are known."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return left.join(right if rows is None else _sent(right, rows), on, how).drop(*(f"_{k}" for k in keys))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(column(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def build_index(docs: DataFrame, items: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", item_text_col: str = "text") -> Index:
    """The positional index of `docs`: of the words that `items` have, or of all words."""
    words = _documents(docs, id_col, text_col).select(*DOC, F.posexplode(_words(F.col("text"))).alias("pos", "word")).where(F.col("word") != "")
    wanted = words if items is None else items.select(F.explode(_words(text_of(item_text_col))).alias("word")).where(F.col("word") != "")
    vocabulary = written(wanted.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    postings = written(_join(words, vocabulary, ("word",), rows=vocabulary.count()).select(*DOC, "pos", "term"), "postings")
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    return Index(_join(vocabulary, counts, ("term",), "left").select("term", "word", F.coalesce("n", F.lit(0)).alias("n")), postings)


def _items(index: Index, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, place, term, n) for every word of the items; item numbers their rows, place counts words. A word that the
    index doesn't have is -1, with n 0."""
    rows = written(items.select(column(id_col).alias("item_id"), text_of(text_col).alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    words = rows.select("item", "item_id", F.posexplode(_words(F.col("text"))).alias("place", "word")).where(F.col("word") != "")
    known = _join(words, index.vocabulary, ("word",), "left")
    return written(known.select("item", "item_id", "place", F.coalesce("term", F.lit(-1)).alias("term"), F.coalesce("n", F.lit(0)).alias("n")), "item-words")


def anchors(words: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, place, term, place2, term2, low, high): the two rarest words of windows, ties to the earlier place, and the places
    low to high that these windows cover. A window with a word that no document has is left out; a window of one word
    has it twice."""
    whole = words.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("place", "n", "term"))).alias("w"))
    size = F.least(F.size("w"), F.lit(window))
    starts = whole.select("item", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("start"))
    part = starts.select("item", "size", F.transform(F.slice("w", F.col("start"), F.col("size")), lambda x: F.struct(x.n, x.place, x.term)).alias("part"))
    two = part.withColumn("a", F.array_min("part")).where(F.col("a.n") > 0)
    two = two.withColumn("b", F.coalesce(F.array_min(F.filter("part", lambda x: x.place != F.col("a.place"))), F.col("a")))
    lowest = F.col("part").getItem(0).place
    return two.groupBy("item", F.col("a.place").alias("place"), F.col("a.term").alias("term"), F.col("b.place").alias("place2"), F.col("b.term").alias("term2")).agg(F.min(lowest).alias("low"), F.max(lowest + F.col("size") - 1).alias("high"))


def phrase_matches(index: Index, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, start, stop): all runs of at least `window` consecutive words of an item (a shorter item's
    words all) that a document has, from position start up to before stop. Postings of a repeated row count once."""
    words = _items(index, items, id_col, text_col)
    size = words.groupBy("item").agg(F.least(F.count("*"), F.lit(window)).alias("size"))
    found = written(anchors(words, window), "anchors")
    n = found.count()
    rare = index.postings.join(_sent(found, n), "term").select(*DOC, "item", (F.col("pos") - F.col("place")).alias("shift"), "place2", "term2", "low", "high")
    rare = rare.withColumn("pos", F.col("shift") + F.col("place2")).withColumnRenamed("term2", "term")
    seconds = found.select(F.col("term2").alias("term")).distinct()
    second = _join(index.postings, seconds, ("term",), "left_semi", n)
    both = _join(rare, second, (*DOC, "pos", "term"), "left_semi")
    places = written(both.groupBy(*DOC, "item", "shift").agg(F.min("low").alias("low"), F.max("high").alias("high")), "places")
    where = places.select(*DOC).distinct()
    near = _join(index.postings, where, DOC, "left_semi", places.count()).distinct()
    there = places.join(words, "item").where(F.col("place").between(F.col("low"), F.col("high")))
    hits = _join(there.withColumn("pos", F.col("shift") + F.col("place")), near, (*DOC, "pos", "term"), "left_semi")
    run = hits.withColumn("run", F.col("place") - F.row_number().over(W.partitionBy(*DOC, "item", "shift").orderBy("place")))
    runs = run.groupBy(*DOC, "item", "item_id", "shift", "run").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("stop"))
    return runs.join(size, "item").where(F.col("stop") - F.col("start") >= F.col("size")).select(*DOC, "item_id", "start", "stop")


def proximity_matches(index: Index, items: DataFrame, within: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, start, stop): stretches of at most `within` words, from position start up to before stop,
    that have every distinct word of the item, in any order, and that no shorter one lies in."""
    words = _items(index, items, id_col, text_col).select("item", "item_id", "term", "n").distinct()
    rank = words.withColumns({"nth": F.row_number().over(W.partitionBy("item").orderBy("n", "term")), "most": F.count("*").over(W.partitionBy("item")), "least": F.min("n").over(W.partitionBy("item"))}).where(F.col("least") > 0)
    rank = written(rank, "ranked")
    n = rank.count()
    needed = _join(index.postings, rank.select("term").distinct(), ("term",), "left_semi", n).distinct()
    first = needed.join(_sent(rank.where("nth = 1"), n), "term").select(*DOC, "item", "item_id", "most", F.col("pos").alias("at"), F.floor(F.col("pos") / within).alias("cell"))
    # A posting can only be near places of its own cell of `within` positions and of the cells beside it.
    others = needed.join(_sent(rank.select("item", "term"), n), "term").select(*DOC, "item", "pos", "term", F.explode(F.sequence(F.floor(F.col("pos") / within) - 1, F.floor(F.col("pos") / within) + 1)).alias("cell"))
    near = _join(first, others, (*DOC, "item", "cell")).where(F.abs(F.col("pos") - F.col("at")) < within)
    around = near.groupBy(*DOC, "item", "item_id", "most", "at").agg(F.sort_array(F.collect_set(F.struct("pos", "term"))).alias("near"))
    around = around.where(F.size(F.array_distinct(F.col("near.term"))) == F.col("most"))
    # From each place as the first one, the stretch ends where the last of the words comes up first.
    ends = around.select(
        *DOC, "item_id",
        F.explode(F.transform("near", lambda a: F.struct(a.pos.alias("start"), F.array_max(F.transform(F.array_distinct(F.col("near.term")), lambda t: F.coalesce(F.array_min(F.transform(F.filter("near", lambda x: (x.term == t) & (x.pos >= a.pos)), lambda x: x.pos)), F.lit(1 << 31).cast("long")))).alias("last")))).alias("s"),
    )
    spans = ends.select(*DOC, "item_id", F.col("s.start").cast("long").alias("start"), (F.col("s.last").cast("long") + 1).alias("stop")).where(F.col("stop") - F.col("start") <= within).distinct()
    # Of stretches with the same end the latest start is the shortest, and of those with the same start there is one.
    return spans.groupBy(*DOC, "item_id", "stop").agg(F.max("start").alias("start")).select(*DOC, "item_id", "start", "stop")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: its id, n_words, n_hit (words in copied windows), n_items, items_sha256, contaminated."""
    index = build_index(docs, items, id_col, text_col, item_text_col)
    matches = written(phrase_matches(index, items, window, item_id_col, item_text_col), "matches")
    before = F.max("stop").over(W.partitionBy(*DOC).orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1))
    new = matches.select(*DOC, "start", "stop").distinct().withColumn("before", before)
    new = new.groupBy(*DOC).agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("before", "start")))).cast("long").alias("n_hit"))
    names = matches.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("null")))).alias("items"))
    found = _join(new, names, DOC)
    rows = _documents(docs, id_col, text_col).select(*DOC, F.regexp_count("text", F.lit(ANY_WORD)).cast("long").alias("n_words"))
    items_of, hit = F.coalesce("items", F.array().cast("array<string>")), F.coalesce("n_hit", F.lit(0).cast("long"))
    return _join(rows, found, DOC, "left").select(
        F.col("doc_id").alias(id_col), "n_words", hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"), F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the words that lie in windows of ten words of benchmark items."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, item_id, least(len(w), 10) AS l, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, l, i, array_to_string(w[i : i + l - 1], ' ') AS g FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
m AS (SELECT DISTINCT dw.r, dw.i, dw.l, bw.item_id FROM dw JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT r, i, l FROM m)) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), 'null') AS x FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN n ON d.r = n.r
"""
