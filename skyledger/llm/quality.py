"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets plain counts (words, characters in words, symbols, repeated lines, words in repeated 3-word
windows, short and long words, ASCII digits and punctuation). A sketch per language, source and measure holds counts of
log-linear buckets: a value keeps its nine leading bits, so a quantile is within 1/256 of the true value, and two sketches
merge by adding their counters. The fences of a measure lie FACTOR spreads beyond the median of a document's own language
and source: above it in units of the distance from the median to the 80th percentile, below it in units of that to the
20th. A spread counts as a fiftieth of the median at least, so that a group of uniform texts tolerates small differences. A group of fewer than MIN_GROUP documents
takes the quantiles of its language, merged from the sketches of the language's sources, and a small language those of all
documents. The thresholds are joined back and decide, beside a fixed base rule.

Everything is DataFrame expressions; texts are never shuffled, only counts.

Results for special input: a null or empty text has no words and fails the base rule; a very long text is measured whole;
null language or source is a group of its own; ties of quantiles take the smaller bucket; repeated rows each give a row;
a null id is an id like any other; an empty table gives an empty result; other columns are ignored by `measure` and kept
by `quality_filter`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm._common import BROADCAST_ROWS, SPACES, column, let, table, text_of, unused, written

#: Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents that a group needs for thresholds of its own.
MIN_GROUP = 50
#: For each measure (in thousandths): its two counts, and the spreads that the fences are away from the median. Marks are
#: ASCII digits and punctuation; words of at most 2 code points are short, those of at least 9 are long.
MEASURES = {
    "marks": {"of": ("n_marks", "n_chars"), "factor": 20, "low": False},
    "word_length": {"of": ("word_chars", "n_words"), "factor": 7, "low": True},
    "short_words": {"of": ("n_short", "n_words"), "factor": 7, "low": True},
    "long_words": {"of": ("n_long", "n_words"), "factor": 8, "low": True},
}
#: A spread is at least this part of the median, and 1 (the unit of the measures, a thousandth).
FLOOR = 50
MARKS = r"[!-@\[-`{-~]"
SHORT, LONG = 2, 9


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _covered_by_repeats(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: windows are hashed and sorted with their positions, equal
    neighbours give the positions, and each window adds the words that the one before it doesn't reach."""

    def grams(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.struct(F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        own = lambda x, k: F.get(s, k).getField("h").eqNullSafe(x.getField("h"))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: own(x, k - 1) | own(x, k + 1)), lambda x: x.getField("i")))

    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
    covered = lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-2).alias("last")), step, lambda a: a["n"])
    return F.when(F.size(words) >= 4, let(F.sort_array(grams(words)), lambda s: let(repeated(s), covered))).otherwise(0)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts of every document."""
    rows = docs.select(column(id_col).alias("doc_id"), column(lang_col).cast("string").alias("lang"), column(source_col).cast("string").alias("source"), text_of(text_col).alias("text"))
    w, n, text = _counts(F.col("text"))
    return rows.select("doc_id", "lang", "source", w.alias("w"), n.alias("l"), *text).select("doc_id", "lang", "source", "w.*", "l.*", "n_symbols", "n_marks", "n_chars")


def _counts(text: Column) -> tuple[Column, Column, list[Column]]:
    """Structs of the counts of words and of lines, and the counts of characters."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    per_text = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            _covered_by_repeats(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.char_length(x) <= SHORT)).cast("long").alias("n_short"),
            F.size(F.filter(w, lambda x: F.char_length(x) >= LONG)).cast("long").alias("n_long"),
        ),
    )
    per_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    counted = lambda pattern, name: F.regexp_count(text, F.lit(pattern)).cast("long").alias(name)
    return per_text, per_line, [counted(SYMBOLS, "n_symbols"), counted(MARKS, "n_marks"), F.char_length(text).cast("long").alias("n_chars")]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _scaled(name: str) -> Column:
    """A measure in thousandths, as a whole number of 0 or more."""
    part, whole = MEASURES[name]["of"]
    return F.expr(f"({part} * 1000) div greatest({whole}, 1)")


def bucket_of(value: Column) -> Column:
    """The lower end of the value's bucket: all but its nine leading bits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - 9, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, name, bucket, n: the sketches of documents that pass the base rule. At most 256 * 55 buckets each."""
    kinds = F.array(*(F.struct(F.lit(k).alias("name"), bucket_of(_scaled(k)).alias("bucket")) for k in MEASURES))
    return measured.filter(~base_failed()).select("lang", "source", F.inline(kinds)).groupBy("lang", "source", "name", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _fences(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of `keys` and measure: n, median, 20th and 80th percentile."""
    own = Window.partitionBy(*keys, "name")
    ranked = merged.withColumns({"total": F.sum("n").over(own), "upto": F.sum("n").over(own.orderBy("bucket"))})
    at = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("bucket")))
    return ranked.groupBy(*keys, "name").agg(F.max("total").alias("total"), at(50).alias("mid"), at(20).alias("low"), at(80).alias("high"))


def thresholds(sketched: DataFrame) -> DataFrame:
    """lang, source and columns <measure>_lo, <measure>_hi, each from the smallest merged group that is large enough."""
    merge = lambda keys: sketched.groupBy(*keys, "name", "bucket").agg(F.sum("n").alias("n"))
    at = ("mid", "low", "high")
    own = _fences(sketched, ["lang", "source"])
    lang = _fences(merge(["lang"]), ["lang"]).select(F.col("lang").alias("l_lang"), F.col("name").alias("l_name"), F.col("total").alias("l_total"), *(F.col(x).alias(f"l_{x}") for x in at))
    whole = _fences(merge([]), []).select(F.col("name").alias("a_name"), *(F.col(x).alias(f"a_{x}") for x in at))
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("name") == F.col("l_name"))).join(whole, F.col("name") == F.col("a_name"))
    pick = lambda x: F.when(F.col("total") >= MIN_GROUP, F.col(x)).when(F.col("l_total") >= MIN_GROUP, F.col(f"l_{x}")).otherwise(F.col(f"a_{x}"))
    chosen = joined.select("lang", "source", "name", *(pick(x).alias(x) for x in at))
    spread = lambda x: F.greatest(x, F.expr(f"mid div {FLOOR}"), F.lit(1))
    fences = []
    for name, m in MEASURES.items():
        mine = F.col("name") == name
        fences.append(F.max(F.when(mine, F.col("mid") + spread(F.col("high") - F.col("mid")) * m["factor"])).alias(f"{name}_hi"))
        fences.append(F.max(F.when(mine, F.col("mid") - spread(F.col("mid") - F.col("low")) * m["factor"] if m["low"] else F.lit(-1))).alias(f"{name}_lo"))
    return chosen.groupBy("lang", "source").agg(*fences)


WORD_COUNTS = ("n_words", "word_chars", "n_repeat_words", "n_short", "n_long")
LINE_COUNTS = ("n_lines", "n_dup_lines")
TEXT_COUNTS = ("n_symbols", "n_marks", "n_chars")


def judged(measured: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """`measured` (which is read twice, unless `counts` are its counts) with base_failed and kept."""
    limits = written(thresholds(sketches(measured if counts is None else counts)).withColumnsRenamed({"lang": "t_lang", "source": "t_source"}), "thresholds")
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_ROWS // 8 else limits
    within = F.lit(True)
    for name in MEASURES:
        within = within & _scaled(name).between(F.col(f"{name}_lo"), F.col(f"{name}_hi"))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True))).drop("t_lang", "t_source")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document. The counts are written once: they cost the scan."""
    return judged(written(measure(docs, id_col, text_col, lang_col, source_col), "measured")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of `docs` that the rules keep.

    The counts are written with their rows, so that each row is judged where it is: null ids and repeated rows are rows like
    any other, an empty table stays empty, and other columns may have any names.
    """
    own = unused(docs.columns, "measured")
    w, n, text = _counts(text_of(text_col))
    group = [column(lang_col).cast("string").alias("lang"), column(source_col).cast("string").alias("source")]
    rows = docs.select(*map(column, docs.columns), F.struct(*group, w.alias("w"), n.alias("l"), *text).alias(own))
    rows = written(rows, "measured")
    of = lambda name: column(own).getField(name)
    flat = F.struct(of("lang").alias("lang"), of("source").alias("source"), *(of("w").getField(x).alias(x) for x in WORD_COUNTS), *(of("l").getField(x).alias(x) for x in LINE_COUNTS), *(of(x).alias(x) for x in TEXT_COUNTS))
    counts = rows.select(flat.alias("m")).select("m.*")
    whole = rows.select(F.struct(*map(column, docs.columns)).alias("row"), flat.alias("m")).select("row", "m.*")
    return judged(whole, counts).filter("kept").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op3_sql(documents: str = "documents") -> str:
    """The same rules in SQL, the counts by unnesting."""
    scaled = lambda where: " UNION ALL ".join(f"SELECT doc_id, lang, source, '{k}' AS name, ({m['of'][0]} * 1000) // greatest({m['of'][1]}, 1) AS v FROM m {where}" for k, m in MEASURES.items())
    inline, measured = scaled("WHERE NOT base_failed"), scaled("")
    facts = ", ".join(f"('{k}', {m['factor']}, {'true' if m['low'] else 'false'})" for k, m in MEASURES.items())
    at = lambda percent: f"min(CASE WHEN upto * 100 >= total * {percent} THEN bucket END)"
    pick = lambda x: f"CASE WHEN own.total >= {MIN_GROUP} THEN own.{x} WHEN lg.total >= {MIN_GROUP} THEN lg.{x} ELSE al.{x} END AS {x}"
    ranks = lambda keys: f"SELECT {keys}{', ' if keys else ''}name, total, {at(50)} AS mid, {at(20)} AS low, {at(80)} AS high FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}{', ' if keys else ''}name) AS total, sum(n) OVER (PARTITION BY {keys}{', ' if keys else ''}name ORDER BY bucket) AS upto FROM (SELECT {keys}{', ' if keys else ''}name, bucket, count(*) AS n FROM s GROUP BY ALL)) GROUP BY ALL"
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM {documents}),
w AS (SELECT doc_id, lang, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
pos AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS k0, words FROM w WHERE len(words) >= 3),
grams AS (SELECT doc_id, k0, words[k0] || chr(10) || words[k0 + 1] || chr(10) || words[k0 + 2] AS gram FROM pos),
rep AS (SELECT doc_id, k0 FROM (SELECT doc_id, k0, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([k0, k0 + 1, k0 + 2]) AS k FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
m0 AS (SELECT w.doc_id, w.lang, w.source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
       len(list_filter(words, lambda x: length(x) <= {SHORT})) AS n_short, len(list_filter(words, lambda x: length(x) >= {LONG})) AS n_long,
       len(regexp_extract_all(text, '{MARKS}')) AS n_marks, length(text) AS n_chars, len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
       FROM w JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
s0 AS ({inline}),
s AS (SELECT *, (v >> greatest(length(bin(v)) - 9, 0)) << greatest(length(bin(v)) - 9, 0) AS bucket FROM s0),
own AS ({ranks("lang, source")}), lg AS ({ranks("lang")}), al AS ({ranks("")}),
pick AS (SELECT own.lang, own.source, own.name, {pick("mid")}, {pick("low")}, {pick("high")}
         FROM own JOIN lg ON own.lang IS NOT DISTINCT FROM lg.lang AND own.name = lg.name JOIN al ON own.name = al.name),
fact(name, factor, both_ends) AS (VALUES {facts}),
v AS ({measured}),
bad AS (SELECT DISTINCT v.doc_id FROM v JOIN pick ON v.lang IS NOT DISTINCT FROM pick.lang AND v.source IS NOT DISTINCT FROM pick.source AND v.name = pick.name JOIN fact ON v.name = fact.name
        WHERE v.v > mid + greatest(high - mid, mid // {FLOOR}, 1) * factor OR both_ends AND v.v < mid - greatest(mid - low, mid // {FLOOR}, 1) * factor)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM m LEFT JOIN bad USING (doc_id)
"""
