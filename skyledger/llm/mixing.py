"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (expected copies) as near to 1 as possible in entropy, such that the tokens of each
source meet the source's target. With rates kept between 0 and CAP, the solution is an exponential tilt by a
document's size, rate = CAP * e / (CAP - 1 + e) with e = exp(tilt * size / mean size), one tilt for each source:
the solution of a convex dual problem. Documents of a source and size share a rate, so the dual's gradient and
curvature are sums over cells (source, size, bucket); each Newton step is one distributed aggregation, with
bisection bounds as a guard. Rates are rounded into whole copies by running sums over a source's cells in order
of size: the copies of any prefix differ by less than one from the sum of rates, so a source's tokens differ
from their target by about one document's size at most; a few settling rounds then move extra copies between
rows of fitting size until the rest is below that of small documents. Within a cell the documents of smallest digest get the
extra copy; large cells are split into buckets by digest, so that none is ranked in one task.

Results for special input: a null text has size 0 and takes 0 copies' words; null is a source of its own, after all
others; a very long text is a size like any other; a null id has one digest; repeated rows each give a row (their order within the cell is that of equal
digests, so which of them has the extra copy doesn't show); an empty table gives an empty result; other columns
are ignored by `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm._common import WORD, column, table, text_of, unused, written

WEIGHTS = (5, 2, 1)
#: The mix has so many percent of all tokens; a document comes CAP times at most, and so does a source.
SHARE_PERCENT = 150
CAP = 2
#: A cell with more documents is split into buckets.
CELL_ROWS = 100_000
#: Newton steps between two writings of the tilts, the residual (as a share of the target) that ends them, and the steps
#: after which a tilt that has not met it is an error (bisection alone is through in half as many).
CUT_EVERY = 4
CLOSE = 1e-7
STEPS = 200


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """source, source_size, target from a row (source, source_size) for each source.

    Sources by code point, null last, weigh `weights` in turn. What a target has above cap * source_size goes to
    the others by weight: sources are capped in order of cap * source_size / weight while their share of what is
    left would be above. Works on one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int")
    weighed = sizes.withColumn("weight", F.element_at(F.lit([float(x) for x in weights]), turn + 1)).withColumn("most", F.col("source_size") * float(cap))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    running = weighed.withColumns(
        {
            "before": F.sum("most").over(by_ratio) - F.col("most"),
            "left_weight": F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"),
            "whole": F.sum("source_size").over(everything) * (percent / 100),
        }
    )
    level = F.try_divide(F.greatest(F.col("whole") - F.col("before"), F.lit(0.0)), F.col("left_weight"))
    leveled = running.withColumn("level", F.when(F.col("most") >= level * F.col("weight"), level))
    # The first source that isn't capped has the level of all that follow.
    return leveled.withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("most") / F.col("weight"))).over(everything)).select(
        "source", "source_size", F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target")
    )


def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    """cap / (1 + (cap - 1) * exp(-tilt * size / mean)); exponents are bounded so that it never overflows."""
    x = F.greatest(F.least(tilt * size / mean, F.lit(500.0)), F.lit(-500.0))
    return F.lit(float(cap)) / (F.lit(1.0) + F.lit(cap - 1.0) * F.exp(-x))


def tilts(cells: DataFrame, aims: DataFrame, cap: int = CAP, steps: int = STEPS) -> DataFrame:
    """source, target, mean, tilt: Newton's iterations on the dual, each one aggregation over the cells.

    cells: source, size, n. A source whose target is cap times its size has every document cap times (tilt null).
    """
    start = aims.join(cells.groupBy(F.col("source").alias("c_source")).agg(F.sum("n").alias("docs")), F.col("source").eqNullSafe(F.col("c_source"))).select(
        "source", "source_size", "target", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)).alias("mean"), F.lit(0.0).alias("tilt"), F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"), F.lit(1.0).alias("off")
    )
    full = F.col("target") >= F.col("source_size") * float(cap)
    state = written(start.filter(~full), "tilts")
    slim = cells.filter("size > 0").select(F.col("source").alias("c_source"), "size", "n")
    for step in range(1, steps + 1):
        rate = _rate(F.col("tilt"), F.col("size").cast("double"), F.col("mean"), cap)
        tokens = F.col("n") * F.col("size").cast("double")
        summed = (
            state.join(slim, F.col("source").eqNullSafe(F.col("c_source")))
            .groupBy("source", "source_size", "target", "mean", "tilt", "lo", "hi")
            .agg(F.sum(tokens * rate).alias("got"), F.sum(tokens * F.col("size") / F.col("mean") * rate * (F.lit(1.0) - rate / cap)).alias("slope"))
        )
        gap = F.col("got") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        bounded = summed.select("source", "source_size", "target", "mean", "tilt", lo.alias("lo"), hi.alias("hi"), F.try_divide(gap, F.col("slope")).alias("move"), (F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))).alias("off"))
        newton = F.col("tilt") - F.col("move")
        inside = newton.isNotNull() & (newton > F.col("lo")) & (newton < F.col("hi"))
        state = bounded.select("source", "source_size", "target", "mean", F.when(F.col("off") <= CLOSE, F.col("tilt")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2).alias("tilt"), "lo", "hi", "off")
        if step % CUT_EVERY == 0:
            state = written(state, "tilts")
            if not state.filter(F.col("off") > CLOSE).limit(1).count():
                break
    else:
        raise ArithmeticError(f"tilts of {state.filter(F.col('off') > CLOSE).count()} sources have not converged in {steps} steps")
    return state.unionByName(start.filter(full).withColumn("tilt", F.lit(None).cast("double")))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, row (the number of the row, if it has one, else null), source, size (words of the text)."""
    row = F.lit(None).cast("long") if row_col is None else column(row_col)
    return docs.select(column(id_col).alias("doc_id"), row.alias("row"), column(source_col).cast("string").alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))


def copies(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, row, source, size, source_size, target, rate, copies for rows of doc_id, source, size (which are read three times).

    `row`, null where the rows have none, tells rows of one id apart."""
    if "row" not in rows.columns:
        rows = rows.withColumn("row", F.lit(None).cast("long"))
    by_size = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    aims = written(targets(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, percent, cap), "targets")
    solved = tilts(by_size, aims, cap)
    rate = F.coalesce(_rate(F.col("tilt"), F.col("size").cast("double"), F.col("mean"), cap), F.lit(float(cap)))
    cells = by_size.withColumnRenamed("source", "c_source").join(solved, F.col("source").eqNullSafe(F.col("c_source"))).select(
        "c_source", F.col("size").alias("c_size"), "source_size", "target", rate.alias("rate"), F.ceil(F.col("n") / cell_rows).alias("buckets")
    )
    cells = written(cells, "rates")
    digest = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("mix"))
    placed = rows.join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size"))).drop("c_source", "c_size")
    placed = placed.withColumn("digest", digest).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.col("buckets")))
    own = ["source", "size", "bucket"]
    filled = placed.groupBy(*own).agg(F.count(F.lit(1)).alias("rows"), F.max("rate").alias("rate"))
    part = F.col("rows") * (F.col("rate") - F.floor("rate"))
    before = Window.partitionBy("source").orderBy("size", "bucket")
    upto = F.floor(F.sum(part).over(before) + 0.5)
    quota = filled.withColumn("upto", upto).withColumn("extra", F.col("upto") - F.coalesce(F.lag("upto").over(before), F.lit(0)))
    quota = _settled(quota.drop("upto"), aims, cap)
    quota = quota.select(F.col("source").alias("q_source"), F.col("size").alias("q_size"), F.col("bucket").alias("q_bucket"), "extra")
    ranked = placed.withColumn("nth", F.row_number().over(Window.partitionBy(*own).orderBy("digest", "doc_id", "row")))
    joined = ranked.join(quota, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")) & (F.col("bucket") == F.col("q_bucket")))
    return joined.select("doc_id", "row", "source", "size", "source_size", "target", "rate", F.least(F.floor("rate") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0), F.lit(cap)).cast("long").alias("copies"))


def _settled(quota: DataFrame, aims: DataFrame, cap: int) -> DataFrame:
    """`quota` (source, size, bucket, rows, rate, extra) with extra copies moved so that what a source's tokens
    still differ from its target by shrinks: each round changes the cell of the largest size that fits in the rest, until
    none does. A round at least halves a rest, unless its cell runs out of rows."""
    c = F.col
    quota = written(quota, "quota")
    while True:
        tokens = c("size") * (c("rows") * F.floor("rate") + c("extra"))
        rest = quota.groupBy(c("source").alias("r_source")).agg(F.sum(tokens).alias("got"))
        rest = rest.join(aims.select(c("source").alias("a_source"), "target"), c("r_source").eqNullSafe(c("a_source"))).select("r_source", (c("got") - c("target")).alias("rest"))
        room = F.when(c("rest") > 0, c("extra")).otherwise(c("rows") - c("extra"))
        fits = (c("size") > 0) & (c("size") <= F.abs("rest")) & (c("rate") > F.floor("rate")) & (room > 0)
        move = -F.signum("rest") * F.least(room, F.floor(F.abs("rest") / c("size")))
        seen = quota.join(rest, c("source").eqNullSafe(c("r_source"))).filter(fits)
        # One row for each source.
        best = seen.groupBy(c("source").alias("b_source")).agg(F.max(F.struct("size", (-c("bucket")).alias("turn"), move.cast("long").alias("move"))).alias("b"))
        best = written(best.select("b_source", c("b.size").alias("b_size"), (-c("b.turn")).alias("b_bucket"), c("b.move").alias("move")), "moves")
        if not best.limit(1).count():
            return quota
        moved = quota.join(best, c("source").eqNullSafe(c("b_source")) & (c("size") == c("b_size")) & (c("bucket") == c("b_bucket")), "left")
        quota = written(moved.withColumn("extra", c("extra") + F.coalesce("move", F.lit(0))).drop("b_source", "b_size", "b_bucket", "move"), "quota")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies."""
    return copies(written(sized(docs, id_col, text_col, source_col), "sized"), weights, percent, cap).drop("row")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs` with each row as often as its copies say.

    Rows get a number, written down with them, by which they meet their copies: null ids and repeated rows are rows like any
    other, an empty table stays empty, and other columns may have any names.
    """
    row, times, nth = (unused(docs.columns, name) for name in ("row", "times", "nth"))
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = written(sized(numbered, id_col, text_col, source_col, row), "sized")
    taken = copies(rows).filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(times))
    repeated = numbered.join(taken, row).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), column(times))))
    return repeated.select(*map(column, docs.columns))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "rate")
