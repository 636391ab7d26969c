"""Fits and smooth curves per group: closed forms as aggregates, sequential kernels in numpy per group."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skyledger.operators.smooth import curve_places


def line(x: str, y: str) -> dict[str, Column]:
    """Slope and intercept of y on x, one pass."""
    return {"slope": F.regr_slope(F.col(y), F.col(x)), "intercept": F.regr_intercept(F.col(y), F.col(x))}


def _det3(m: list[list[Column]]) -> Column:
    return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])


def _solve3(matrix: list[list[Column]], right: list[Column]) -> list[Column]:
    """Cramer's rule; null for a singular matrix."""
    det = _det3(matrix)
    swapped = lambda k: [[right[i] if j == k else matrix[i][j] for j in range(3)] for i in range(3)]
    return [F.try_divide(_det3(swapped(k)), det) for k in range(3)]


def normal_fit(rows: DataFrame, group: list[str], terms: list[Column], y: Column, names: list[str], weight: Column | None = None) -> DataFrame:
    """Weighted least squares of y on three terms per group: sums in one aggregation, then a closed form."""
    w = F.lit(1.0) if weight is None else weight
    sums = {f"m{i}{j}": F.sum(w * terms[i] * terms[j]) for i in range(3) for j in range(i, 3)} | {f"r{i}": F.sum(w * terms[i] * y) for i in range(3)}
    got = rows.groupBy(*group).agg(*(v.alias(k) for k, v in sums.items()), F.count(F.lit(1)).alias("n"))
    m = [[F.col(f"m{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    return got.select(*group, "n", *(v.alias(k) for k, v in zip(names, _solve3(m, [F.col(f"r{i}") for i in range(3)]), strict=True)))


def quadratic(rows: DataFrame, group: list[str], x: str, y: str, weight: Column | None = None) -> DataFrame:
    """y = a x^2 + b x + c per group."""
    v = F.col(x)
    return normal_fit(rows, group, [v * v, v, F.lit(1.0)], F.col(y), ["a", "b", "c"], weight)


def plane(rows: DataFrame, group: list[str], x: str, y: str, z: str) -> DataFrame:
    """z = a x + b y + c per group."""
    return normal_fit(rows, group, [F.col(x), F.col(y), F.lit(1.0)], F.col(z), ["a", "b", "c"])


def scale_rotation(rows: DataFrame, group: list[str], x1: str, y1: str, x2: str, y2: str) -> DataFrame:
    """Scale and rotation (degrees) that carry the first points to the second ones, about their centroids, by least squares."""
    c = F.covar_pop
    summed = rows.groupBy(*group).agg(c(x1, x2).alias("xx"), c(y1, y2).alias("yy"), c(x1, y2).alias("xy"), c(y1, x2).alias("yx"), (F.var_pop(x1) + F.var_pop(y1)).alias("v1"), (F.var_pop(x2) + F.var_pop(y2)).alias("v2"))
    return summed.select(*group, F.sqrt(F.try_divide(F.col("v2"), F.col("v1"))).alias("scale"), F.degrees(F.atan2(F.col("xy") - F.col("yx"), F.col("xx") + F.col("yy"))).alias("rotation"))


def with_group(rows: DataFrame, stats: DataFrame, group: list[str], how: str = "inner") -> DataFrame:
    """`rows` with the columns of their group's row of `stats`; a null group is a group."""
    other = stats.withColumnsRenamed({g: f"_of_{g}" for g in group})
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]
    return rows.join(other, same, how).drop(*(f"_of_{g}" for g in group)) if group else rows.crossJoin(stats)


def sigma_clipped(rows: DataFrame, group: list[str], value: str, sigma: float = 3.0, rounds: int | None = None) -> DataFrame:
    """Rows within `sigma` population deviations of the group's median, `rounds` times over or, without a number, until
    nothing changes. Statistics are joined back; each round is checkpointed, so that it is read, not computed, twice."""
    out, left, done = rows, None, 0
    while rounds is None or done < rounds:
        out = checkpointed(out)
        if rounds is None:
            before, left = left, out.count()
            if before == left:
                break
        stats = out.groupBy(*group).agg(F.median(value).alias("_mid"), F.stddev_pop(value).alias("_dev"))
        out = with_group(out, stats, group).filter(F.abs(F.col(value) - F.col("_mid")) <= F.col("_dev") * sigma).drop("_mid", "_dev")
        done += 1
    return out


def density_grid(rows: DataFrame, group: str, value: str, low: float, step: float, points: int, width: float) -> DataFrame:
    """Gaussian kernel density of each group on a grid; each row adds to the grid points within five widths only."""
    reach = 5 * width
    first = F.greatest(F.ceil((F.col(value) - reach - low) / step), F.lit(0))
    last = F.least(F.floor((F.col(value) + reach - low) / step), F.lit(points - 1))
    near = rows.select(group, value, F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))).alias("i"))
    kernel = F.exp(-F.pow((F.lit(low) + F.col("i") * step - F.col(value)) / width, 2) / 2)
    total = rows.groupBy(group).agg(F.count(value).alias("_n"))
    return near.groupBy(group, "i").agg(F.sum(kernel).alias("_k")).join(total, group).select(group, (F.lit(low) + F.col("i") * step).alias("grid"), (F.col("_k") / (F.col("_n") * width * float(np.sqrt(2 * np.pi)))).alias("density"))


def density_support(grid: DataFrame, group: str, share: float = 0.2) -> DataFrame:
    """Mode, and first and last grid point with more than `share` of the greatest density."""
    top = F.max("density").over(Window.partitionBy(group))
    dense = F.when(F.col("density") > F.col("_top") * share, F.col("grid"))
    return grid.withColumn("_top", top).groupBy(group).agg(F.max_by("grid", F.struct("density", -F.col("grid"))).alias("mode"), F.min(dense).alias("low"), F.max(dense).alias("high"))


#: Points of a group that stay together when values of its curve are found.
TOGETHER = 200_000


def group_parts(points: DataFrame, group: str) -> DataFrame:
    """group, _parts of the groups that have more than TOGETHER points: fewer rows than the points have hundred thousands."""
    return points.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("_parts")).where("_parts > 1")


def interpolated(points: DataFrame, curve: DataFrame, group: str, x: str, curve_x: str = "cx", curve_y: str = "cy", name: str = "value", parts: DataFrame | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """Piecewise-linear values of each group's curve at the points, its end segments extended; `more`: other values of the knots, by the names of
    their columns at the points.

    Points and knots are merged in one ordering per group; each point takes the segment that holds it. Points of the groups in `parts`
    (of group_parts, if there are large ones) are dealt out by a hash, and each part gets the group's knots.
    """
    w = Window.partitionBy(group).orderBy(curve_x)
    values = {name: curve_y} | (more or {})
    ends = {f"_y{k}{end}": v for k, c in enumerate(values.values()) for end, v in enumerate((F.col(c), F.lead(c).over(w)))}
    segment = curve.select(group, F.col(curve_x).alias("_x0"), F.lead(curve_x).over(w).alias("_x1"), *(v.alias(n) for n, v in ends.items()), F.row_number().over(w).alias("_k")).filter("_x1 IS NOT NULL")
    knots = segment.select(group, F.when(F.col("_k") == 1, F.lit(float("-inf"))).otherwise(F.col("_x0")).alias("_at"), F.lit(0).alias("_kind"), F.struct("_x0", "_x1", *ends).alias("_seg"))
    seen = points.select("*", F.col(x).cast("double").alias("_at"), F.lit(1).alias("_kind"))
    if parts is None:
        seen, knots = (df.withColumn("_part", F.lit(0).cast("long")) for df in (seen, knots))
    else:
        count = F.coalesce("_parts", F.lit(1).cast("long"))
        whole = [f"`{f.name}`" for f in points.schema if not isinstance(f.dataType, T.MapType)]
        seen, knots = (with_group(df, F.broadcast(parts), [group], "left") for df in (seen, knots))
        seen = seen.withColumn("_part", F.pmod(F.xxhash64(*whole), count)).drop("_parts")
        knots = knots.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).drop("_parts")
    both = seen.unionByName(knots, allowMissingColumns=True)
    order = Window.partitionBy(group, "_part").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_seg", F.last("_seg", ignorenulls=True).over(order)).filter("_kind = 1")
    s = F.col("_seg")
    between = {n: s[f"_y{k}0"] + (F.col("_at") - s["_x0"]) * F.try_divide(s[f"_y{k}1"] - s[f"_y{k}0"], s["_x1"] - s["_x0"]) for k, n in enumerate(values)}
    return held.withColumns(between).drop("_at", "_kind", "_seg", "_part")


def lowess(x: np.ndarray, y: np.ndarray, share: float = 2 / 3, rounds: int = 3, delta: float = 0.0) -> np.ndarray:
    """Robust locally weighted lines (Cleveland 1979), x ascending: tricube weights over the nearest share of points,
    bisquare reweighting, and linear interpolation over points closer than delta."""
    return np.interp(x, *curve_places(x, y, share, rounds, delta))


def lowess_counted(x: np.ndarray, y: np.ndarray, times: np.ndarray, share: float = 2 / 3, rounds: int = 3, delta: float = 0.0) -> np.ndarray:
    """As `lowess` for points of which each stands for as many as `times` says, without repeating them; x ascending.

    The points that a window has only some of at the same x lie at its reach, where the weight is 0, so that all of them
    may be taken; where all of a window's points have the same x, it takes all that have, in place of the first of them."""
    start = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    place, stop = x[start], np.append(start[1:], len(x))
    of = np.repeat(np.arange(len(place)), stop - start)
    # Numbers of the repeated points before the end of each place.
    ends = np.cumsum(times)[stop - 1].tolist()
    n = ends[-1]
    k = min(n, max(2, int(share * n + 1e-10)))
    fitted, robust = np.zeros(len(place)), np.ones(len(x))
    for step in range(rounds + 1):
        left, last, i = 0, -1, 0
        while True:
            high = n - k
            while left < high:
                middle = (left + high) // 2
                left, high = (middle + 1, high) if place[i] - place[bisect_right(ends, middle)] > place[bisect_right(ends, middle + k)] - place[i] else (left, middle)
            first, final = bisect_right(ends, left), bisect_right(ends, left + k - 1)
            near = slice(start[first], stop[final])
            reach = max(place[i] - place[first], place[final] - place[i])
            far = np.abs(x[near] - place[i])
            u = far / max(reach, 1e-300)
            cube = 1 - u * u * u
            w = np.where(far <= 0.999 * reach, np.where(far > 0.001 * reach, cube * cube * cube, 1.0), 0.0) * robust[near] * times[near]
            total = w.sum()
            if total <= 0:
                own = slice(start[i], stop[i])
                fitted[i] = (y[own] * times[own]).sum() / times[own].sum()
            else:
                w /= total
                mean = (w * x[near]).sum()
                spread = (w * (x[near] - mean) ** 2).sum()
                if spread**0.5 > 0.001 * (x[-1] - x[0]):
                    w = w * (1 + (place[i] - mean) * (x[near] - mean) / spread)
                fitted[i] = (w * y[near]).sum()
            if last < i - 1:
                run = slice(last + 1, i)
                part = (place[run] - place[last]) / (place[i] - place[last])
                fitted[run] = part * fitted[i] + (1 - part) * fitted[last]
            last = i
            i = max(last + 1, int(np.searchsorted(place, place[i] + delta, "right")) - 1)
            if last >= len(place) - 1:
                break
        if step < rounds:
            rest = np.abs(y - fitted[of])
            order = np.argsort(rest, kind="stable")
            upto = np.cumsum(times[order])
            scale = 6 * rest[order[np.searchsorted(upto, [(n - 1) // 2, n // 2], "right")]].mean()
            if scale <= 0:
                break
            robust = np.where(rest <= 0.001 * scale, 1.0, np.where(rest <= 0.999 * scale, (1 - np.minimum(rest / scale, 1) ** 2) ** 2, 0.0))
    return fitted[of]


def lowess_share(n: int) -> float:
    """Share of points for a calibration curve: 0.2, up to 0.5 for fewer than 500."""
    return 0.2 if n >= 500 else 0.2 + 0.3 * (500 - n) / 500


def lowess_curves(rows: DataFrame, group: str, x: str, y: str, key: str, rounds: int = 0, delta: float = 0.1) -> DataFrame:
    """group, key, x, fitted; a group is a plate's or a solution's stars, which fit in one task."""
    kind = rows.select(group).schema[0].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[x, y]).sort_values([x, key])
        values = lowess(pdf[x].to_numpy(float), pdf[y].to_numpy(float), lowess_share(len(pdf)), rounds, delta) if len(pdf) > 1 else pdf[y].to_numpy(float)
        return pd.DataFrame({group: pdf[group], key: pdf[key], x: pdf[x], "fitted": values})

    return rows.select(group, key, x, y).groupBy(group).applyInPandas(fit, f"{group} {kind}, {key} long, {x} double, fitted double")


def dbscan_labels(points: DataFrame, id_col: str, radius: float, least: int, x: str = "x", y: str = "y") -> DataFrame:
    """Density clusters in the plane: id, label (the least id of its core points; null for noise).

    Core points have `least` neighbours or more within the radius, themselves included; clusters are the connected core
    points, and a border point joins the least of its neighbours' clusters. A grid join, an aggregation and rounds of connected tiles.
    """
    from skyledger.operators.crossmatch import members_of, pairs_within, places_of

    # Points at the same place share their neighbours, so a place is one node with a weight.
    members = members_of(points, id_col, x, y)
    places = checkpointed(places_of(members, F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")))
    labels = density_labels(places, pairs_within(places, places, radius, "node", "node", inclusive=True), "node", least, {"x": radius, "y": radius}, (), "weight")
    named = _shuffled(places.select("place", "node"), labels, ["node"]).select("place", "label")
    found = _shuffled(members, named, ["place"]).groupBy(F.col("id").alias(id_col)).agg(F.min("label").alias("label"))
    return _shuffled(points.select(id_col), found, [id_col], "left")


def dbscan_in(points: DataFrame, id_col: str, widths: dict[str, float], least: int, groups: tuple[str, ...] = ()) -> DataFrame:
    """As `dbscan_labels`, in any number of dimensions, each axis with a width of its own (ellipsoids), and apart for each group."""
    from skyledger.operators.crossmatch import grid_pairs

    return density_labels(points, grid_pairs(points, points, id_col, id_col, widths, list(groups)), id_col, least, widths, groups)


def _dense(at: np.ndarray, ids: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Label of each row of `at` (coordinates in units of their width): the least id of its cluster's core points, -1 for noise."""
    order = np.argsort(at[:, 0], kind="stable")
    at, ids, least = at[order], ids[order], least[order]
    ones, others = [], []
    for k in range(0, len(at), 256):
        # Those within the width along the first axis, and a little more, for rounding.
        block = at[k : k + 256]
        first, last = np.searchsorted(at[:, 0], block[0, 0] - 1.000001, "left"), np.searchsorted(at[:, 0], block[-1, 0] + 1.000001, "right")
        square = np.zeros((len(block), last - first))
        for axis in range(at.shape[1]):
            square += (block[:, axis, None] - at[None, first:last, axis]) ** 2
        one, other = np.nonzero(np.sqrt(square) <= 1)
        ones.append(one + k)
        others.append(other + first)
    one, other = np.concatenate(ones), np.concatenate(others)
    core = np.bincount(one, minlength=len(at)) >= least
    beyond = np.iinfo(np.int64).max
    label = np.where(core, np.arange(len(at))[np.argsort(ids, kind="stable").argsort()], beyond)
    inner = core[one] & core[other]
    a, b = one[inner], other[inner]
    by_rank = np.argsort(ids, kind="stable")
    while True:
        lower = label.copy()
        np.minimum.at(lower, a, label[b])
        lower[core] = np.minimum(lower[core], lower[by_rank[lower[core]]])
        if (lower == label).all():
            break
        label = lower
    beside = ~core[one] & core[other]
    np.minimum.at(label, one[beside], label[other[beside]])
    out = np.full(len(at), -1, np.int64)
    found = label < beyond
    out[order[found]] = ids[by_rank[label[found]]]
    return out


def clusters_each(rows: DataFrame, group: str, id_col: str, axes: dict[str, float], least: str) -> DataFrame:
    """`rows` of density clusters with their label, as those of `dbscan_in` (least: a column), for groups that are small: the brightest
    detections of one plate. A group is clustered in one task, so that no pair of neighbours is shuffled or stored."""
    kept = rows.where(" AND ".join(f"abs({c}) < double('inf')" for c in axes) + f" AND {group} IS NOT NULL")

    def run(table: pa.Table) -> pa.Table:
        at = np.stack([table.column(c).to_numpy() / width for c, width in axes.items()], axis=1)
        label = _dense(at, table.column(id_col).to_numpy(), table.column(least).to_numpy())
        return table.append_column("label", pa.array(label, pa.int64())).filter(pa.array(label >= 0))

    return kept.groupBy(group).applyInArrow(run, T.StructType([*kept.schema.fields, T.StructField("label", T.LongType())]))


def _shuffled(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that broadcasts neither side: their size isn't that of the files they come from."""
    return a.join(b.hint("merge"), on, how)


def _forest(table: pa.Table) -> pa.Table:
    """node, root (the least node it is linked to, by any way) of all nodes of the links a, b."""
    node = table.schema.field("a").type
    codes, names = pd.factorize(np.concatenate([table.column(c).to_numpy() for c in ("a", "b")]), sort=True)
    one, other = codes[: len(table)], codes[len(table) :]
    root = np.arange(len(names))
    while True:
        low, lower = np.minimum(root[one], root[other]), root.copy()
        for end in (one, other):
            np.minimum.at(lower, root[end], low)
        while (lower != (up := lower[lower])).any():
            lower = up
        if (lower == root).all():
            return pa.table([pa.array(names, node), pa.array(names[root], node)], names=["node", "root"])
        root = lower


def connected(placed: DataFrame, links: DataFrame, axes: int) -> DataFrame:
    """node, label (the least node of its component) of nodes with their cell (a struct `at`; the last `axes` fields are whole numbers), by links
    (a, b, given once) between near cells. Nodes of one cell are connected.

    Cells become one node each. Then square tiles of cells are connected within, each in a task, and are one node for each of their parts in the
    links that leave them; the next tiles are wider. So a task has the links of a few cells, or of the borders of the tiles in its own, and
    the rounds go with the logarithm of the width, not with the length of the ways."""
    fields = placed.schema["at"].dataType.fieldNames()
    own, cells = fields[: len(fields) - axes], fields[len(fields) - axes :]
    least = placed.agg(*(F.min(f"at.{c}").alias(c) for c in cells)).first()
    kind = placed.schema["node"].dataType.simpleString()
    placed = placed.select("node", F.struct(*(F.col(f"at.{g}") for g in own), *((F.col(f"at.{c}") - F.lit(least[c])).alias(c) for c in cells)).alias("at"))
    state = checkpointed(_shuffled(placed, placed.groupBy("at").agg(F.min("node").alias("label")), ["at"]).select("node", "label", "at"))
    bits = max(1, 8 // axes)
    wider = lambda at: F.struct(*(F.col(f"{at}.{g}") for g in own), *(F.shiftright(f"{at}.{c}", bits).alias(c) for c in cells)).alias(at)

    def renamed(links: DataFrame, names: DataFrame, how: str, *columns: Column | str) -> DataFrame:
        for end in ("a", "b"):
            links = _shuffled(links, names.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"), *(F.col(c).alias(f"{end}_{c}") for c in columns)), [end], how)
        return links.withColumns({end: F.coalesce(f"_{end}", end) for end in ("a", "b")}).where("a <> b").select("a", "b", "a_at", "b_at").distinct()

    links, labels = checkpointed(renamed(links, state, "inner", "at")), state.select("node", "label")
    while not links.isEmpty():
        links = links.select("a", "b", wider("a_at"), wider("b_at"))
        roots = checkpointed(links.where("a_at = b_at").groupBy("a_at").applyInArrow(lambda table: _forest(table), f"node {kind}, root {kind}")).withColumnRenamed("root", "label")
        labels = checkpointed(_shuffled(labels, roots.select(F.col("node").alias("label"), F.col("label").alias("_root")), ["label"], "left").select("node", F.coalesce("_root", "label").alias("label")))
        links = checkpointed(renamed(links.where("a_at <> b_at"), roots, "left"))
    return labels


def density_labels(points: DataFrame, pairs: DataFrame, id_col: str, least: int | str, axes: dict[str, float], groups: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """Density clusters by pairs of neighbours (left_id, right_id, each point with itself, each pair both ways), which are those within the widths of
    `axes` in the same group; `least`: a number, or a column of `points`; `weight`: a column of `points`, how many neighbours each one counts for (1)."""
    pairs = checkpointed(pairs.select("left_id", "right_id"))
    n = F.count(F.lit(1)) if weight is None else F.sum("_weight")
    weighed = pairs if weight is None else _shuffled(pairs, points.select(F.col(id_col).alias("right_id"), F.col(weight).alias("_weight")), ["right_id"])
    counts = weighed.groupBy("left_id").agg(n.alias("n"))
    if isinstance(least, str):
        counts = _shuffled(counts, points.select(F.col(id_col).alias("left_id"), F.col(least).alias("_least")), ["left_id"])
    core = checkpointed(counts.filter(F.col("n") >= (F.col("_least") if isinstance(least, str) else least)).select(F.col("left_id").alias("node")))
    # Cells whose diagonal is below the width: their core points are neighbours.
    split = int(len(axes) ** 0.5) + 1
    at = F.struct(*(F.col(g).alias(f"g{k}") for k, g in enumerate(groups)), *(F.floor(F.col(c).cast("double") / width * split).cast("long").alias(f"c{k}") for k, (c, width) in enumerate(axes.items())))
    placed = checkpointed(_shuffled(points.select(F.col(id_col).alias("node"), *groups, *axes), core, ["node"]).select("node", at.alias("at")))
    once = pairs.filter("left_id < right_id").select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    labels = connected(placed, once, len(axes))
    # A core point has its label; the others take the least of the core points beside them.
    outer = _shuffled(pairs, core.select(F.col("node").alias("left_id")), ["left_id"], "left_anti").withColumnRenamed("right_id", "node")
    border = _shuffled(outer, labels, ["node"]).groupBy("left_id").agg(F.min("label").alias("label")).withColumnRenamed("left_id", "node")
    return _shuffled(points.select(id_col), labels.unionByName(border).withColumnRenamed("node", id_col), [id_col], "left")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the folder that spark.checkpoint.dir names; a local session without one gets a temporary one."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        import tempfile

        if not df.sparkSession.conf.get("spark.checkpoint.dir", None) and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="skyledger-"))
    return df.checkpoint()
