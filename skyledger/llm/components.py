"""Connected components of a graph given by its edges, with written tables between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm._common import written


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node, comp (the least node of its component) for edges (a, b); `labels` are known components to start from.

    A round takes the least label among neighbours and then the label's own label, so paths shorten by half.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    nodes = both.select(F.col("a").alias("node"), F.col("a").alias("comp"))
    state = written((nodes if labels is None else nodes.unionByName(labels.select("node", "comp"))).groupBy("node").agg(F.min("comp").alias("comp")), "labels")
    while True:
        near = both.join(state, both["b"] == state["node"]).groupBy(F.col("a").alias("near_node")).agg(F.min("comp").alias("near"))
        # A component known before whose label falls takes all its nodes along by way of the label's own row.
        lower = state.join(near, state["node"] == near["near_node"], "left").select("node", F.least("comp", F.coalesce("near", "comp")).alias("comp"), F.col("comp").alias("was"))
        pulled = lower.filter("comp < was").select(F.col("was").alias("node"), F.col("comp").alias("pull")).groupBy("node").agg(F.min("pull").alias("pull"))
        lower = written(lower.join(pulled, "node", "left").select("node", F.least("comp", F.coalesce("pull", "comp")).alias("comp"), "was"), "lower")
        up = lower.select(F.col("node").alias("up_node"), F.col("comp").alias("up_comp"))
        fresh = written(lower.join(up, lower["comp"] == up["up_node"], "left").select("node", F.least("comp", F.coalesce("up_comp", "comp")).alias("comp"), "was"), "labels")
        if not fresh.filter("comp < was").limit(1).count():
            return fresh.select("node", "comp")
        state = fresh.select("node", "comp")
