"""Connected components of an edge table by neighbour minimum and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.staging import staged


#: Rows of a file of a round, and files at least: joins of small tables then need no shuffle.
FILE_ROWS, LEAST_FILES = 100_000, 32


def components(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """node, label for every node of `edges` (a, b long); label is the smallest node of its component.

    Columns `by` tell several graphs apart, which share the rounds; they come before node and label.

    Each round takes the least label among a node and its neighbours, then that label's own label, so
    rounds grow with the logarithm of a component's width. Every round is a stored table: joins read two
    plain tables, whose hot partitions Spark splits at run time, and no round is ever recomputed. The
    edges must have been stored. No edges give no rows.
    """
    files = max(LEAST_FILES, edges.count() // FILE_ROWS)
    both = edges.select(*by, "a", "b").union(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    labels = staged(both.groupBy(*by, F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label"), F.lit(True).alias("moved")).coalesce(files), "labels")
    while not labels.where("moved").isEmpty():
        near = both.join(labels.select(*by, F.col("node").alias("b"), "label"), [*by, "b"]).groupBy(*by, F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(near, [*by, "node"]).select(*by, "node", "label", F.least("label", "near").alias("next"))
        hop = staged(least.coalesce(files), "hops")
        target = hop.select(*by, F.col("node").alias("next"), F.col("next").alias("far"))
        jumped = hop.join(target, [*by, "next"]).select(*by, "node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved"))
        labels = staged(jumped.coalesce(files), "labels")
    return labels.select(*by, "node", "label")


def onward(labels: DataFrame, joined: DataFrame, how: str = "left") -> DataFrame:
    """`labels` renamed by `joined` (node: a label, label: what it became); a label that is no node there is a node of its own."""
    renamed = joined.select(F.col("node").alias("label"), F.col("label").alias("next"))
    there = labels.join(renamed, "label", how).select("node", F.coalesce("next", "label").alias("label"))
    return there.union(joined.join(labels.select("node"), "node", "left_anti").select("node", "label"))


def roots(links: DataFrame) -> DataFrame:
    """node, label of a forest (a, b long): every node b has one row, its parent a; label is the root above it.

    Each round doubles the distance looked up, in one join. Roots have no row. The links must have been stored.
    """
    labels, moved = links.select(F.col("b").alias("node"), F.col("a").alias("label")), True
    while moved:
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = labels.join(above, "label", "left").select("node", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved"))
        jumped = staged(jumped, "roots")
        labels, moved = jumped.select("node", "label"), not jumped.where("moved").isEmpty()
    return labels
