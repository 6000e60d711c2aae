"""Connected components of a link table by hooking and contraction.

In each round every node hooks to its smallest neighbour (one aggregation, combined
map-side, so a star's centre is no hot group), pointers are doubled, and the links are
contracted to links between the new roots; a star is one node after one round. Only
DataFrames hold nodes, links and labels.

Defined results: links with a null end or between a node and itself are left out, repeated
links count once; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import fixed


def _hooked(links: DataFrame) -> DataFrame:
    """node, root: every node of ``links`` hooked to its smallest neighbour, twice."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hook = fixed(both.groupBy(F.col("a").alias("node"))
                 .agg(F.least(F.min("b"), F.first("a")).alias("root")))
    up = hook.select(F.col("node").alias("root"), F.col("root").alias("upper"))
    return fixed(hook.join(up, "root").select("node", F.col("upper").alias("root")))


def _relabel(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    to = labels.select(F.col("node").alias(column), F.col("root").alias("_to"))
    return (rows.join(to, column, "left")
            .withColumn(column, F.coalesce("_to", column)).drop("_to"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node in ``links`` (a, b); root is the component's name."""
    links = fixed(links.select("a", "b").filter("a <> b").distinct())  # drops null ends too
    labels = None
    while not links.isEmpty():
        step = _hooked(links)
        labels = step if labels is None else fixed(_relabel(labels, "root", step))
        links = fixed(_relabel(_relabel(links, "a", step), "b", step)
                      .filter("a <> b")
                      .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct())
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
