"""Connected components of a link table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import materialise

ROUNDS = 60  # paths shorten at least fourfold a round


def _moved(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges with both ends moved to their parents; every end has one."""
    to = parents.select(F.col("v").alias("a"), F.col("p").alias("pa"))
    edges = edges.join(to, "a").select("pa", "b")
    to = parents.select(F.col("v").alias("b"), F.col("p").alias("pb"))
    return edges.join(to, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def _climbed(labels: DataFrame, parents: DataFrame) -> DataFrame:
    """(v, p) with p replaced by its parent, where it has one."""
    up = parents.select(F.col("v").alias("p"), F.col("p").alias("higher"))
    return labels.join(up, "p", "left").select("v", F.coalesce("higher", "p").alias("p"))


def components(links: DataFrame) -> DataFrame:
    """(v, p): each end of a link and the least end of its component. ``links`` has longs a and b.

    Every round each vertex moves to its least neighbour, twice over, and edges are
    contracted; least neighbours are combined before the shuffle, so a hub is no hot
    group. Nothing but emptiness of the edges reaches the driver.
    """
    edges = materialise(links.filter("a != b").select("a", "b").distinct(), "links")
    labels = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    labels = materialise(labels.select("v", F.col("v").alias("p")), "labels")
    for _ in range(ROUNDS):
        if edges.isEmpty():
            return labels
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("p"))
        parents = materialise(parents, "parents")
        for _ in range(2):
            parents = materialise(_climbed(parents, parents), "parents")
        labels = materialise(_climbed(labels, parents), "labels")
        edges = materialise(_moved(edges, parents).filter("a != b").distinct(), "links")
    raise RuntimeError("links did not contract")
