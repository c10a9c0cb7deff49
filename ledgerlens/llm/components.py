"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import release, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); the component is the
    smallest node reachable.

    Every round, each node takes the smallest label among its own and its
    neighbours', then the label of that label; rounds end when no label
    changes. Minima are taken per task before the shuffle, and each round's
    labels are stored, so lineage does not grow.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("low"))
        roots = labels.select(F.col("node").alias("r"), F.col("label").alias("up"))
        new = stored(low.join(roots, F.col("low") == F.col("r"), "left").select(
            "node", F.least("low", F.coalesce("up", "low")).alias("label"), F.col("label").alias("was")), "labels")
        done = new.where("label < was").isEmpty()
        release(labels)
        labels = new.select("node", "label")
        if done:
            release(both)
            return labels.withColumnRenamed("label", "component")


def joined_up(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components (node, component) of ``found`` after the further ``links``,
    stored. Only the new links between different components go through the
    rounds, with a node for each component."""
    if found is None:
        return components(links)
    ends = links.join(found.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        found.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    moved = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    moved = moved.select(F.col("node").alias("was"), F.col("component").alias("now"))
    old = found.join(moved, found["component"] == moved["was"], "left").select("node", F.coalesce("now", "component").alias("component"))
    new = moved.join(found.select("node"), F.col("was") == F.col("node"), "left_anti")
    return stored(old.unionAll(new), "components")
