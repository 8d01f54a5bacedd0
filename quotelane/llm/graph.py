"""Connected components of a graph given as a table of edges, in a distributed way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import written


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node and component (its smallest node) of every node of an edge table (a, b: long).

    Turns of two star steps: every node's larger neighbours, then every node's smaller ones, are
    linked to its smallest neighbour, until nothing changes. Both steps are a minimum per node and
    a join, so a node with many neighbours is neither gathered nor held in one task.
    """
    edges = written(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
        light=True,
    )
    while True:
        # large star: neighbours above u go to u's smallest neighbour (or u)
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        # small star: u and its neighbours below go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        after = written(small, label, light=True)
        # every node under one smallest neighbour which has none itself: the stars are complete
        heads = after.select(F.col("v").alias("h")).distinct()
        twice = after.groupBy("u").count().where("count > 1").limit(1).count()
        linked = after.join(heads, after["u"] == heads["h"], "left_semi").limit(1).count()
        edges = after
        if not twice and not linked:
            break
    heads = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        heads.select("node", F.col("node").alias("component"))
    )
