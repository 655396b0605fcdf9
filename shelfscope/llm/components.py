"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.session import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest id that links lead to, for every id that has a link to another one.

    Every round points each node at its smallest neighbour, follows the pointers twice and relabels the links by
    them; links inside a label vanish. A star is done in one round, a chain of n links in about log n. Nothing of
    the graph reaches the driver; rounds are cut by tables in the shared folder.
    """
    edges = materialize(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links",
    )
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        # `a` is the smaller end: a node without a smaller neighbour is its own parent
        up = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        top = up.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        up = materialize(
            up.join(top, "parent", "left").select("node", F.coalesce("above", "parent").alias("label")), "parents"
        )
        labels = materialize(
            labels.join(up, labels["component"] == up["node"], "left").select("id", F.coalesce("label", "component").alias("component")),
            "labels",
        )
        for end in ("a", "b"):
            edges = edges.join(up, edges[end] == up["node"], "left").withColumn(end, F.coalesce("label", end)).select("a", "b")
        edges = materialize(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
        )
    return labels
