"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(v, component) for every end of the links ``a``, ``b``; the component is its smallest member.

    Each round hooks every root to its smallest neighbour, flattens the hooks by jumping and keeps
    the links between the roots left; it ends when none is left.  Nothing is gathered on the driver.
    Null ends and self links are ignored; an empty table gives no rows.
    """
    left = cut_lineage(_ordered(links))
    labels = cut_lineage(left.select(F.col("a").alias("v")).union(left.select(F.col("b").alias("v"))).distinct().select("v", F.col("v").alias("component")))
    while not left.isEmpty():
        parents = cut_lineage(left.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")))
        while True:
            up = parents.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = cut_lineage(parents.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")))
            parents = jumped.select("v", "p")
            if jumped.filter("moved").isEmpty():
                break
        to = lambda df, c: df.join(parents.select(F.col("v").alias(c), F.col("p").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")  # noqa: E731, B023
        labels = cut_lineage(to(labels, "component").select("v", "component"))
        left = cut_lineage(_ordered(to(to(left, "a"), "b")))
    return labels


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
