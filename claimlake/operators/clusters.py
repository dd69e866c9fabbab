"""Clusters from links: connected components by smallest labels, and each cluster's canonical member."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df behind a checkpoint in spark.checkpoint.dir; where that is unset, in a folder of our own in local mode, and an error elsewhere."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            at = "file://" + tempfile.mkdtemp(prefix="spark-clusters-", dir="/tmp")
        sc.setCheckpointDir(at)
    return df.checkpoint()


def chained(df: DataFrame, keys: list[str], node: str, order: str) -> DataFrame:
    """Links (a, b) from each row of a key to its first row by order: as many links as rows, whatever the size of a key. Null keys link nothing."""
    whole = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    first = whole.groupBy(*keys).agg(F.min_by(node, order).alias("a"))
    return whole.join(first, keys).select("a", F.col(node).alias("b")).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is linked with over any number of links (a, b); nodes without links are absent.

    Large and small stars in turn (Kiveris et al. 2014) over links (u, v), u > v: each round first gives u the smallest
    neighbour of v, then links all smaller neighbours of u with the least of them, so links never become more and rounds
    grow with the logarithm of a chain's length. A round is one checkpoint; nothing is broadcast by force, as the
    driver would hold a round's roots whole, and a giant component's root is a hot key on the side that a join may split.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _print(edges)
    while before[0]:
        low = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = edges.join(low, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(least.select("u", F.col("m").alias("v")).union(rest).distinct())
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.union(edges.select("v", "v").distinct()).toDF("node", "root")


def _print(edges: DataFrame) -> tuple:
    """The number of links and a sum over them: the same before and after a round that changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def canonical(members: DataFrame, root: str, confidence: str, name: str, node: str) -> DataFrame:
    """Each cluster's size and its member with the most confidence (null: 0), then the longest name, then the smallest node."""
    rank = F.struct(F.coalesce(F.col(confidence), F.lit(0)).alias("c"), F.length(F.coalesce(F.col(name), F.lit(""))).alias("n"), (-F.col(node)).alias("x"))
    return members.groupBy(root).agg(F.count(F.lit(1)).alias("members"), F.max_by(F.struct(F.col(node).alias("node"), F.col(name).alias("name")), rank).alias("best")).select(root, "members", F.col("best.node").alias("canonical"), F.col("best.name").alias("canonical_name"))
