"""Connected components of links that may be more than one machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.common import staged


def _lowest(edges: DataFrame) -> DataFrame:
    """For each ``u`` the smallest of itself and its neighbours, as ``m``."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("w"), F.least("u", "low").alias("m")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    low = _lowest(down)
    moved = down.join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    roots = low.select(F.col("w").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(roots).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, label): label is the smallest node that links reach; only nodes with links.

    Alternates the two star operations until nothing changes, which takes about
    the logarithm of the largest component's diameter. Minima are aggregated before the
    shuffle and joined back, so a node with very many links is never one
    task's list. Every round is written to the shared folder.
    """
    edges = staged(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        edges = staged(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    ).distinct()
