"""Connected components of links that no machine could hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gapmend.shared import Written, write_shared


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches.

    ``links`` has columns u and v of any order; the result has node and root,
    one row for each node that a link names. Alternating star operations
    (Kiveris et al. 2014) join all larger neighbours, then all smaller ones, to
    the smallest, until nothing changes. Each round is written to the shared
    folder. A node with very many neighbours is a skewed key of a join whose
    other side has one row for each node, so Spark can split it.
    """
    now = write_shared(_pointing_down(links), "links")
    seen = None
    while now.rows:
        for star in (_large_star, _small_star):
            # Written, so that Spark can split a hot node in the join with it.
            least = write_shared(star(now.frame), "least-neighbours")
            after = write_shared(_joined(now.frame, least.frame, star), "links")
            least.drop()
            now.drop()
            now = after
        state = _state(now)
        if state == seen:
            break
        seen = state
    nodes = now.frame.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = nodes.select(F.col("root").alias("node"), "root").distinct()
    return nodes.unionByName(roots)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _pointing_down(links: DataFrame) -> DataFrame:
    pair = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return pair.filter("u > v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours."""
    least = _both_ways(links).groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def _small_star(links: DataFrame) -> DataFrame:
    """The smallest of the smaller neighbours of each node that has any."""
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _joined(links: DataFrame, least: DataFrame, star: Callable) -> DataFrame:
    """Link neighbours to the smallest: all larger ones of a node in a large
    star, the node itself and its smaller ones in a small star."""
    if star is _large_star:
        rows = _both_ways(links).filter("v > u").join(least, "u")
        return _pointing_down(rows.select(F.col("v").alias("u"), F.col("m").alias("v")))
    rows = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _pointing_down(rows.unionByName(least.select("u", F.col("m").alias("v"))))


def _state(links: Written) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.frame.agg(F.count(F.lit(1)), total).first())
