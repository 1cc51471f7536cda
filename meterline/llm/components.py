"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.session import cut_lineage


def directed(links: DataFrame) -> DataFrame:
    """Each link once, from its larger end ``a`` to its smaller ``b``."""
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    centres = both.groupBy("a").agg(F.min("b").alias("m"))
    centres = centres.select("a", F.least("a", "m").alias("m"))
    return directed(
        both.join(centres, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    centres = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(centres, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return directed(moved.unionByName(centres.select("a", F.col("m").alias("b"))))


def fingerprint_of(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """Columns node and root, the smallest node that links reach; one row for each linked node.

    ``links`` has two columns of one type, a and b. Links of a node with itself say nothing.
    Every round is written to the shared folder; rounds grow as the logarithm of the length
    of the longest chain, or a little faster.
    """
    links = cut_lineage(directed(links))
    before = None
    while (now := fingerprint_of(links)) != before:
        links, before = cut_lineage(small_star(large_star(links))), now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
