"""Connected components of a link table by alternating large-star and small-star rounds.

A round hangs every neighbour of a node on the smallest node around it; rounds end when the links
are stars. Links and stars stay distributed; the driver sees one row of totals per round, and each
round's table is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell.llm.common import stored


def _starred(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links (a, b) with a > b: neighbours of a node move to the smallest node around it."""
    if both_ways:  # large star: the larger neighbours of every node
        seen = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = seen.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # small star: the smaller neighbours and the node itself
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        joined = links.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def _total(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every linked node but the roots; root is the component's smallest node.

    ``links`` has the columns a and b; direction, repeats and self-links don't matter.
    """
    turned = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(turned.filter("a <> b").distinct(), name)
    before = _total(links)
    while before[0]:
        links = stored(_starred(_starred(links, True), False), name)
        after = _total(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
