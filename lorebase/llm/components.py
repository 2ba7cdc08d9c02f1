"""Connected components of links that do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of `links` (a, b); the root is the smallest node of its component.

    Alternating stars: first each node hangs its larger neighbours on its smallest one, then its smaller
    ones. The links stay links of the same components and end as one star per component, after a number of rounds
    that grows with the logarithm of the longest chain. Each half round is a min per node with partial
    sums and a join of two stored tables, which adaptive execution splits at a hub. Links of a node to itself, nulls
    and repeated links change nothing; no links: no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.filter("a > b").distinct(), "links")
    size = _state(links)
    while size[0]:
        both = links.union(links.select("b", "a"))
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "stars")
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.filter("a > b").distinct(), "links")
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "stars")
        small = large.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stored(small.union(low.select("a", "low")).distinct(), "links")
        last, size = size, _state(links)
        if size == last:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _state(links: DataFrame) -> tuple[int, int, int]:
    """Equal for equal sets of links, and in practice for no others."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x"),
        F.coalesce(F.bit_xor(F.xxhash64("b", "a", F.lit(1))), F.lit(0)).alias("y"),
    ).first()
    return row.n, row.x, row.y
