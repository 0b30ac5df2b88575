"""Connected components of links between documents, as joins and aggregations.

Each round replaces links by links to the smallest neighbour, first for the larger neighbours of each node and
then for the smaller ones, until all that is left are stars around the smallest node of each component. Links and
components stay in tables; the driver sees one count and checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import staged


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node reachable, of every node of the links `a`, `b` but the smallest ones.

    Links have no direction; repeated ones and those of a node to itself do no harm.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = staged(links.where("a <> b").select(high, low).distinct(), compact=True)
    before = _checksum(links)
    while before[0]:
        # The smallest neighbours are staged so that the join's sides can be split where a node has very many.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), compact=True)
        large = both.join(nearest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), compact=True)
        lowest = staged(large.groupBy("a").agg(F.min("b").alias("m")), compact=True)
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = staged(small.union(lowest).distinct(), compact=True)
        now = _checksum(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
