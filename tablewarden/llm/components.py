"""Connected components of a table of links, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import own_shuffle
from .common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the component's smallest node) for every node of ``links`` (columns ``a``, ``b``).

    Alternating stars: each node's larger neighbours, then its smaller ones, are linked to its smallest neighbour, until
    the links no longer change. The smallest neighbour is an aggregate, so a node with very many links is combined
    before the shuffle; every round is written to the shared folder.
    """
    stars = written(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u != v").distinct(), "links"
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(stars)
    while before[0]:
        both = stars.select(F.col("u").alias("x"), F.col("v").alias("y")).union(stars.select("v", "u"))
        least = both.groupBy("x", own_shuffle("x")).agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.where("u != v").distinct()
        smallest = large.groupBy("v", own_shuffle("v")).agg(F.min("u").alias("m")).drop("_spread")
        small = large.join(smallest, "v").select(
            F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                              F.struct(F.col("v").alias("v"), F.col("m").alias("u")))).alias("s")
        ).select("s.v", "s.u").where("u != v").distinct()
        stars = written(small, "stars")
        after = state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
