"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.session import written


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component): each linked id's smallest reachable
    id, itself included; ids without a link to another are absent.

    Each round gives every node's larger neighbours, then its smaller ones,
    to the smallest node it sees, which keeps components and ends in stars
    after logarithmically many rounds. A node's smallest neighbour is a
    map-side combined minimum joined back to the links, so a hub's links stay
    spread (skewed joins are split at run time). Each round's links are a
    written table; the driver sees only their number and checksum.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not now[0] or now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")) \
                .unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small, "links")
