"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.session import settle

#: Rounds before giving up; the number needed follows the logarithm of the longest path.
ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest id reachable from each id that has a link: id, component.

    A round ties every node's larger neighbours to its smallest one, then every node to the
    smallest of its smaller neighbours; both keep what is reachable. It ends when nothing
    moves: every node is then tied to the smallest of its component. Rounds are tables in
    the shared folder. Minima are joined, never gathered, so a node of any degree is fine.
    Links to itself and links with a null are ignored.
    """
    edges = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}").distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        before = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = settle(small, "links")
    raise RuntimeError(f"no end after {ROUNDS} rounds")
