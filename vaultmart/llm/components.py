"""Connected components of a link table by alternating star contractions.

Every node is pulled to the smallest neighbour, from both sides in turn, until
nothing changes.  Each round is two grouped minima and two joins; rounds grow
with the logarithm of a component's diameter.  Rounds are written to the
shared folder; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pulled(links: DataFrame, least) -> DataFrame:
    """``u, v, m`` with the smallest partner of u (or u itself).  ``again`` lets Spark exchange a hot node's links anew and split them."""
    low = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("again", F.hash("u"))
    return links.withColumn("again", F.hash("u")).join(low, ["u", "again"]).select("u", "v", least.alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_pulled(both, F.least("u", "m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pulled = _pulled(down, F.col("m"))
    return (pulled.select(F.col("u"), F.col("m").alias("v"))
            .unionByName(pulled.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where("u <> v").distinct())


def connected_components(links: DataFrame, stored) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns a, b) that is not the smallest of its component."""
    now = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        seen = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = seen
