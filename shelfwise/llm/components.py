"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import staged


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the least of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Columns u and v: every node that has a link and is not the least of its component, with that
    least node.

    ``edges`` has the columns u and v (long, u not equal to v). The links of a node are joined with
    its least neighbour, never listed in one row, so a hub is work that Spark can split. Each round
    is written to the shared folder.
    """
    edges = staged(edges.select("u", "v").distinct(), "links")
    before = _state(edges)
    while True:
        wide = _large_star(edges).distinct()
        edges = staged(_small_star(wide).distinct(), "links")
        after = _state(edges)
        if after == before:
            return edges
        before = after
