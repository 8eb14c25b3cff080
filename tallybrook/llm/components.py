"""Connected components of a table of links, by min-label hops over stored tables."""

from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import stored


def _toward_least(links: DataFrame) -> DataFrame:
    """Each end of a link is tied to the least node among itself and its neighbours.

    The least node of a node is an aggregate, so a node with very many links is never gathered; the
    links meet it again in a join that the adaptive planner may split.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    least = least.withColumnRenamed("a", "node")
    tied = both.join(least, F.col("a") == F.col("node"))
    return (
        tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
        .where("a > b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to ``node``, ``component`` (the least node reachable), for nodes with links.

    Every hop ties a node's neighbours to its least neighbour, which halves the distances or better.
    The end is reached when no link changes: then each node has one link, to its component.
    """
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first())

    before = state(now)
    while True:
        now = stored(_toward_least(now), "links")
        after = state(now)
        if after == before and after[0] == after[1]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after
