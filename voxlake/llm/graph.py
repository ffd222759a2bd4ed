"""Connected components of links that are kept as a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.storage import kept


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node it can reach.

    Each round hangs every node under its smallest neighbour, jumps the pointers until they reach
    a root and shrinks the links to those between different roots. A node with very many links is
    one row per task after the map side, so no node gathers its neighbours. No links: no rows.
    Loops and repeated links count for nothing.
    """
    links = kept(links.where("a <> b").select("a", "b").distinct(), "links")
    named = None
    while True:
        hung = kept(links.union(links.select("b", "a")).groupBy("a")
                    .agg(F.min("b").alias("low"))
                    .select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "hung")
        flat = False
        while not flat:
            up = hung.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = kept(hung.join(up, "root").select(
                "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("up")),
                "jumped")
            flat = jumped.where("up").isEmpty()
            hung = jumped.drop("up")
        named = hung if named is None else kept(
            named.join(hung.select(F.col("node").alias("root"), F.col("root").alias("next")),
                       "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")), "named")
        ends = hung.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        links = kept(
            links.join(ends, "a")
            .join(ends.select(F.col("a").alias("b"), F.col("root_a").alias("root_b")), "b")
            .where("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct(), "links")
        if links.isEmpty():
            return named
