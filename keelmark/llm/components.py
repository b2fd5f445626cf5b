"""Connected components of a link table, in rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import stored


def components(links: DataFrame, left: str, right: str, rounds: int = 64) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node that a link names.

    Alternating stars (Kiveris et al., *Connected Components in MapReduce and Beyond*, 2014): the large-star step
    links each node's larger neighbours to the smallest node near it, the small-star step does so with the smaller
    ones; both keep the components and shorten them, in about log^2 of the longest path. The rounds end when the links
    are stars. Each round is written to the shared folder, so a lost executor costs one round.
    Null ends are ignored; an empty table gives an empty result.
    """
    edges = stored(
        links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    for _ in range(rounds):
        shortened = stored(_small_star(_large_star(edges)), "components")
        # stars: no centre is itself linked to a smaller node, and each node has one centre
        loose = shortened.select("u").join(shortened.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        same = shortened.groupBy("u").count().where("count > 1").limit(1).count()
        edges = shortened
        if not loose and not same:
            members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return members.union(centres)
    raise RuntimeError(f"links did not become stars in {rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node ``u`` to the smaller ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
