"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target over source size. Documents are put in
order of size, expected copies are summed along that order, one random offset per source is added, and a document is
emitted once for each integer that its step of the sum crosses. Ordering by size makes the taken words of a source
come near the target, not only the taken documents.

The running sum needs no window over a source: documents are dealt out by ranges of (source, size, id), each range
counts its rows per source, and a range's first rank is the sum of the counts before it. A hot source is spread over
many ranges.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelmark.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 7


def offset(source: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source.

    A target is the smaller of ``most`` times the source and weight times a common level; the level is the first that
    the sources not yet full, in the order in which they fill up, can hold. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    weighed = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("ratio", (most * F.col("source_size")).cast("double") / F.col("w"))
    filling = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0))).cast("double")
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    levels = weighed.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    held = levels.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(everything)["level"])
    return held.select("source", "source_size", F.least(
        (most * F.col("source_size")).cast("double"), F.col("level") * F.col("w")).alias("target"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
          id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row.

    Null texts have size 0. The null source is one source and comes last. Sources without words have target 0 and no
    copies. Null ids come first within their size; equal ids share what falls to them in no stated order. Repeated rows
    count as often as they occur. An empty table gives an empty result; other columns are ignored.
    """
    narrow = docs.select(docs[id_column].alias("doc_id"), docs[source_column].cast("string").alias("source"),
                         word_count(docs[text_column]).alias("size"))
    ranged = stored(narrow.repartitionByRange("source", "size", "doc_id").withColumn("part", F.spark_partition_id()), "mix-ranges")
    counts = stored(ranged.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-counts")
    # one row for each range and source in it: ranges are as many as the shuffle's partitions
    in_order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", F.col("source").alias("its"), F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("first"))
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sizes, weights, most).withColumnRenamed("source", "of")
    steps = firsts.join(plan, F.col("its").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("part", "range")
    local = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "doc_id"))
    ranks = ranged.withColumn("local", local).join(
        steps, (F.col("part") == F.col("range")) & F.col("source").eqNullSafe(F.col("its")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank, start = F.col("first") + F.col("local"), offset(F.col("source"), seed)
    copies = F.floor(rate * rank + start) - F.floor(rate * (rank - 1) + start)
    return ranks.select("doc_id", "source", "size", "source_size", "target", copies.cast("bigint").alias("copies"),
                        (copies * F.col("size")).cast("bigint").alias("taken"))


def emitted(docs: DataFrame, **parameters: object) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies, its columns unchanged.

    Rows are matched to their copies by id; rows that share an id all get the copies of one of them.
    """
    copies = mixed(docs, **parameters).groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("copies").alias("mixed_copies"))
    joined = docs.join(copies.where("mixed_copies > 0"), docs["doc_id"].eqNullSafe(F.col("mixed_id")))
    return joined.withColumn("mixed_copy", F.explode(F.sequence(F.lit(1), F.col("mixed_copies").cast("int")))).select(docs.columns)
