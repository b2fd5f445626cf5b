"""Sharding by extendible hashing, as DataFrame operations.

A directory over hash prefixes: a bucket that holds more than the byte limit is split on the next bit, others stay as
they are. ``BITS`` bits are looked at in one round: rows in oversized buckets are summed per cell of so many further
bits, cells are rolled up to every prefix between, and a cell's shard is its shortest prefix that fits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import stored

LIMIT_BYTES = 16 << 20
BITS = 12
HASH_BITS = 60


def hash_bits(column):
    """The first 60 bits of an MD5, as text."""
    return F.lpad(F.bin(F.conv(F.substring(F.md5(column), 1, HASH_BITS // 4), 16, 10).cast("bigint")), HASH_BITS, "0")


def shards(docs: DataFrame, limit: int = LIMIT_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``shard`` (its prefix), ``depth``, ``shard_bytes``, ``shard_docs`` of every row.

    No shard holds more than ``limit`` bytes, unless a single document does, which then is a shard by itself. Null
    texts have no bytes; a null id hashes like empty text. Rows with one id share the first 60 bits; where even those
    don't suffice, a hash of the row's place splits them further. An empty table gives an empty result; other columns
    are ignored.
    """
    if limit < 1:
        raise ValueError("the limit is at least one byte")
    rows = docs.select(docs[id_column].alias("doc_id"), F.coalesce(F.octet_length(docs[text_column]), F.lit(0)).cast("bigint").alias("n_bytes"))
    rows = rows.withColumn("bits", F.concat(
        hash_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), hash_bits(F.monotonically_increasing_id().cast("string"))))
    active, done = stored(rows, "shard-rows"), []
    for depth in range(BITS, 2 * HASH_BITS + 1, BITS):
        cells = active.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        lengths = F.sequence(F.lit(0 if depth == BITS else depth - BITS + 1), F.lit(depth))
        prefixes = cells.withColumn("depth", F.explode(lengths)).groupBy(
            "depth", F.expr("substring(cell, 1, depth)").alias("shard")).agg(
            F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"), F.collect_list("cell").alias("cells"))
        fitting = prefixes.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
        # a prefix gathers at most 2**BITS cells
        shortest = fitting.select(F.explode("cells").alias("cell"), F.struct("depth", "shard", "shard_bytes", "shard_docs").alias("s")).groupBy("cell").agg(F.min("s").alias("s"))
        directory = stored(shortest, "shard-directory")
        placed = active.withColumn("cell", F.substring("bits", 1, depth)).join(directory, "cell", "left")
        done.append(placed.where("s is not null").select("doc_id", "n_bytes", "s.shard", "s.depth", "s.shard_bytes", "s.shard_docs"))
        left = placed.where("s is null").drop("s", "cell")
        if not cells.join(directory, "cell", "left_anti").limit(1).count():
            break
        active = stored(left, "shard-rows")
    else:
        raise RuntimeError("rows with equal hashes exceed the limit")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out
