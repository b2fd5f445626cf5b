"""A corpus pipeline of five operators: score, deduplicate, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor wrote.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelmark.llm import decontamination, mixing, ranking, simhash, tokens
from keelmark.llm.queries import vocabulary
from keelmark.session import run_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, by its verdict per id."""
    verdicts = ranking.scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = verdicts.where("predicted = 0").select(F.col("doc_id").alias("rejected")).distinct()
    return docs.join(rejected, docs["doc_id"].eqNullSafe(F.col("rejected")), "left_anti")


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id; a null id is chosen only where no other is there.

    Rows are told apart by id and text, so rows that share an id, null included, stay if they are in different groups.
    """
    key = F.struct(docs["doc_id"].isNull().alias("absent"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("hash"))
    name = "_".join([*docs.columns, "key"])  # longer than any column's name
    members = simhash.near_duplicates(docs.select(key.alias("key"), docs["text"].alias("text")), id_column="key")
    chosen = members.select(F.col("component_id").alias("chosen")).distinct()
    keyed = docs.withColumn(name, key)
    return keyed.join(chosen, keyed[name] == F.col("chosen"), "left_semi").dropDuplicates([name]).select(docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emitted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in files, and what reading them back gives per document."""
    return tokens.round_trip(docs, vocabulary())


STAGES = [
    ("quality classifier", good),
    ("simhash near-dedup", single),
    ("benchmark decontamination", clean),
    ("mixing to target weights", mix),
    ("token-id output", encode),
]
ORACLE_SQL = None  # neither fingerprints nor the classifier can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = run_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
