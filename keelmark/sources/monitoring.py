"""Metric history, expectation status and access history, derived from the event log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import to_rows
from keelmark.functions.temporal import seconds_elapsed
from keelmark.operators.quality import Expectation, evaluate
from keelmark.sources.tables import table

# ---------------------------------------------------------------- fixed values
OBJECTS = (S.PRODUCT, "CUSTOMERS", "ACCOUNTS", "TRANSACTIONS", "COMPLAINTS")
READ_COLUMNS = ("risk_tier", "churn_risk_score", "region")
EVENT_EXPECTATIONS = (
    Expectation("freshness_sla", "FRESHNESS", None, "<=", 1800),
    Expectation("no_null_value", "NULL_COUNT", None, "=", 0),
    Expectation("min_row_count", "ROW_COUNT", None, ">=", 60),
)
# ------------------------------------------------------------ end fixed values


def metric_history(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, nulls and age per event type and day, measured at the end of the day."""
    end = (F.date_add(F.to_date("ts"), 1)).cast("timestamp_ntz")
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("table_name"), end.alias("measurement_time"))
        .agg(F.count("*").alias("n"), F.max("ts").alias("newest"), F.count_if(F.col("value") < 1).alias("empty"))
        .withColumn("age", seconds_elapsed(F.col("newest"), F.col("measurement_time")))
    )
    rows = [("'ROW_COUNT'", "'*'", "n"), ("'FRESHNESS'", "'ts'", "age"), ("'NULL_COUNT'", "'value'", "empty")]
    return to_rows(daily, rows, ("metric_name", "column_name", "value"), ("table_name", "measurement_time"))


def expectation_status(history: DataFrame) -> DataFrame:
    return evaluate(history, EVENT_EXPECTATIONS).select(
        "table_name", "expectation_name", "expectation_violated", "metric_name",
        F.col("value").alias("metric_value"), "measurement_time")


def access_history(spark: SparkSession, folder: str) -> DataFrame:
    """One access per event: who read what, with the objects touched as nested records."""
    key, kind = F.col("event_id"), F.col("event_type")
    objects = F.array(*map(F.lit, OBJECTS))
    first = F.element_at(objects, (key % 5 + 1).cast("int"))
    second = F.element_at(objects, (F.floor(key / 5) % 5 + 1).cast("int"))
    column = F.element_at(F.array(*map(F.lit, READ_COLUMNS)), (key % 3 + 1).cast("int"))
    touched = lambda name: F.struct(
        name.alias("objectName"), F.lit("Table").alias("objectDomain"),
        F.array(F.lit("customer_id"), column).alias("columns"))
    statement = (
        F.when(kind == "purchase", F.concat(F.lit("CREATE VIEW v AS SELECT * FROM "), first))
        .when(kind == "signup", F.concat(F.lit("insert into t select * from "), F.lower(first)))
        .otherwise(F.concat(F.lit("SELECT * FROM "), first)))
    return table(spark, folder, "events").select(
        key.alias("access_id"),
        F.col("ts").alias("query_start_time"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        kind.alias("role_name"),
        statement.alias("query_text"),
        F.when(key % 2 == 1, F.array(touched(first), touched(second))).otherwise(F.array(touched(first))).alias("direct_objects_accessed"),
        F.when(key % 4 == 3, F.array(first, F.lit("CUSTOMERS"))).otherwise(F.array(F.lit(S.PRODUCT), first)).alias("base_objects_accessed"),
    )
