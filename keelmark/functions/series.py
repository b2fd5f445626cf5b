"""Series operators that do not need a whole series in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: Sequence[str], time: str, value: str, name: str, period: str = "month") -> DataFrame:
    """``lag(value)`` per series, computed period by period.

    The window only spans one series *and period*; the first row of a period takes
    the last value of the series' preceding period, which comes from a small
    aggregate. A series holding most of the rows is thereby spread over its periods.
    """
    inside = Window.partitionBy(*keys, "_period").orderBy(time)
    across = Window.partitionBy(*keys).orderBy("_period")
    split = df.withColumn("_period", F.date_trunc(period, F.col(time)))
    closing = (
        split.groupBy(*keys, "_period").agg(F.max_by(value, time).alias("_closing"))
        .withColumn("_carried", F.lag("_closing").over(across))
        .select("_carried", *[F.col(k).alias(f"_of_{k}") for k in (*keys, "_period")])
    )
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*keys, "_period")]  # null keys are a series too
    ranked = split.withColumns({"_inside": F.lag(value).over(inside), "_position": F.row_number().over(inside)})
    previous = F.when(F.col("_position") == 1, F.col("_carried")).otherwise(F.col("_inside"))
    return (
        ranked.join(closing, same, "left")
        .withColumn(name, previous).select(*df.columns, name)
    )


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows per key in the given order; the limit is applied before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= count).drop("_rank")


def newest_with_previous(df: DataFrame, keys: Sequence[str], time: str, value: str, name: str, count: int) -> DataFrame:
    """The ``count`` newest rows per key, each with ``lag(value)`` over the whole series.

    The lag of the newest ``count`` rows only needs the row before the oldest of them, so the
    ``count + 1`` newest rows are kept first (a limit applied before the shuffle), the lag is
    taken among them, and the extra row is dropped: one exchange, whatever the series length.
    """
    kept = newest(df, keys, [F.desc(time)], count + 1)
    rank = Window.partitionBy(*keys).orderBy(F.desc(time))
    ordered = Window.partitionBy(*keys).orderBy(time)
    return (kept.withColumns({name: F.lag(value).over(ordered), "_rank": F.row_number().over(rank)})
            .filter(F.col("_rank") <= count).drop("_rank"))


def as_of(probes: DataFrame, spans: DataFrame, key: str, at: str, start: str, value: str, name: str) -> DataFrame:
    """``probes`` with ``name``: the ``value`` of the last span of the same key starting at or before ``at``.

    Spans and probes are merged in one order per key (time, a span before a probe at the same
    time) and the last span value seen is carried forward, so the plan is one exchange and one
    sort: no calendar of dates, no range join. A probe before every span of its key, or without
    any span, gets null; null keys meet only null keys. The window of a key holds its spans and
    probes, so callers keep spans to one row per change (not per day or row of history).
    """
    carried = [c for c in probes.columns]
    kind = spans.schema[value].dataType.simpleString()
    span_rows = spans.select(F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_kind"),
                             F.col(value).alias("_value"), F.lit(None).alias("_probe"))
    probe_rows = probes.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                               F.lit(None).cast(kind).alias("_value"), F.struct(*carried).alias("_probe"))
    span_rows = span_rows.withColumn("_probe", F.col("_probe").cast(probe_rows.schema["_probe"].dataType))
    merged = span_rows.unionByName(probe_rows)
    ordered = Window.partitionBy("_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried_value = F.last("_value", ignorenulls=True).over(ordered)
    return (merged.withColumn(name, carried_value).where(F.col("_kind") == 1)
            .select(*[F.col("_probe")[c].alias(c) for c in carried], name))
