"""The published data products: version 1 (32 columns) and version 2 (38 columns)."""

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.temporal import day, moment
from keelmark.operators import features, scoring
from keelmark.sources.banking import Sources


def scored_customers(sources: Sources, as_of: date, activity_rule: str = "trend") -> DataFrame:
    """Features, flags, score, tier, driver, detail and intervention."""
    frame = features.customer_features(sources, as_of)
    frame = scoring.with_risk_flags(frame, activity_rule)
    frame = scoring.with_score(frame)
    frame = scoring.with_driver(frame)
    frame = scoring.with_driver_detail(frame)
    return scoring.with_intervention(frame)


def _stamped(frame: DataFrame, as_of: date, scored_at: datetime, version: str) -> DataFrame:
    return frame.withColumns({
        "score_calculated_at": moment(scored_at),
        "data_as_of_date": day(as_of),
        "model_version": F.lit(version),
    })


def build_v1(
    sources: Sources, as_of: date = S.AS_OF, scored_at: datetime = S.SCORED_AT, activity_rule: str = "trend",
) -> DataFrame:
    return _stamped(scored_customers(sources, as_of, activity_rule), as_of, scored_at, S.V1).select(*S.V1_COLUMNS)


def build_v2(
    sources: Sources, spans: DataFrame, as_of: date = S.AS_OF, scored_at: datetime = S.SCORED_AT,
) -> DataFrame:
    """Version 2; ``spans`` are the holding spans of :func:`keelmark.sources.banking.holding_spans`."""
    frame = scored_customers(sources, as_of)
    frame = scoring.with_downgrade_as_of(frame, spans, as_of)
    frame = scoring.with_lifetime_value(frame)
    frame = scoring.with_confidence(frame)
    frame = scoring.with_vulnerability(frame)
    return _stamped(frame, as_of, scored_at, S.V2).select(*S.V1_COLUMNS, *S.V2_ADDED)
