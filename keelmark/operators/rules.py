"""Business and range rules of the product, as predicates that select violating rows.

A null operand makes a rule silent (three-valued logic), so each is paired with a
not-null rule in the contract.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import any_of

C = F.col


@dataclass(frozen=True)
class Rule:
    label: str
    severity: str
    shows: tuple[str, ...]
    broken: Callable[[], Column]


def _outside(name: str) -> Callable[[], Column]:
    return lambda: (C(name) < S.SCORE_MIN) | (C(name) > S.SCORE_MAX)


def _tier_misaligned() -> Column:
    return ~any_of([(C("risk_tier") == tier) & C("churn_risk_score").between(low, high) for tier, low, high, _ in S.TIER_BANDS])


def _priority_misaligned() -> Column:
    """Like the tier rule, but open-ended at the lowest and the highest band."""
    score = C("churn_risk_score")
    aligned = []
    for position, (_, low, high, priority) in enumerate(S.TIER_BANDS):
        within = [score >= low] if position else []
        within += [score <= high] if position < len(S.TIER_BANDS) - 1 else []
        holds = C("intervention_priority") == priority
        for limit in within:
            holds = holds & limit
        aligned.append(holds)
    return ~any_of(aligned)


def _high_risk() -> Column:
    return C("risk_tier").isin("HIGH", "CRITICAL")


def _clv_misaligned() -> Column:
    value, tier = C("estimated_clv"), C("clv_tier")
    return ~any_of([
        (tier == "HIGH_VALUE") & (value >= S.CLV_HIGH_FROM),
        (tier == "MEDIUM_VALUE") & (value >= S.CLV_MEDIUM_FROM) & (value < S.CLV_HIGH_FROM),
        (tier == "STANDARD") & (value < S.CLV_MEDIUM_FROM),
    ])


_SCORED = ("customer_id", "churn_risk_score")
RULES: dict[str, Rule] = {
    "BR001": Rule("BR001: tier does not match the score", "error", (*_SCORED, "risk_tier"), _tier_misaligned),
    "BR002": Rule("BR002: high risk without a raised flag", "error", (*_SCORED, "risk_tier", *S.FLAGS),
                  lambda: _high_risk() & ~any_of(C(f) for f in S.FLAGS)),
    "BR003": Rule("BR003: urgent escalation below the critical tier", "error", (*_SCORED, "risk_tier", "recommended_intervention"),
                  lambda: (C("recommended_intervention") == "URGENT_ESCALATION") & (C("risk_tier") != "CRITICAL")),
    "BR004": Rule("BR004: priority does not match the score", "warning", (*_SCORED, "intervention_priority"), _priority_misaligned),
    "DQ001": Rule("DQ001: churn score outside 0-100", "error", _SCORED, _outside("churn_risk_score")),
    "DQ002": Rule("DQ002: engagement score outside 0-100", "error", ("customer_id", "digital_engagement_score"),
                  _outside("digital_engagement_score")),
    "CLV_TIER": Rule("CLV tier does not match the value", "error", ("customer_id", "estimated_clv", "clv_tier"), _clv_misaligned),
    "DOWNGRADE": Rule("downgrade flag does not match the counts", "error",
                      ("customer_id", "total_products_held", "products_held_90d_ago", "product_downgrade_flag"),
                      lambda: ~(C("product_downgrade_flag") == (C("total_products_held") < C("products_held_90d_ago")))),
    "CONFIDENCE": Rule("confidence outside 0-100", "error", ("customer_id", "action_confidence_score"),
                       _outside("action_confidence_score")),
}
V1_RULES = ("BR001", "BR002", "BR003", "BR004", "DQ001", "DQ002")
V2_RULES = ("BR001", "CLV_TIER", "DOWNGRADE", "CONFIDENCE")


def violations(df: DataFrame, rule_id: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows that break a rule; none means it holds."""
    rule = RULES[rule_id]
    return df.filter(rule.broken()).select(*keep, *rule.shows, F.lit(rule.label).alias("violation"))
