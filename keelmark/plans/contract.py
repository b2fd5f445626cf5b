"""Data contracts: read either document shape into one description, and compile it to checks.

A contract is small configuration and is read on the driver. What it compiles to
is a list of aggregate columns, evaluated over the product in one pass.
"""

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.functions.columns import literal, ratio, text, to_rows
from keelmark.functions.temporal import moment, seconds_elapsed
from keelmark.operators import quality, rules

VALUE = "decimal(18,2)"

# ---------------------------------------------------------------- fixed values
DIMENSION_TAGS = {"classification", "segment", "tier", "risk_tier", "geography"}
# ------------------------------------------------------------ end fixed values


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    unique: bool = False
    allowed: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    max_length: int | None = None
    checks: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()


@dataclass(frozen=True)
class Mask:
    column: str
    roles: frozenset[str]


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    key: str
    fields: tuple[Field, ...]
    masks: tuple[Mask, ...]
    completeness: Mapping[str, float]
    business_rules: tuple[Mapping, ...]
    warn_hours: int
    fail_hours: int
    minimum_rows: int
    high_risk_percent: int | None
    retention_months: int

    @property
    def freshness_column(self) -> str:
        return next(f.name for f in self.fields if f.type.lower().startswith("timestamp"))

    @property
    def required(self) -> list[str]:
        named = [f.name for f in self.fields if f.required or self.completeness.get(f.name) == 100]
        return named if self.key in named else [self.key, *named]

    @property
    def unique(self) -> list[str]:
        """The key, and every field declared unique."""
        return list(dict.fromkeys([self.key, *(f.name for f in self.fields if f.unique)]))

    @property
    def dimensions(self) -> list[str]:
        """Fields whose cardinality is worth tracking: tagged as dimensions, or enumerated."""
        return [f.name for f in self.fields if f.allowed or DIMENSION_TAGS & set(f.tags)]


def _number(text) -> int | None:
    digits = re.search(r"\d[\d,]*", str(text or ""))
    return int(digits.group().replace(",", "")) if digits else None


def _role_names(roles) -> frozenset[str]:
    """Case-folded names; entries may be plain names or records with a ``role``."""
    return frozenset((r["role"] if isinstance(r, Mapping) else r).lower() for r in roles)


def _field(name: str, spec: Mapping) -> Field:
    limits = spec.get("constraints", {})
    kind = str(spec.get("type", "string"))
    if isinstance(limits, Mapping):  # map shape: limits spelled out
        return Field(
            name, kind, bool(limits.get("required")), bool(limits.get("unique")), tuple(limits.get("enum", ())),
            limits.get("minimum"), limits.get("maximum"), limits.get("max_length"), (), tuple(spec.get("tags", ())))
    kinds = {item["type"] for item in limits}  # list shape: SQL types and check expressions
    length = _number(kind) if kind.upper().startswith("VARCHAR") else None
    return Field(
        name, kind, not spec.get("nullable", True), bool(kinds & {"unique", "primary_key"}), tuple(spec.get("allowed_values", ())),
        max_length=length, checks=tuple(i["expression"] for i in limits if i["type"] == "check"), tags=tuple(spec.get("tags", ())))


def from_document(document: Mapping) -> Contract:
    spec = document["spec"]
    schema, quality = spec["schema"], spec.get("data_quality", {})
    properties = schema["properties"]
    if isinstance(properties, Mapping):
        fields = [_field(name, column) for name, column in properties.items()]
    else:
        fields = [_field(column["name"], {"constraints": [], **column}) for column in properties]
    by_name = {f.name: f for f in fields}

    completeness = quality.get("completeness", {})
    if not isinstance(completeness, Mapping):
        completeness = {item["column"]: item.get("threshold", 100) for item in completeness}
    validity = quality.get("validity", [])
    if isinstance(validity, list):  # the map shape only carries prose
        for item in validity:
            known = by_name[item["column"]]
            expression = f"{item['column']} {item['rule']}"
            by_name[known.name] = Field(**{**known.__dict__, "checks": (*known.checks, expression)})

    key = schema.get("primary_key")
    if not key:
        uniques = [item.get("columns") or item.get("combination") for item in quality.get("uniqueness", [])]
        key = uniques[0][0] if uniques else next(f.name for f in fields if f.unique)

    monitoring = [m for place in (spec, quality) for m in (place.get("monitoring") or {}).get("metrics", [])]
    thresholds = {m["name"]: _number(m.get("threshold")) for m in monitoring}
    sla = spec.get("sla", {})
    freshness = quality.get("freshness") or {}
    sla_freshness = sla.get("freshness") if isinstance(sla.get("freshness"), Mapping) else {}
    hours = [h for h in (
        _number(freshness.get("max_age")), _number(freshness.get("warning_threshold")),
        sla_freshness.get("max_age_hours"), sla_freshness.get("alert_threshold_hours")) if h]
    sla_rows = sla.get("row_count") if isinstance(sla.get("row_count"), Mapping) else {}
    access = spec.get("access_control", {})
    governance = access.get("data_governance", {})
    years = _number(governance.get("retention_policy")) or _number(
        spec.get("compliance", {}).get("data_retention", {}).get("period"))

    return Contract(
        name=document["metadata"]["name"],
        version=str(document["metadata"]["version"]),
        key=key,
        fields=tuple(by_name.values()),
        masks=tuple(
            Mask(policy.get("applies_to") or policy["column"], _role_names(policy.get("authorized_roles", access.get("authorized_roles", []))))
            for policy in spec.get("masking_policies", {}).values()),
        completeness=completeness,
        business_rules=tuple(quality.get("business_rules", ())),
        warn_hours=min(hours, default=S.FRESHNESS_WARN_HOURS),
        fail_hours=max(hours, default=S.FRESHNESS_FAIL_HOURS),
        minimum_rows=thresholds.get("row_count") or sla_rows.get("minimum") or S.EXPECTED_MINIMUM_ROWS,
        high_risk_percent=thresholds.get("high_risk_percentage"),
        retention_months=years * 12 if years else S.RETENTION_MONTHS,
    )


def from_yaml(text: str) -> Contract:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading a contract file needs PyYAML; pass a dict to from_document instead") from error
    return from_document(yaml.safe_load(text))


def bundled(version: str) -> Contract:
    """The contract shipped with the package: ``"1.0.0"`` or ``"2.0.0"``."""
    name = f"churn_risk_v{version.split('.')[0]}.yaml"
    return from_yaml(resources.files("keelmark").joinpath("contracts", name).read_text())


@dataclass(frozen=True)
class Check:
    """One measure of a contract: ``measure`` is an aggregate, as SQL text or as a column."""

    rule: str
    column: str
    measure: str | Column
    limit: float
    at_least: bool = False
    severity: str = "error"

    def measured(self, name: str) -> Column:
        if isinstance(self.measure, str):
            return F.expr(f"CAST({self.measure} AS {VALUE}) AS {name}")
        return self.measure.cast(VALUE).alias(name)


def _counted(rule: str, column: str, broken: str, **details) -> Check:
    return Check(rule, column, f"count_if({broken})", 0, **details)


def constraint_checks(contract: Contract) -> list[Check]:
    """Counts of values outside the declared enumerations, ranges, lengths and expressions."""
    found = []
    for field in contract.fields:
        name = field.name
        if field.allowed:
            found.append(_counted("accepted_values", name, f"{name} NOT IN ({', '.join(map(literal, field.allowed))})"))
        if field.minimum is not None:
            found.append(_counted("minimum", name, f"{name} < {field.minimum}"))
        if field.maximum is not None:
            found.append(_counted("maximum", name, f"{name} > {field.maximum}"))
        if field.max_length:
            found.append(_counted("max_length", name, f"length(CAST({name} AS STRING)) > {field.max_length}"))
        found += [_counted("check", name, f"NOT ({expression})") for expression in field.checks]
    return found


def completeness_checks(contract: Contract) -> list[Check]:
    return [
        Check("completeness", name, ratio(F.count(name), F.count("*"), 2, 100), percent, at_least=True)
        for name, percent in contract.completeness.items()
    ]


def business_checks(contract: Contract) -> list[Check]:
    found = []
    for rule in contract.business_rules:
        name, severity = rule.get("rule_id") or rule["name"], rule.get("severity", "error")
        if "validation" in rule:
            found.append(_counted("business_rule", name, f"NOT ({rule['validation']})", severity=severity))
        else:
            found.append(Check("business_rule", name, F.count_if(rules.RULES[name].broken()), 0, severity=severity))
    return found


def all_checks(contract: Contract, at: datetime, minimum_rows: int | None = None) -> list[Check]:
    """Everything one aggregate can answer; uniqueness needs its own (see ``suite``)."""
    stamp = contract.freshness_column
    return [
        *[_counted("not_null", name, f"{name} IS NULL") for name in contract.required],
        *constraint_checks(contract),
        *completeness_checks(contract),
        *business_checks(contract),
        Check("freshness_seconds", stamp, seconds_elapsed(F.max(stamp), moment(at)), contract.fail_hours * 3600),
        Check("row_count", "*", "count(*)", contract.minimum_rows if minimum_rows is None else minimum_rows, at_least=True),
    ]


def evaluate(df: DataFrame, checks: list[Check], by: tuple[str, ...] = ()) -> DataFrame:
    """All measures in one aggregate, turned into one row per check."""
    measured = df.groupBy(*by).agg(*[c.measured(f"m{i}") for i, c in enumerate(checks)])
    limited = [(c, f"m{i}", f"CAST({c.limit} AS {VALUE})") for i, c in enumerate(checks)]
    rows = [
        (text(c.rule), text(c.column), text(c.severity), value, limit, f"coalesce({value} {'<' if c.at_least else '>'} {limit}, true)")
        for c, value, limit in limited
    ]
    return to_rows(measured, rows, ("rule", "column_name", "severity", "value", "limit_value", "violated"), by)


def suite(
    df: DataFrame, contract: Contract, at: datetime, minimum_rows: int | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """The whole contract over one table (or, with ``by``, over each group of rows).

    Uniqueness is measured on the key column alone: carrying every other measure
    through a distinct aggregate would shuffle them once per key.
    """
    result = evaluate(df, all_checks(contract, at, minimum_rows), by)
    for name in contract.unique:
        duplicates = f"count(*) - count(DISTINCT {name})"
        result = result.unionByName(evaluate(df.select(*by, name), [Check("unique", name, duplicates, 0)], by))
    return result


def expectations(contract: Contract, minimum_rows: int | None = None) -> list[quality.Expectation]:
    """The standing expectations a contract implies over ``metrics``."""
    stamp = contract.freshness_column
    return [
        *[quality.Expectation(f"no_null_{name}", "NULL_COUNT", name, "=", 0) for name in contract.required],
        quality.Expectation(f"no_duplicate_{contract.key}", "DUPLICATE_COUNT", contract.key, "=", 0),
        quality.Expectation("freshness_sla", "FRESHNESS", stamp, "<=", contract.fail_hours * 3600),
        quality.Expectation("min_row_count", "ROW_COUNT", "*", ">=", contract.minimum_rows if minimum_rows is None else minimum_rows),
    ]


def metrics(df: DataFrame, contract: Contract, at: datetime) -> DataFrame:
    """The metrics a contract asks for, as history rows: nulls, duplicates, rows, age and cardinalities."""
    standing = quality.measure(df, contract.key, contract.required, contract.freshness_column, at)
    return standing.unionByName(quality.unique_counts(df, contract.dimensions))


def column_tests(contract: Contract) -> dict[str, tuple]:
    """Column tests for ``quality.column_tests``: the key is unique, required fields are filled, enumerations hold."""
    tests: dict[str, tuple] = {}
    for field in contract.fields:
        listed = ("unique",) if field.name in contract.unique else ()
        listed += ("not_null",) if field.name in contract.required else ()
        listed += (field.allowed,) if field.allowed else ()
        if listed:
            tests[field.name] = listed
    return tests


def gate(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Release decision over ``suite`` rows: no rule of severity ``error`` may be violated."""
    def broken(severity: str) -> Column:
        return F.count_if(F.col("violated") & (F.col("severity") == severity))
    counted = results.groupBy(*by).agg(broken("error").alias("broken_errors"), broken("warning").alias("broken_warnings"))
    return counted.withColumn("passed", F.col("broken_errors") == 0)
