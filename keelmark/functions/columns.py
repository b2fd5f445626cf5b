"""Small column builders shared by the operators."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark import settings as S


def bounded(value: Column, low: int = S.SCORE_MIN, high: int = S.SCORE_MAX) -> Column:
    """Clamp a non-null number. (``least``/``greatest`` skip nulls, so callers coalesce first.)"""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def points(condition: Column, amount: int) -> Column:
    return F.when(condition, F.lit(amount)).otherwise(F.lit(0))


def total(parts: Iterable[Column]) -> Column:
    result = None
    for part in parts:
        result = part if result is None else result + part
    return result


def any_of(parts: Iterable[Column]) -> Column:
    result = None
    for part in parts:
        result = part if result is None else result | part
    return result


def masked(value: Column) -> Column:
    """First character followed by a fixed suffix; null stays null."""
    return F.concat(F.left(value, F.lit(1)), F.lit(S.MASK_SUFFIX))


def ratio(part: Column, whole: Column, digits: int, factor: int = 1) -> Column:
    """``factor * part / whole`` in decimals, half up; null when ``whole`` is 0."""
    exact = (part * factor).cast("decimal(24,2)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value) -> str:
    """A configured value as SQL: strings are quoted, numbers are not."""
    return text(value) if isinstance(value, str) else str(value)


def to_rows(df: DataFrame, rows: Iterable[Sequence[str]], names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Turn every record into one output row per entry of ``rows`` (an unpivot without a join).

    Entries are SQL expressions over the record; long lists of measures are written
    this way because one parsed text replaces thousands of calls into the JVM.
    """
    entries = [
        "named_struct(" + ", ".join(f"'{n}', {value}" for n, value in zip(names, row, strict=True)) + ")" for row in rows
    ]
    return df.selectExpr(*keep, f"inline(array({', '.join(entries)}))")
