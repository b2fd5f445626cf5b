"""Registry of queries and of the SQL views their checks are written over."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keelmark.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
MODULE: dict[str, str] = {}
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, body: str, *needs: str) -> None:
    """Declare a common table expression and the ones it reads."""
    _VIEWS[name] = (needs, body.strip())


def over(body: str, *needs: str) -> str:
    """``body`` preceded by the views it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for parent in _VIEWS[name][0]:
            visit(parent)
        ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body.strip()
    listed = ",\n".join(f"{name} AS (\n{_VIEWS[name][1]}\n)" for name in ordered)
    return f"WITH {listed}\n{body.strip()}"


def query(name: str, sql: str | None = None, *needs: str):
    """Register a Spark query; with ``sql``, also its check over the views in ``needs``."""
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_utc(spark)
            return function(spark, folder)

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        MODULE[name] = function.__module__
        if sql is not None:
            SQL[name] = over(sql, *needs)
        return function
    return register
