"""Run registered queries against their SQL on the same Parquet files.

    python -m parity.compare <folder> [query ...]
"""

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count and what differs: names, types, then the rows as a multiset."""
    expected = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    names = sorted(types)
    found: list[str] = []
    if sorted(df.columns) != names:
        return -1, [f"columns {sorted(df.columns)} != {names}"]
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        duck_type = _SPARK_TO_DUCK.get(spark_type, spark_type.upper())
        if duck_type != types[field.name]:
            found.append(f"type of {field.name}: {spark_type} != {types[field.name]}")
    order = [list(types).index(n) for n in names]
    wanted = Counter(tuple(_plain(row[i]) for i in order) for row in expected.fetchall())
    rows = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    got = Counter(rows)
    if got != wanted:
        found.append(f"{sum((got - wanted).values())} rows only in Spark, {sum((wanted - got).values())} only in SQL")
        found += [f"  spark {dict(zip(names, r))}" for r in list((got - wanted))[:2]]
        found += [f"  sql   {dict(zip(names, r))}" for r in list((wanted - got))[:2]]
    return len(rows), found


def main() -> int:
    from keelmark.session import local_session
    from parity import QUERIES, SQL

    folder, *chosen = sys.argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in chosen or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in SQL:
                count, found = differences(df, connection, SQL[name])
            else:
                count, found = df.count(), []
        except Exception as error:  # report every query, then fail at the end
            count, found = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        state = "FAIL" if found else ("ok" if name in SQL else "ok (rows only)")
        print(f"{state:5} {name:32} {count:8} rows {time.time() - started:6.2f}s", flush=True)
        for line in found:
            print("      ", line)
    print(f"{bad} of {len(chosen or QUERIES)} failed")
    spark.stop()
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
