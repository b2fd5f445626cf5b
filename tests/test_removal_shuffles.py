"""A removal reads and moves no more than it has to."""

import pytest

from keelmark.operators import governance, versions

CASCADE = [("accounts", "customer_id", "request", None), ("moves", "account_id", "accounts", "account_id")]


def stored_tables(spark, folder):
    accounts = spark.createDataFrame([(10, 1), (11, 1), (11, 1), (20, 2), (30, 3), (40, None), (None, 3)], "account_id bigint, customer_id bigint")
    moves = spark.createDataFrame([(10, 5.0), (11, 1.0), (11, 1.0), (20, 2.0), (30, 3.0), (None, 4.0)], "account_id bigint, amount double")
    return governance.store_for_removal({"accounts": (accounts, "customer_id"), "moves": (moves, "account_id")}, folder, 4)


def test_cascade_holds_only_keys_that_a_later_table_needs(spark, tmp_path, monkeypatch):
    kept, hold = {}, governance._held
    monkeypatch.setattr(governance, "_held", lambda df, purpose: kept.setdefault(purpose, hold(df, purpose)))
    held = stored_tables(spark, str(tmp_path / "store"))
    requests = spark.createDataFrame([(1,), (1,), (None,)], "customer_id bigint")
    governance.apply_removal(spark, held, CASCADE, requests, "customer_id", "r1", str(tmp_path / "log"), 4)
    assert {name: df.columns for name, df in kept.items()} == {"request": ["_key"], "accounts": ["account_id"]}


@pytest.mark.parametrize("broadcast", [0, 100])
def test_removal_with_few_and_with_many_keys(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(governance, "BROADCAST_KEYS", broadcast)
    held = stored_tables(spark, str(tmp_path / "store"))
    requests = spark.createDataFrame([(1,), (2,), (None,)], "customer_id bigint")
    governance.apply_removal(spark, held, CASCADE, requests, "customer_id", "r1", str(tmp_path / "log"), 4)
    left = {name: sorted(map(tuple, spark.read.parquet(path).drop(versions.BUCKET).collect()), key=str) for name, (path, _) in held.items()}
    assert left == {"accounts": [(30, 3), (40, None), (None, 3)], "moves": [(30, 3.0), (None, 4.0)]}
    logged = {r["table_name"]: r["rows_removed"] for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert logged == {"accounts": 4, "moves": 4}
