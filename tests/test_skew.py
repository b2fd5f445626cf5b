"""One key holding a third of all rows: results stay whole, and the heavy part can be split."""

from collections import Counter
from datetime import date, timedelta
from decimal import Decimal as D

import pytest

from keelmark.operators import features, quality
from tests.helpers import rows

AS_OF = date(2024, 2, 29)
HOT, ACCOUNTS, MOVES = 1, 200, 6000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    listed = [
        (f"t{i}", HOT if i % 3 == 0 else 2 + i % (ACCOUNTS - 1), AS_OF - timedelta(days=i % 200), D("1.00"), "ATM") for i in range(MOVES)]
    path = str(tmp_path_factory.mktemp("skew") / "moves")
    spark.createDataFrame(listed, "txn_id string, account_id bigint, txn_date date, amount decimal(15,2), channel string").repartition(6).write.parquet(path)
    accounts = spark.createDataFrame(
        [(a, a % 50, "CURRENT_ACCOUNT", "ACTIVE", D("1.00")) for a in range(1, ACCOUNTS + 1)],
        "account_id bigint, customer_id bigint, account_type string, account_status string, current_balance decimal(15,2)")
    return listed, spark.read.parquet(path), accounts


def test_activity_of_every_account_is_complete(spark, skewed):
    listed, moves, _ = skewed
    got = {r.account_id: (r.recent, r.prior) for r in features.account_activity(moves, AS_OF).collect()}
    recent, prior = Counter(), Counter()
    for _, account, when, _, _ in listed:
        if when >= date(2023, 11, 29):
            recent[account] += 1
        elif when >= date(2023, 8, 29):
            prior[account] += 1
    assert got == {a: (recent[a], prior[a]) for a in recent | prior}


def test_distinct_average_is_complete(spark, skewed):
    listed, moves, accounts = skewed
    repeated = moves.unionByName(moves)
    expected = Counter(a % 50 for _, a, when, _, _ in listed if when >= date(2023, 11, 29))
    got = {r.customer_id: r.avg_monthly_transactions for r in features.distinct_monthly_average(accounts, repeated, AS_OF).collect()}
    assert got == {c: expected[c] / 3 for c in range(50)}


def test_orphan_rows_of_a_hot_key_are_all_counted(spark, skewed):
    listed, moves, accounts = skewed
    known = accounts.filter(accounts.account_id != HOT)
    assert rows(quality.orphans(moves, "account_id", known, "account_id")) == [(sum(1 for m in listed if m[1] == HOT), 1, 0)]


def test_a_heavy_partition_of_raw_rows_is_split_in_the_join(spark, skewed):
    listed, moves, accounts = skewed
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = moves.join(features.active(accounts).select("account_id", "customer_id"), "account_id")
        assert len(joined.collect()) == MOVES
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
