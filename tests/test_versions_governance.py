from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keelmark import settings as S
from keelmark.operators import consumption, governance, versions
from keelmark.plans import contract as contracts
from keelmark.sources import entities, tables
from tests.helpers import rows


def test_upsert_keeps_the_newest_row_and_prefers_the_incoming_one(spark):
    schema = "k int, score_calculated_at timestamp_ntz, v string"
    at = lambda d: datetime(2024, 1, d)
    old = spark.createDataFrame([(1, at(1), "old"), (2, at(1), "old"), (3, at(9), "old")], schema)
    new = spark.createDataFrame([(2, at(2), "new"), (2, at(3), "newer"), (3, at(9), "same"), (4, at(2), "new")], schema)
    assert rows(versions.upsert(old, new, "k").select("k", "v")) == [(1, "old"), (2, "newer"), (3, "same"), (4, "new")]
    assert rows(versions.upsert(versions.upsert(old, new, "k"), new, "k")) == rows(versions.upsert(old, new, "k"))


def test_incremental_refresh_leaves_the_previous_table_alone(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    frame = lambda *rows: spark.createDataFrame(rows, "k int, score_calculated_at timestamp_ntz, v string")
    frame((1, datetime(2024, 1, 1), "x"), (2, datetime(2024, 1, 1), "x")).write.parquet(first)
    merged = versions.incremental_refresh(first, frame((2, datetime(2024, 1, 2), "y"), (3, datetime(2024, 1, 2), "y")), "k", second)
    assert rows(merged.select("k", "v")) == [(1, "x"), (2, "y"), (3, "y")]
    assert spark.read.parquet(first).count() == 2


def test_bucket_refresh_rewrites_only_touched_buckets(spark, tmp_path):
    import os

    path = str(tmp_path / "product")
    frame = lambda *rows: spark.createDataFrame(rows, "k int, score_calculated_at timestamp_ntz, v string")
    old = frame(*[(k, datetime(2024, 1, 1), "x") for k in range(40)], (None, datetime(2024, 1, 1), "n"))
    versions.write_bucketed(old, path, "k", 8)

    def files():
        return {(d, f): os.stat(os.path.join(path, d, f)).st_mtime_ns
                for d in os.listdir(path) if d.startswith(versions.BUCKET) for f in os.listdir(os.path.join(path, d))}

    before = files()
    incoming = frame((3, datetime(2024, 1, 2), "y"), (3, datetime(2024, 1, 3), "z"), (100, datetime(2024, 1, 2), "new"),
                     (5, datetime(2023, 1, 1), "older"), (None, datetime(2024, 1, 2), "m"))
    touched = versions.refresh_buckets(path, incoming, "k", 8)
    after = files()
    untouched = {(d, f): t for (d, f), t in before.items() if int(d.split("=")[1]) not in touched}
    assert untouched and all(after.get(name) == t for name, t in untouched.items())  # same names, never rewritten
    assert len(touched) < 8
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    expected = {k: "x" for k in range(40)} | {3: "z", 100: "new", None: "m"}
    assert got == expected and spark.read.parquet(path).count() == 42


def test_column_differences(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, x string, y int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", None), (4, "d", 1)], "k int, x string, y int")
    assert rows(versions.column_differences(old, new, "k", ["x", "y"])) == [
        ("added rows", "k", 1), ("changed values", "x", 1), ("changed values", "y", 1), ("missing rows", "k", 1)]


def test_snapshot_is_written_once(spark, tmp_path):
    path = str(tmp_path / "snap")
    first, second = spark.range(3).toDF("k"), spark.range(9).toDF("k")
    tables.snapshot_once(first, path, "1.0.0", datetime(2024, 1, 1), "first")
    tables.snapshot_once(second, path, "2.0.0", datetime(2024, 1, 2), "second")
    kept = spark.read.parquet(path)
    assert kept.count() == 3 and {r.snapshot_version for r in kept.collect()} == {"1.0.0"}
    assert versions.version_summary(kept, "v", "snapshot_at").first().column_count == 4


def test_publish_refresh_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3).toDF("k"), "kept", path=path)
    tables.publish(spark.range(5).toDF("k"), "kept", path=path)
    assert spark.table("kept").count() == 5
    tables.append(spark.range(2).toDF("k"), path)
    assert spark.read.parquet(path).count() == 7
    tables.publish(spark.range(4).toDF("k"), "seen", "view")
    assert spark.table("seen").count() == 4
    with pytest.raises(ValueError):
        tables.publish(spark.range(1), "x", "stream")
    with pytest.raises(ValueError):
        tables.publish(spark.range(1), "x")


def test_log_payload_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    changes = spark.createDataFrame([("p", ["a", "b"], False)], "product string, new_columns array<string>, breaking boolean")
    for _ in range(2):
        tables.append(tables.log_entries(changes, ["new_columns", "breaking"]), path)
    parsed = spark.read.parquet(path).select("product", F.parse_json("changes").alias("c"))
    got = parsed.select("product", F.variant_get("c", "$.new_columns[1]", "string"), F.variant_get("c", "$.breaking", "boolean"))
    assert rows(got) == [("p", "b", False)] * 2


def test_clustering_spreads_a_dominant_account(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("account_id"), F.expr("date_add(DATE '2024-01-01', CAST(id % 365 AS INT))").alias("txn_date"))
    laid = tables.clustered(df, ["account_id", "txn_date"], partitions=6)
    per_task = laid.filter("account_id = 7").groupBy(F.spark_partition_id()).count()
    assert per_task.count() > 1 and laid.count() == 3000


CONTRACT = contracts.bundled(S.V1)


@pytest.mark.parametrize("roles, name", [
    (["PUBLIC"], "J****"), ([], "J****"), (["Retention_Analyst"], "John Smith"), (["intern", "DATA_SCIENCE_TEAM"], "John Smith")])
def test_masking_by_role(spark, roles, name):
    df = spark.createDataFrame([(1, "John Smith")], "customer_id int, customer_name string")
    assert governance.masked_view(df, CONTRACT, roles).first().customer_name == name


def test_masking_of_null_and_empty_names_and_compliance(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Bo")], "customer_id int, customer_name string")
    hidden = governance.masked_view(df, CONTRACT, ["public"])
    assert [r.customer_name for r in hidden.orderBy("customer_id").collect()] == [None, "****", "B****"]
    assert rows(governance.masking_compliance(hidden, df, CONTRACT)) == [("customer_name", 3, 0)]
    assert rows(governance.masking_compliance(df, df, CONTRACT)) == [("customer_name", 3, 2)]


def test_retention_and_removal(spark):
    accounts = spark.createDataFrame([(1, date(2017, 2, 28)), (2, date(2017, 3, 1)), (3, None)], "account_id int, closed_date date")
    expired = governance.expired_accounts(accounts, date(2024, 2, 29))
    assert rows(expired.select("account_id")) == [(1,)]
    moves = spark.createDataFrame([(1,), (1,), (2,), (None,)], "account_id int")
    assert rows(governance.removal_audit({"moves": (moves, "account_id")}, expired, "account_id")) == [("moves", 4, 2, 2)]
    assert governance.without(moves, "account_id", expired).count() == 2


def test_metric_query_validates_and_filters(spark):
    df = spark.createDataFrame([("A", "LOW", 1, 10), ("A", "HIGH", 2, 20), ("B", "LOW", None, 30)],
                               "customer_segment string, risk_tier string, customer_id int, churn_risk_score int")
    assert rows(consumption.metric_query(df, ["customer_segment"])) == [("A", 2), ("B", 0)]
    assert rows(consumption.metric_query(df, [], {"m": F.max("churn_risk_score")}, F.col("risk_tier") == "LOW")) == [(30,)]
    with pytest.raises(ValueError):
        consumption.metric_query(df, ["email"])


def test_entities_conform_and_report_domains(spark):
    assert [len(entities.schema_of(e)) for e in entities.FIELDS] == [12, 14, 12, 14, 16]
    schema = entities.schema_of("customers")
    assert schema["email"].metadata == {"pii": True} and schema["email"].nullable and not schema["customer_id"].nullable
    raw = spark.createDataFrame([(1, "2024-01-31", "GOLD"), (2, "soon", "AFFLUENT"), (3, None, None)],
                                "customer_id int, onboarding_date string, customer_segment string")
    got = entities.conform(raw, "customers")
    assert got.columns == schema.names and got.schema["onboarding_date"].dataType == schema["onboarding_date"].dataType
    assert [(r.customer_id, r.onboarding_date, r.kyc_status) for r in got.orderBy("customer_id").collect()] == [
        ("1", date(2024, 1, 31), "VERIFIED"), ("2", None, "VERIFIED"), ("3", None, "VERIFIED")]
    found = {r.column_name: (r.violations, r.nulls) for r in entities.domain_violations(got, "customers").collect()}
    assert found == {"customer_segment": (1, 1), "onboarding_channel": (0, 3), "kyc_status": (0, 0)}


def test_erasure_cascade_removes_rows_and_logs_once(spark, tmp_path):
    import os

    people = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "customer_id bigint, name string")
    accounts = spark.createDataFrame([(10, 1), (11, 1), (20, 2), (30, 3), (40, None)], "account_id bigint, customer_id bigint")
    moves = spark.createDataFrame([(10, 5.0), (11, 1.0), (20, 2.0), (30, 3.0), (None, 4.0)], "account_id bigint, amount double")
    base = str(tmp_path / "store")
    held = governance.store_for_removal(
        {"customers": (people, "customer_id"), "accounts": (accounts, "customer_id"), "transactions": (moves, "account_id")}, base, 4)
    before = {d: os.listdir(os.path.join(held["transactions"][0], d)) for d in os.listdir(held["transactions"][0]) if "=" in d}
    cascade = [("customers", "customer_id", "request", None), ("accounts", "customer_id", "request", None),
               ("transactions", "account_id", "accounts", "account_id")]
    requests = spark.createDataFrame([(1,), (1,), (None,)], "customer_id bigint")
    log = str(tmp_path / "log")
    assert governance.apply_removal(spark, held, cascade, requests, "customer_id", "r1", log, 4)
    assert not governance.apply_removal(spark, held, cascade, requests, "customer_id", "r1", log, 4)
    read = lambda name: spark.read.parquet(held[name][0]).drop(versions.BUCKET)
    assert sorted(r[0] for r in read("accounts").select("account_id").collect()) == [20, 30, 40]
    assert sorted(r[1] for r in read("transactions").collect()) == [2.0, 3.0, 4.0]
    assert read("customers").count() == 3
    assert sorted((r["table_name"], r["rows_removed"]) for r in spark.read.parquet(log).collect()) == [
        ("accounts", 2), ("customers", 1), ("transactions", 2)]
    touched = {versions.BUCKET + "=" + str(r[0]) for r in spark.createDataFrame([(10,), (11,)], "k bigint")
               .select(versions.key_bucket("k", 4)).collect()}
    after = {d: os.listdir(os.path.join(held["transactions"][0], d)) for d in os.listdir(held["transactions"][0]) if "=" in d}
    assert all(after[d] == files for d, files in before.items() if d not in touched)  # untouched buckets keep their files


def test_log_append_is_once_per_id_and_keeps_variant(spark, tmp_path):
    log = str(tmp_path / "log")
    entries = spark.createDataFrame([("c1", '{"added": ["a", "b"], "reason": "x"}'), ("c2", '{"added": [], "reason": null}')],
                                    "change_id string, body string").select("change_id", F.parse_json("body").alias("payload"))
    assert tables.append_once(entries, log, "change_id") == 2
    assert tables.append_once(entries, log, "change_id") == 0
    read = spark.read.parquet(log)
    assert read.schema["payload"].dataType.simpleString() == "variant"
    got = sorted((r[0], r[1]) for r in read.select("change_id", F.variant_get("payload", "$.added", "array<string>")).collect())
    assert got == [("c1", ["a", "b"]), ("c2", [])]
