from __future__ import annotations

from datetime import datetime

import pytest
from helpers import account_history, bag, kept, random_accounts

from ledgerloom.operators.keyed import build_hub, build_link, link_increment, new_rows
from ledgerloom.plans.models import ACCOUNT, LINKS

T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
CURRENT = "account_id string, _source_system string, _ingested_at timestamp_ntz"


def test_hub_trims_and_takes_the_earliest_time(spark):
    rows = [
        (" A1 ", "x", T2),
        ("A1", "x", T1),
        ("A1", "y", T2),
        ("", "x", T1),
        (None, "x", T1),
        ("A2", None, T1),
    ]
    hub = build_hub(spark.createDataFrame(rows, CURRENT), ACCOUNT)
    found = {(r["account_id"], r["record_source"]): r["load_dts"] for r in hub.collect()}
    # Blank keys stay, keys or sources that are null cannot be identified.
    assert found == {("A1", "x"): T1, ("A1", "y"): T2, ("", "x"): T1}


def test_second_load_keeps_the_first_time(spark):
    first = build_hub(spark.createDataFrame([("A1", "x", T1)], CURRENT), ACCOUNT)
    second = build_hub(
        spark.createDataFrame([("A1", "x", T2), ("A2", "x", T2)], CURRENT), ACCOUNT
    )
    added = new_rows(second, first, ["account_hk"])
    assert [(r["account_id"], r["load_dts"]) for r in added.collect()] == [("A2", T2)]
    after = first.unionByName(added)
    assert new_rows(second, after, ["account_hk"]).isEmpty()


def test_null_key_in_target_does_not_block(spark):
    built = build_hub(spark.createDataFrame([("A1", "x", T1)], CURRENT), ACCOUNT)
    broken = built.selectExpr("cast(null as string) as account_hk", "account_id", "load_dts")
    assert new_rows(built, broken, ["account_hk"]).count() == 1


@pytest.mark.parametrize("newer_only", [False, True])
def test_ownership_in_two_runs(spark, newer_only):
    history = account_history(spark, random_accounts(4))
    link = LINKS["link_customer_account"]
    names = [
        name
        for _, name in sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    ]
    for split in (1, 3):
        early = history.filter(history["_snapshot_id"].isin(names[:split]))
        stored = kept(build_link(early, link))
        rows = history.filter(~history["_snapshot_id"].isin(names[:split])) if newer_only else history
        added = link_increment(rows, stored, link)
        assert bag(stored.unionByName(added)) == bag(build_link(history, link))
    assert link_increment(history, build_link(history, link), link).isEmpty()


def test_blank_destination_is_no_relationship(spark):
    rows = [("T1", "A1"), ("T2", ""), ("T3", "  "), ("T4", None), ("T5", " A1 ")]
    current = spark.createDataFrame(
        rows, "transaction_id string, destination_account_id string"
    ).selectExpr("*", "'x' as _source_system", "timestamp_ntz'2026-01-01' as _ingested_at")
    link = build_link(current, LINKS["link_transaction_destination_account"])
    assert link.count() == 2
    assert link.select("destination_account_hk").distinct().count() == 1


def test_many_copies_of_one_key(spark):
    current = spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 'HOT' else cast(id as string) end as account_id",
        "'x' as _source_system",
        "timestamp_ntz'2026-01-01' as _ingested_at",
    )
    hub = build_hub(current, ACCOUNT)
    assert hub.count() == 20_001
    assert len(bag(hub.filter("account_id = 'HOT'"))) == 1


def test_null_tests_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "transactions")
    spark.range(10).selectExpr(
        "cast(id as string) as transaction_id",
        "cast(id as string) as account_id",
        "cast(id as string) as unused",
        "'x' as _source_system",
        "timestamp_ntz'2026-01-01' as _ingested_at",
    ).write.parquet(path)
    link = build_link(spark.read.parquet(path), LINKS["link_transaction_source_account"])
    plan = link._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(transaction_id)" in plan and "IsNotNull(account_id)" in plan
    assert "unused" not in plan
    # Copies combine before the one exchange.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
