from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import DAY, account, account_history, bag, kept, load_duck, random_accounts, same
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment, capture_list
from ledgerloom.operators.keyed import new_rows
from ledgerloom.operators.satellite import build_satellite, satellite_increment, satellite_repair
from ledgerloom.plans.models import ACCOUNT_DETAILS
from oracle import sql


def versions(df):
    return [
        (r["account_id"], r["snapshot_id"], r["status"])
        for r in df.orderBy("account_id", "load_dts", "snapshot_id", "status").collect()
    ]


def test_there_and_back_is_three_versions(spark):
    rows = [account("A1", f"s{i}", i, status=s) for i, s in enumerate("AABBA")]
    found = versions(build_satellite(account_history(spark, rows), ACCOUNT_DETAILS))
    assert found == [("A1", "s0", "A"), ("A1", "s2", "B"), ("A1", "s4", "A")]


def test_return_without_change_is_no_version(spark):
    rows = [account("A1", "s0", 0), account("A2", "s1", 1), account("A1", "s2", 2)]
    found = build_satellite(account_history(spark, rows), ACCOUNT_DETAILS)
    assert [(a, s) for a, s, _ in versions(found)] == [("A1", "s0"), ("A2", "s1")]


def test_null_to_value_is_a_change(spark):
    rows = [account("A1", f"s{i}", i, iban=v) for i, v in enumerate([None, None, "DE1", ""])]
    found = build_satellite(account_history(spark, rows), ACCOUNT_DETAILS)
    assert [s for _, s, _ in versions(found)] == ["s0", "s2", "s3"]


def test_empty_and_single_capture(spark):
    assert build_satellite(account_history(spark, []), ACCOUNT_DETAILS).isEmpty()
    one = account_history(spark, [account("A1", "s0", 0), account(None, "s0", 0)])
    assert build_satellite(one, ACCOUNT_DETAILS).count() == 1


@pytest.mark.parametrize("seed", [11, 12, 13])
@pytest.mark.parametrize("crowded", [False, True])
def test_random_history(spark, duck, seed, crowded):
    history = account_history(spark, random_accounts(seed, crowded=crowded))
    source = load_duck(duck, "history", history)
    # Copies within a capture are one version, as each equals the one before it.
    same(
        build_satellite(history, ACCOUNT_DETAILS),
        duck,
        sql.satellite("sat_account_details", source),
    )


def after(history, captures, split):
    """The captures after the first ``split``, and the last of these."""
    at, name = captures[split - 1]
    newer = history.filter(F.col("_snapshot_id").isin([n for _, n in captures[split:]]))
    return newer, Moment(at, name)


@pytest.mark.parametrize("newer_only", [False, True])
def test_two_runs_equal_one(spark, newer_only):
    history = account_history(spark, random_accounts(7, crowded=True))
    captures = sorted(
        {(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()}
    )
    names = [name for _, name in captures]
    whole = bag(build_satellite(history, ACCOUNT_DETAILS))
    for split in (1, 4):
        early = history.filter(history["_snapshot_id"].isin(names[:split]))
        stored = kept(build_satellite(early, ACCOUNT_DETAILS))
        rows, last = after(history, captures, split) if newer_only else (history, None)
        added = kept(satellite_increment(rows, stored, ACCOUNT_DETAILS, last))
        complete = kept(stored.unionByName(added))
        assert bag(complete) == whole
        # The same again, or after a run that stored a part of it.
        assert satellite_increment(rows, complete, ACCOUNT_DETAILS, last).isEmpty()
        nothing, end = after(history, captures, len(captures))
        assert satellite_increment(nothing, complete, ACCOUNT_DETAILS, end).isEmpty()


def test_first_run(spark):
    history = account_history(spark, random_accounts(3))
    whole = bag(build_satellite(history, ACCOUNT_DETAILS))
    assert bag(satellite_increment(history, None, ACCOUNT_DETAILS)) == whole
    nothing = build_satellite(account_history(spark, []), ACCOUNT_DETAILS)
    assert bag(satellite_increment(history, nothing, ACCOUNT_DETAILS)) == whole


def test_late_capture_is_added_and_nothing_taken_back(spark):
    first = account_history(
        spark, [account("A1", "s1", 1, status="a"), account("A1", "s3", 3, status="b")]
    )
    stored = build_satellite(first, ACCOUNT_DETAILS)
    late = first.unionByName(account_history(spark, [account("A1", "s2", 2, status="b")]))
    after = stored.unionByName(satellite_increment(late, stored, ACCOUNT_DETAILS))
    assert [s for _, _, s in versions(after)] == ["a", "b", "b"]
    assert [s for _, _, s in versions(build_satellite(late, ACCOUNT_DETAILS))] == ["a", "b"]


def test_stored_pairs_may_repeat(spark):
    rows = account_history(spark, [account("A1", "s0", 0), account("A1", "s0", 0, status="x")])
    built = build_satellite(rows, ACCOUNT_DETAILS)
    assert built.count() == 2
    assert new_rows(built, built, ["account_hk", "snapshot_id"], unique=False).isEmpty()


def test_building_runs_no_job(spark):
    history = account_history(spark, random_accounts(2, crowded=True))
    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        build_satellite(history, ACCOUNT_DETAILS)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_key_is_one_row_per_capture_and_task(spark):
    """Rows of one key in one capture are combined before the exchange."""
    rows = [account("HOT", "s0", 0, status=s) for s in "ABABAB" * 500]
    rows += [account(f"A{i}", "s0", 0) for i in range(20)]
    history = account_history(spark, rows).repartition(4).cache()
    plan = build_satellite(history, ACCOUNT_DETAILS)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("partial_min(_version") :]
    assert "Exchange" not in plan[: plan.index("partial_min(_version")].split("\n")[-1]
    assert "Scan" in first
    assert build_satellite(history, ACCOUNT_DETAILS).filter("account_id = 'HOT'").count() == 2


def test_stored_versions_are_cut_to_the_newer_keys_first(spark):
    history = account_history(spark, random_accounts(7))
    stored = kept(build_satellite(history, ACCOUNT_DETAILS))
    newer = account_history(spark, [account("A1", "s9", 90, status="x")])
    last = Moment(DAY + timedelta(days=89), "s8")
    fresh = satellite_increment(newer, stored, ACCOUNT_DETAILS, last)
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    # Deeper in the plan is earlier.
    assert plan.index("max_by") < plan.index("Join LeftSemi", plan.index("max_by"))
    assert [s for _, s, _ in versions(fresh)] == ["s9"]


def scans(df) -> list[str]:
    """Names of the scans of a plan that were not dropped while it ran, without those of reused exchanges."""
    df.collect()
    plans, found = [df._jdf.queryExecution().executedPlan()], []
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "FileSourceScanExec":
                found.append(plan.toString())
            children = plan.children()
            plans += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("crowded, read", [(False, 1), (True, 2)])
def test_history_is_read_once(spark, tmp_path, crowded, read):
    """Versions between lowest and highest are looked up only where a key has several in a capture."""
    rows = random_accounts(2, crowded=crowded)
    account_history(spark, rows).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    built = build_satellite(history, ACCOUNT_DETAILS)
    assert len(scans(built)) == read
    assert bag(built) == bag(build_satellite(account_history(spark, rows), ACCOUNT_DETAILS))


@pytest.mark.parametrize("seed", range(5))
def test_repair_equals_a_rebuild(spark, seed):
    """Captures missing from a stored satellite, taken in afterwards; keys of other captures are not touched."""
    history = kept(account_history(spark, random_accounts(seed, crowded=seed % 2 == 1)))
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    missing = captures[1 + seed % 3 : 3 + seed % 3]
    names = [name for _, name in missing]
    is_late = F.col("_snapshot_id").isin(names)
    existing = kept(build_satellite(history.filter(~is_late), ACCOUNT_DETAILS))
    late = capture_list(history).filter(F.col("snapshot_id").isin(names))
    first = Moment(*missing[0])
    from_there = history.filter(F.col("_snapshot_at") >= first.at_literal)
    add, gone = (kept(rows) for rows in satellite_repair(from_there, existing, ACCOUNT_DETAILS, late, first))
    after = kept(existing.exceptAll(gone).unionByName(add))
    assert bag(after) == bag(build_satellite(history, ACCOUNT_DETAILS))
    # The same again, as after an interrupted run.
    add, gone = satellite_repair(from_there, after, ACCOUNT_DETAILS, late, first)
    assert add.isEmpty() and gone.isEmpty()


def shuffled_by(plan: str) -> list[str]:
    return [line.split("hashpartitioning(")[1] for line in plan.split("\n") if "hashpartitioning(" in line]


def test_versions_of_a_crowded_key_are_spread(spark):
    """The versions between lowest and highest meet no join that deals them by key and capture alone."""
    rows = [account("HOT", "s0", 0, iban=f"I{i % 400}") for i in range(1200)]
    rows += [account(f"A{i}", "s0", 0) for i in range(20)]
    built = build_satellite(account_history(spark, rows), ACCOUNT_DETAILS)
    plan = built._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line and "LeftSemi" in line]
    assert joins and all("snapshot_id" in line and "account_id" not in line for line in joins)
    assert built.filter("account_id = 'HOT'").count() == 400
    assert built.count() == 420


def test_newer_captures_are_compared_by_raw_key_and_joined_by_bytes(spark):
    """What is stored is read by one exchange, and no exchange carries a hash as text or a change hash."""
    history = account_history(spark, random_accounts(5, crowded=True))
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    early = history.filter(F.col("_snapshot_id").isin([name for _, name in captures[:3]]))
    stored = kept(build_satellite(early, ACCOUNT_DETAILS))
    rows, last = after(history, captures, 3)
    for increment in (
        satellite_increment(rows, stored, ACCOUNT_DETAILS, last),
        satellite_increment(history, stored, ACCOUNT_DETAILS),
    ):
        plan = increment._jdf.queryExecution().executedPlan().toString()
        assert not [by for by in shuffled_by(plan) if "account_hk" in by or "hashdiff" in by]
        added = bag(stored.unionByName(increment))
        assert added == bag(build_satellite(history, ACCOUNT_DETAILS))


def test_an_exchange_of_stored_rows_is_used_again(spark):
    """The hash key is known to be there, so that a join above adds no filter which makes two exchanges differ."""
    history = account_history(spark, random_accounts(5))
    assert not build_satellite(history, ACCOUNT_DETAILS).schema["account_hk"].nullable
