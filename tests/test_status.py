from __future__ import annotations

import pytest
from helpers import account, account_history, bag, kept, load_duck, random_accounts, same
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment, capture_list
from ledgerloom.operators.specs import Status
from ledgerloom.operators.status import build_status, next_state, status_increment, status_state
from ledgerloom.plans.models import CUSTOMER_ACCOUNT, CUSTOMER_ACCOUNT_STATUS
from oracle import sql


def events(df):
    return [
        (r["snapshot_id"], r["is_active"]) for r in df.orderBy("load_dts", "snapshot_id").collect()
    ]


@pytest.mark.parametrize("seed", range(4))
def test_random_history(spark, duck, seed):
    history = account_history(spark, random_accounts(seed, crowded=seed % 2 == 0))
    source = load_duck(duck, "history", history)
    same(build_status(history, CUSTOMER_ACCOUNT_STATUS), duck, sql.status(source))


def steps(history, captures, split, newer_only, per_source=False):
    """What a second run reads: all, or the captures after the first ``split`` and their list."""
    if not newer_only:
        return history, None, None
    newer = history.filter(F.col("_snapshot_id").isin([name for _, name in captures[split:]]))
    return newer, capture_list(history, per_source), Moment(*captures[split - 1])


@pytest.mark.parametrize("newer_only", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_two_runs_equal_one(spark, seed, newer_only):
    history = account_history(spark, random_accounts(seed, crowded=seed % 2 == 0))
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    names = [name for _, name in captures]
    for status in (CUSTOMER_ACCOUNT_STATUS, Status("sts", CUSTOMER_ACCOUNT, per_source=True)):
        whole = bag(build_status(history, status))
        for split in (1, 4):
            early = history.filter(history["_snapshot_id"].isin(names[:split]))
            stored = kept(build_status(early, status))
            rows, listed, last = steps(history, captures, split, newer_only, status.per_source)
            added = status_increment(rows, stored, status, listed, last)
            after = kept(stored.unionByName(added))
            if captures[split - 1][0] != captures[split][0]:
                assert bag(after) == whole
            # The same again, as after an interrupted run.
            assert status_increment(rows, after, status, listed, last).isEmpty()


@pytest.mark.parametrize("newer_only", [False, True])
def test_split_within_one_instant(spark, newer_only):
    """A capture of the same instant as stored ones: a new relationship was absent in those."""
    stored_rows = [account("A0", "s0", 0), account("A0", "s1", 1), account("A1", "s2", 1)]
    early = account_history(spark, stored_rows)
    stored = build_status(early, CUSTOMER_ACCOUNT_STATUS)
    history = early.unionByName(account_history(spark, [account("A2", "s3", 1)]))
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    rows, listed, last = steps(history, captures, 3, newer_only)
    after = stored.unionByName(
        status_increment(rows, stored, CUSTOMER_ACCOUNT_STATUS, listed, last)
    )
    assert bag(after) == bag(build_status(history, CUSTOMER_ACCOUNT_STATUS))


def test_a_quiet_capture_changes_nothing(spark):
    rows = [account("A1", f"s{i}", i) for i in range(4)]
    history = account_history(spark, rows)
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    stored = kept(build_status(history.filter("_snapshot_id <> 's3'"), CUSTOMER_ACCOUNT_STATUS))
    newer, listed, last = steps(history, captures, 3, True)
    assert last.snapshot_id == "s2"
    assert status_increment(newer, stored, CUSTOMER_ACCOUNT_STATUS, listed, last).isEmpty()


def test_first_run(spark):
    history = account_history(spark, random_accounts(3))
    whole = bag(build_status(history, CUSTOMER_ACCOUNT_STATUS))
    assert bag(status_increment(history, None, CUSTOMER_ACCOUNT_STATUS)) == whole
    nothing = build_status(account_history(spark, []), CUSTOMER_ACCOUNT_STATUS)
    assert bag(status_increment(history, nothing, CUSTOMER_ACCOUNT_STATUS)) == whole


def test_gone_and_back(spark):
    other = [account("A2", f"s{i}", i) for i in range(5)]
    rows = [account("A1", "s0", 0), account("A1", "s3", 3)] + other
    found = build_status(account_history(spark, rows), CUSTOMER_ACCOUNT_STATUS)
    one = found.filter(found["account_hk"] != found.orderBy("load_dts").first()["account_hk"])
    both = sorted([events(one), events(found.subtract(one))], key=len)
    assert both == [
        [("s0", True)],
        [("s0", True), ("s1", False), ("s3", True), ("s4", False)],
    ]


def test_equal_times_may_start_absent(spark):
    rows = [account("A2", "s0", 0), account("A1", "s1", 0), account("A2", "s1", 0)]
    found = build_status(
        account_history(spark, [r for r in rows]), CUSTOMER_ACCOUNT_STATUS
    ).groupBy("account_hk").count()
    assert sorted(r["count"] for r in found.collect()) == [1, 2]


def test_run_log_knows_an_empty_capture(spark):
    history = account_history(spark, [account("A1", "s0", 0)])
    log = spark.sql(
        "select 's0' as snapshot_id, timestamp_ntz'2026-01-01' as load_dts union all "
        "select 's1', timestamp_ntz'2026-01-02'"
    )
    assert events(build_status(history, CUSTOMER_ACCOUNT_STATUS)) == [("s0", True)]
    assert events(build_status(history, CUSTOMER_ACCOUNT_STATUS, log)) == [
        ("s0", True),
        ("s1", False),
    ]


def test_sources_apart_or_together(spark):
    rows = [account("A1", "x0", 0, source="x"), account("A1", "y0", 1, source="y")]
    history = account_history(spark, rows)
    assert build_status(history, CUSTOMER_ACCOUNT_STATUS).count() == 3
    apart = Status("sts", CUSTOMER_ACCOUNT, per_source=True)
    assert [active for _, active in events(build_status(history, apart))] == [True, True]


def test_empty_history(spark):
    assert build_status(account_history(spark, []), CUSTOMER_ACCOUNT_STATUS).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_state_carried_on(spark, seed):
    """The kept state stands for all rows of the past, capture by capture."""
    history = account_history(spark, random_accounts(seed))
    captures = sorted({(r["_snapshot_at"], r["_snapshot_id"]) for r in history.collect()})
    first = history.filter(F.col("_snapshot_id") == captures[0][1])
    stored = kept(build_status(first, CUSTOMER_ACCOUNT_STATUS))
    state = kept(status_state(stored, CUSTOMER_ACCOUNT_STATUS))
    listed = capture_list(history)
    for (before, name), (at, now) in zip(captures, captures[1:]):
        last = Moment(before, name)
        past = ~Moment(at, now).before(F.col("load_dts"), F.col("snapshot_id"))
        one = history.filter(F.col("_snapshot_id") == now)
        # Nothing of the past is at hand but the state.
        changes = kept(
            status_increment(one, stored.limit(0), CUSTOMER_ACCOUNT_STATUS, listed.filter(past), last, state)
        )
        stored = kept(stored.unionByName(changes))
        state = kept(next_state(state, changes, CUSTOMER_ACCOUNT_STATUS))
        assert bag(state) == bag(status_state(stored, CUSTOMER_ACCOUNT_STATUS))
    assert bag(stored) == bag(build_status(history, CUSTOMER_ACCOUNT_STATUS))
