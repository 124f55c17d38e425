"""Writing tables: a run repeated, interrupted, resumed; drift; buckets; counts."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from helpers import account, account_history, bag
from pyspark.sql import functions as F

from ledgerloom.operators.keyed import build_hub, build_link, new_rows
from ledgerloom.operators.point_in_time import build_pit, build_pit_pruned
from ledgerloom.operators.captures import Moment, capture_list
from ledgerloom.operators.satellite import build_satellite
from ledgerloom.operators.status import build_status, status_state
from ledgerloom.plans import gold
from ledgerloom.plans.models import (
    CUSTOMER_ACCOUNT_STATUS,
    HUBS,
    LINKS,
    POINTS_IN_TIME,
    SATELLITES,
)
from ledgerloom.plans.run import (
    load_captures,
    load_current,
    rebuild_satellites,
    run_all,
    write_business_vault,
    write_vault,
)
from ledgerloom.plans.silver import SILVER
from ledgerloom.sources.readers import file_reader, frame_reader, row_counts
from ledgerloom.sources.stamping import stamp_current
from ledgerloom.sources.sample import CAPTURES, SampleBank, capture_time
from ledgerloom.sources.tables import SNAPSHOT_AT, SOURCE_TABLES
from ledgerloom.sources.warehouse import Warehouse

SPACES = ("bronze", "bronze_history", "silver", "gold", "raw_vault", "business_vault")


@pytest.fixture()
def empty(spark):
    def drop():
        for space in SPACES:
            spark.sql(f"DROP DATABASE IF EXISTS {space} CASCADE")

    drop()
    yield spark
    drop()


def source_at(bank: SampleBank, number: int):
    return frame_reader({name: bank.capture(name, number) for name in SOURCE_TABLES})


def test_several_runs(empty, data):
    """Several runs leave what the builders give over the tables as a whole."""
    bank, last = SampleBank(empty, data), CAPTURES
    warehouse = Warehouse(empty, buckets=3)

    def run(number, newer_only=True):
        return run_all(
            warehouse,
            source_at(bank, number),
            capture_time(number),
            f"cap-{number}",
            newer_only,
            parallel=4,
        )

    # One run compares the whole history, the others only what is newer.
    for number in range(1, last + 1):
        assert warehouse.is_latest(capture_time(number))
        report = run(number, number != 2)
    assert not warehouse.is_latest(capture_time(last))
    # A repeated run appends nothing anywhere.
    again = run(last)
    assert set(again["captures"].values()) == {None}
    assert set(again["vault"].values()) == {0}
    assert again["current"] == report["current"]

    read = warehouse.read
    for name in SOURCE_TABLES:
        assert bag(read("bronze_history", name)) == bag(bank.history(name, last=last))
    silver = {}
    for name, (table, build) in SILVER.items():
        silver[name] = build(read("bronze", table))
        assert bag(read("silver", name)) == bag(silver[name])
    daily = gold.customer_daily_transactions(
        silver["silver_transactions"], silver["silver_customers"]
    )
    assert bag(read("gold", "gold_customer_daily_transactions")) == bag(daily)
    assert bag(read("gold", "gold_top_customer")) == bag(gold.top_customers(daily))
    assert read("gold", "gold_account_transaction_summary").count() > 0

    # A key in a hub or link keeps the time of the first run which had it.
    for name, hub in HUBS.items():
        seen = bank.history(hub.table, last=last).withColumn("_ingested_at", F.col(SNAPSHOT_AT))
        assert bag(read("raw_vault", name)) == bag(build_hub(seen, hub))
    for name, link in LINKS.items():
        seen = bank.history(link.table, last=last).withColumn("_ingested_at", F.col(SNAPSHOT_AT))
        assert bag(read("raw_vault", name)) == bag(build_link(seen, link))
    for name, satellite in SATELLITES.items():
        expected = bag(build_satellite(bank.history(satellite.table, last=last), satellite))
        assert bag(read("raw_vault", name)) == expected
    # A relationship closed by a run stays closed, as in a single pass.
    assert bag(read("raw_vault", "sts_customer_account")) == bag(
        build_status(bank.history("accounts", last=last), CUSTOMER_ACCOUNT_STATUS)
    )
    for name, pit in POINTS_IN_TIME.items():
        history = bank.history(pit.satellite.table, last=last)
        expected = build_pit(
            build_hub(history.withColumn("_ingested_at", F.col(SNAPSHOT_AT)), pit.hub),
            build_satellite(history, pit.satellite),
            capture_list(history),
            pit,
        )
        assert bag(read("business_vault", name)) == bag(expected)


def test_namespaces(spark):
    warehouse = Warehouse(spark)
    assert warehouse.name(None, "t") == "silver.t"
    assert warehouse.name(" gold ", "t") == "gold.t"
    other = Warehouse(spark, catalog="lake", default_namespace="base")
    assert (other.name(None, "t"), other.name("gold", "t")) == ("lake.base.t", "lake.gold.t")


def test_counts_of_a_load(empty, data):
    bank, warehouse = SampleBank(empty, data), Warehouse(empty)
    source = source_at(bank, 2)
    written = load_current(warehouse, source, datetime(2026, 1, 1))
    captured = load_captures(warehouse, source, "c", datetime(2026, 1, 1))
    counted = {
        r["table_name"]: r["row_count"] for r in row_counts(source, list(SOURCE_TABLES)).collect()
    }
    assert written == captured == counted
    logged = {r["table_name"]: r["row_count"] for r in warehouse.load_log().collect()}
    assert logged == counted


def test_interrupted_capture_is_replaced(empty, data):
    bank, warehouse = SampleBank(empty, data), Warehouse(empty)
    at = datetime(2026, 1, 1)
    accounts = bank.capture("accounts", 2)
    warehouse.append_capture("accounts", bank.capture("accounts", 1), "c1", at)
    # Rows under an id, but no entry in the log: the run ended between the two.
    partial = warehouse.read("bronze_history", "accounts").limit(5)
    warehouse.append(
        "bronze_history", "accounts", partial.withColumn("_snapshot_id", F.lit("c2")),
        partition_by="_snapshot_id",
    )
    assert warehouse.append_capture("accounts", accounts, "c2", at) == accounts.count()
    assert warehouse.append_capture("accounts", accounts, "c2", at) is None
    found = warehouse.read("bronze_history", "accounts").groupBy("_snapshot_id").count()
    assert {r["_snapshot_id"]: r["count"] for r in found.collect()} == {
        "c1": bank.capture("accounts", 1).count(),
        "c2": accounts.count(),
    }


def test_changed_columns_are_refused(empty):
    warehouse = Warehouse(empty)
    at = datetime(2026, 1, 1)
    source = empty.sql("select 'A1' as account_id, 1 as extra")
    warehouse.append_capture("accounts", source.drop("extra"), "c1", at)
    with pytest.raises(ValueError, match="extra"):
        warehouse.append_capture("accounts", source, "c2", at)
    with pytest.raises(ValueError, match="accounts: customer_id is missing"):
        load_captures(warehouse, frame_reader({n: source for n in SOURCE_TABLES} | {
            "customers": empty.createDataFrame([], SOURCE_TABLES["customers"].schema)
        }), "c3", at)


def test_captures_prune_to_their_partition(empty, data):
    warehouse = Warehouse(empty)
    bank = SampleBank(empty, data)
    for number in (1, 2):
        warehouse.append_capture(
            "accounts", bank.capture("accounts", number), f"c{number}", capture_time(number)
        )
    one = warehouse.read("bronze_history", "accounts").filter("_snapshot_id = 'c2'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_snapshot_id" in plan
    assert len(one.inputFiles()) < len(warehouse.read("bronze_history", "accounts").inputFiles())


def test_bucketed_target_is_read_in_place(empty, data):
    bank, warehouse = SampleBank(empty, data), Warehouse(empty, buckets=4)
    hub = HUBS["hub_transaction"]
    built = build_hub(bank.current("transactions"), hub)
    warehouse.append_new("raw_vault", hub.name, built, [hub.hash_key], hub.hash_key)
    stored = warehouse.read("raw_vault", hub.name)
    empty.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        added = new_rows(built, stored, [hub.hash_key])
        plan = added._jdf.queryExecution().executedPlan().toString()
        # One exchange to group the source, one to meet the buckets; none over the target.
        assert plan.count("Exchange hashpartitioning") == 2
        assert "Bucketed: true" in plan
        assert added.isEmpty()
    finally:
        empty.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def bank_of_accounts(spark, rows):
    """A source in which only accounts have rows."""
    frames = {name: spark.createDataFrame([], table.schema) for name, table in SOURCE_TABLES.items()}
    made = account_history(spark, rows).select(*SOURCE_TABLES["accounts"].schema.names)
    return frame_reader(frames | {"accounts": made})


def load(warehouse, source, capture_id, at):
    """The accounts alone, for tests that look at no other table."""
    rows = source("accounts").coalesce(1)
    warehouse.replace("bronze", "accounts", stamp_current(rows, at))
    return warehouse.append_capture("accounts", rows, capture_id, at)


def stored(warehouse, name):
    return warehouse.read("raw_vault", name)


def test_rows_without_log_entry_are_no_capture(empty):
    """Rows of a run that ended before it was logged close and open nothing."""
    warehouse = Warehouse(empty)
    rows = [account(f"A{i}", "x", 0) for i in range(12)]
    day = datetime(2026, 1, 1)
    run_all(warehouse, bank_of_accounts(empty, rows), day, "c1")
    before = bag(stored(warehouse, "sts_customer_account"))
    left = warehouse.read("bronze_history", "accounts").limit(3).withColumns(
        {"_snapshot_id": F.lit("c2"), "_snapshot_at": F.col("_snapshot_at") + F.expr("interval 1 day")}
    )
    warehouse.append("bronze_history", "accounts", left, partition_by="_snapshot_id")
    run_all(warehouse, bank_of_accounts(empty, rows), day + timedelta(days=2), "c3")
    assert bag(stored(warehouse, "sts_customer_account")) == before
    rebuild_satellites(warehouse)
    assert stored(warehouse, "sat_account_details").count() == 12


def only_accounts(monkeypatch):
    """Leave the vault only the models over accounts that these tests look at."""
    details = {"sat_account_details": SATELLITES["sat_account_details"]}
    monkeypatch.setattr("ledgerloom.plans.run.SATELLITES", details)
    monkeypatch.setattr("ledgerloom.plans.run.HUBS", {})
    monkeypatch.setattr("ledgerloom.plans.run.LINKS", {})


def files_read(df):
    """The files a scan of the captures opened."""
    df.collect()
    plans, found = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan = plan.executedPlan()
        if plan.getClass().getSimpleName().endswith("QueryStageExec"):
            plan = plan.plan()
        if plan.getClass().getSimpleName() == "FileSourceScanExec" and "_snapshot_at" in plan.toString():
            found += plan.metrics().apply("numFiles").value()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_a_run_reads_only_captures_it_has_not_seen(empty, monkeypatch):
    """Also of a table that never changes, and the captures are partitions to the scan."""
    only_accounts(monkeypatch)
    warehouse = Warehouse(empty)
    rows = [account(f"A{i}", "x", 0) for i in range(5)]
    for number in range(10):
        at = datetime(2026, 1, 1) + timedelta(days=number)
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", at)
        write_vault(warehouse)
    assert warehouse.progress("raw_vault", "sat_account_details") == (
        Moment(datetime(2026, 1, 10), "c9"), 10,
    )
    load(warehouse, bank_of_accounts(empty, rows), "c10", datetime(2026, 1, 11))
    seen, number = warehouse.progress("raw_vault", "sat_account_details")
    newer = warehouse.captures("accounts").filter(
        seen.before(F.col("load_dts"), F.col("snapshot_id"))
    )
    one = warehouse.history("accounts", newer)
    assert one.count() == 5
    # The list of captures is short, and prunes the partitions of the scan while it runs.
    plan = one._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    only = warehouse.read("bronze_history", "accounts").filter("_snapshot_id = 'c10'")
    assert files_read(one) == len(only.inputFiles()) == 1
    assert stored(warehouse, "sat_account_details").count() == 5
    assert write_vault(warehouse)["sat_account_details"] == 0


def test_a_late_capture_is_compared_with_all(empty, monkeypatch):
    only_accounts(monkeypatch)
    warehouse = Warehouse(empty)
    for number, status in ((1, "a"), (3, "b"), (2, "c")):
        at = datetime(2026, 1, 1) + timedelta(days=number)
        rows = [account("A1", "x", 0, status=status)]
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", at)
        write_vault(warehouse)
    found = stored(warehouse, "sat_account_details").orderBy("load_dts").collect()
    assert [r["status"] for r in found] == ["a", "c", "b"]


@pytest.mark.parametrize("order", [(1, 3, 2, 4), (2, 4, 1, 3), (3, 1, 4, 2)])
def test_late_captures_give_what_a_rebuild_gives(empty, monkeypatch, order):
    """Versions are taken back where a late capture makes them repeats, and only then is a table replaced."""
    only_accounts(monkeypatch)
    monkeypatch.setattr("ledgerloom.plans.run.build_satellite", lambda *_: 1 / 0)
    warehouse = Warehouse(empty)
    for number in order:
        # A2 changes with every capture; A1 is the same in the later two, A3 comes and goes.
        rows = [account("A1", "x", 0, status=str(number // 2)), account("A2", "x", 0, status=str(number))]
        rows += [account("A3", "x", 0)] * (number % 2)
        at = datetime(2026, 1, number)
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", at)
        write_vault(warehouse)
        history = warehouse.read("bronze_history", "accounts")
        expected = bag(build_satellite(history, SATELLITES["sat_account_details"]))
        assert bag(stored(warehouse, "sat_account_details")) == expected
    assert write_vault(warehouse)["sat_account_details"] == 0


def test_an_interrupted_write_is_not_doubled(empty, monkeypatch):
    """Rows were stored, but the run ended before the run log was written."""
    only_accounts(monkeypatch)
    warehouse = Warehouse(empty)
    for number in range(1, 4):
        rows = [account(f"A{i}", "x", 0, status=f"s{number}") for i in range(4 + number)]
        at = datetime(2026, 1, number)
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", at)
        with monkeypatch.context() as patch:
            if number == 2:
                patch.setattr(warehouse, "log_progress", lambda *_: None)
            write_vault(warehouse)
        write_vault(warehouse)
    history = warehouse.read("bronze_history", "accounts")
    assert bag(stored(warehouse, "sat_account_details")) == bag(
        build_satellite(history, SATELLITES["sat_account_details"])
    )
    assert bag(stored(warehouse, "sts_customer_account")) == bag(
        build_status(history, CUSTOMER_ACCOUNT_STATUS)
    )


def test_a_failed_load_goes_on_where_it_stopped(empty):
    warehouse = Warehouse(empty)
    at = datetime(2026, 1, 1)
    good = bank_of_accounts(empty, [account("A1", "x", 0)])

    def failing(name):
        if name == "journal_postings":
            raise OSError("no connection")
        return good(name)

    with pytest.raises(OSError):
        load_captures(warehouse, failing, "c1", at)
    logged = {r["table_name"] for r in warehouse.load_log().collect()}
    assert "accounts" in logged and "journal_postings" not in logged
    again = load_captures(warehouse, good, "c1", at)
    assert again["accounts"] is None and again["journal_postings"] == 0


def test_files_stay_few(empty):
    """Thirty runs of small appends; the rows stay as they are."""
    warehouse = Warehouse(empty, buckets=3)
    hub = HUBS["hub_account"]
    for number in range(30):
        rows = empty.range(number * 4, number * 4 + 4).select(
            F.format_string("h%d", "id").alias(hub.hash_key),
            F.format_string("A%d", "id").alias(hub.key),
            F.lit("x").alias("record_source"),
        )
        warehouse.append_new("raw_vault", hub.name, rows, [hub.hash_key], hub.hash_key)
        warehouse.log_captures([("accounts", f"c{number}", datetime(2026, 1, 1), 4)])
        warehouse.compact("raw_vault", hub.name, hub.hash_key)
        warehouse.compact("bronze_history", "load_log")
        assert len(stored(warehouse, hub.name).inputFiles()) <= 9 * 3
        assert len(warehouse.load_log().inputFiles()) <= 9
    assert stored(warehouse, hub.name).count() == 120
    assert warehouse.load_log().count() == 30
    plan = stored(warehouse, hub.name)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "Bucketed: false (disabled by query planner)" in plan


class Stopped(Exception):
    pass


def stopping(session, monkeypatch, number):
    """Let the catalog's statements fail from the ``number``-th on."""
    ask, seen = session.sql, []

    def sql(statement, *args, **kwargs):
        if statement.split()[0] in ("CREATE", "ALTER", "DROP"):
            seen.append(statement)
            if len(seen) >= number:
                raise Stopped(statement)
        return ask(statement, *args, **kwargs)

    monkeypatch.setattr(session, "sql", sql)
    return seen


@pytest.mark.parametrize("number", range(1, 5))
def test_an_interrupted_replacement_loses_nothing(empty, monkeypatch, number):
    warehouse = Warehouse(empty)
    for i in range(3):
        warehouse.replace("gold", "t", empty.range(i + 1))
    with monkeypatch.context() as patch:
        seen = stopping(empty, patch, number)
        try:
            warehouse.replace("gold", "t", empty.range(50))
        except Stopped:
            pass
    assert warehouse.read("gold", "t").count() in (3, 50)
    assert warehouse.read("gold", "t").count() == (50 if any("VIEW" in s for s in seen[: number - 1]) else 3)
    warehouse.replace("gold", "t", empty.range(7))
    assert warehouse.read("gold", "t").count() == 7
    # The present generation and the one before.
    assert empty.sql("SHOW TABLES IN gold LIKE 't__g_*'").count() == 2


def test_readers_always_find_a_table(empty):
    warehouse = Warehouse(empty, buckets=2)
    warehouse.replace("gold", "t", empty.range(10))
    warehouse.append("raw_vault", "h", empty.range(10), "id")
    found, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            found.append((warehouse.read("gold", "t").count(), warehouse.read("raw_vault", "h").count()))

    with ThreadPoolExecutor(2) as pool:
        readers = [pool.submit(read) for _ in range(2)]
        for i in range(12):
            warehouse.replace("gold", "t", empty.range(10))
            warehouse.append("raw_vault", "h", empty.range(10, 10), "id")
            assert warehouse.compact("raw_vault", "h", "id") in (True, False)
        stop.set()
        for reader in readers:
            reader.result()
    assert set(found) == {(10, 10)}


def test_a_plain_table_becomes_a_generation(empty):
    warehouse = Warehouse(empty)
    warehouse.ensure_namespace("gold")
    empty.range(4).write.saveAsTable("gold.t")
    warehouse.append("gold", "t", empty.range(4, 6))
    assert warehouse.read("gold", "t").count() == 6
    warehouse.replace("gold", "t", empty.range(3))
    assert warehouse.read("gold", "t").count() == 3


def test_rebuild_takes_late_versions_back(empty):
    warehouse = Warehouse(empty)
    history = account_history(
        empty, [account("A1", f"s{i}", i, status=s) for i, s in enumerate("ABB")]
    )
    empty.sql("CREATE NAMESPACE IF NOT EXISTS bronze_history")
    for name, table in SOURCE_TABLES.items():
        rows = history if name == "accounts" else (
            empty.createDataFrame([], table.schema).selectExpr(
                "*", "'x' as _source_system", "'s0' as _snapshot_id",
                "timestamp_ntz'2026-01-01' as _snapshot_at",
            )
        )
        rows.write.saveAsTable(f"bronze_history.{name}")
    times = [datetime(2026, 1, 1) + timedelta(days=i) for i in range(3)]
    warehouse.log_captures([("accounts", f"s{i}", at, 1) for i, at in enumerate(times)])
    assert rebuild_satellites(warehouse)["sat_account_details"] == 2
    assert warehouse.read("raw_vault", "sat_account_details").count() == 2


def test_past_changes_are_read_once(empty, monkeypatch):
    """A relationship that comes and goes leaves rows; runs after the first look at its state alone."""
    only_accounts(monkeypatch)
    warehouse = Warehouse(empty)
    asked = []
    whole = status_state

    def counted(rows, status):
        asked.append(status.name)
        return whole(rows, status)

    monkeypatch.setattr("ledgerloom.plans.run.status_state", counted)
    for number in range(1, 9):
        rows = [account("A1", "x", 0), *([account("A2", "x", 0)] if number % 2 else [])]
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", datetime(2026, 1, number))
        if number == 6:
            # An interrupted run stored its rows and no state; the next one makes up for it.
            with monkeypatch.context() as patch:
                patch.setattr(warehouse, "replace", lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    write_vault(warehouse)
        write_vault(warehouse)
    assert asked == ["sts_customer_account"]
    found = stored(warehouse, "sts_customer_account")
    assert bag(found) == bag(build_status(warehouse.read("bronze_history", "accounts"), CUSTOMER_ACCOUNT_STATUS))
    state = stored(warehouse, "sts_customer_account_state")
    assert state.count() == 2 and found.count() == 9
    assert bag(state.drop("state_dts", "state_id")) == bag(status_state(found, CUSTOMER_ACCOUNT_STATUS))


def test_pointers_follow_captures_that_come_late_or_go(empty, monkeypatch):
    only_accounts(monkeypatch)
    hub, pit = HUBS["hub_account"], POINTS_IN_TIME["pit_account"]
    monkeypatch.setattr("ledgerloom.plans.run.HUBS", {hub.name: hub})
    monkeypatch.setattr("ledgerloom.plans.run.POINTS_IN_TIME", {pit.name: pit})
    warehouse = Warehouse(empty)

    def expected():
        return bag(
            build_pit_pruned(
                stored(warehouse, hub.name), stored(warehouse, "sat_account_details"),
                warehouse.captures("accounts"), pit,
            )
        )

    written = []
    for number in (1, 2, 4, 3, 5):
        rows = [account(f"A{i}", "x", 0, status=f"s{number * (i % 2)}") for i in range(4 + number % 3)]
        load(warehouse, bank_of_accounts(empty, rows), f"c{number}", datetime(2026, 1, number))
        write_vault(warehouse)
        written.append(write_business_vault(warehouse)[pit.name])
        assert bag(warehouse.read("business_vault", pit.name)) == expected()
    # Only what is new, except after the capture that came late.
    total = warehouse.read("business_vault", pit.name).count()
    assert written[1] < total and written[2] < total and written[4] < total
    assert write_business_vault(warehouse)[pit.name] == 0
    log = warehouse.load_log().filter("snapshot_id <> 'c2'")
    warehouse.replace("bronze_history", "load_log", log)
    write_business_vault(warehouse)
    assert bag(warehouse.read("business_vault", pit.name)) == expected()


def test_files_as_source(spark, tmp_path):
    frame = account_history(spark, [account("A1", "s0", 0)])
    for kind in ("parquet", "orc"):
        frame.drop("_snapshot_at").write.format(kind).save(str(tmp_path / kind / "accounts"))
        read = file_reader(spark, str(tmp_path / kind), kind)("accounts")
        assert read.count() == 1
    assert capture_time(2) - capture_time(1) == timedelta(days=1)
