"""Every query by name: functions of a session and a directory of input tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import entity_key
from ledgerloom.operators.captures import Moment, capture_list, logged_captures, of_captures
from ledgerloom.operators.keyed import build_hub, build_link, link_increment, new_rows
from ledgerloom.operators.point_in_time import (
    as_of,
    as_of_join,
    build_pit,
    build_pit_pruned,
    pit_increment,
)
from ledgerloom.operators.satellite import build_satellite, satellite_increment
from ledgerloom.operators.specs import Hub, Link, PointInTime, Satellite
from ledgerloom.operators.status import build_status, next_state, status_increment, status_state
from ledgerloom.operators.totals import DayTotals, next_totals, touched_days
from ledgerloom.plans import gold
from ledgerloom.plans.models import (
    CUSTOMER_ACCOUNT_STATUS,
    HUBS,
    LINKS,
    POINTS_IN_TIME,
    SATELLITES,
)
from ledgerloom.plans.silver import SILVER
from ledgerloom.sources.readers import row_counts
from ledgerloom.sources.sample import CAPTURES, SampleBank, capture_time
from ledgerloom.sources.stamping import wall_clock
from ledgerloom.sources.tables import SNAPSHOT_AT, SNAPSHOT_ID, SOURCE_COLUMN, SOURCE_TABLES

Query = Callable[[SparkSession, str], DataFrame]

# Moment of the registered lookups: between the third and the fourth capture.
LOOKUP_AT = datetime(2026, 9, 29, 12, 0)
# The stored part of the two-step queries ends with this capture.
STORED_CAPTURES = 2
# Captures that the point-in-time tables in range form no longer have.
REMOVED_CAPTURES = ["cap-1", "cap-3"]


def all_queries() -> dict[str, Query]:
    found: dict[str, Callable[[SampleBank], DataFrame]] = {
        "source_row_counts": _source_row_counts,
        "load_audit": _load_audit,
        "capture_append_idempotent": _capture_append_idempotent,
    }
    for table in SOURCE_TABLES:
        found[f"bronze_{table}"] = lambda bank, t=table: bank.current(t)
        found[f"capture_{table}"] = lambda bank, t=table: bank.history(t)
    for name in SILVER:
        found[name] = lambda bank, n=name: _silver(bank, n)
    found["gold_account_transaction_summary"] = _gold_summary
    found["gold_customer_daily_transactions"] = _gold_daily
    found["gold_top_customer"] = lambda bank: gold.top_customers(_gold_daily(bank))
    found["gold_account_transaction_summary_by_change"] = _gold_summary_by_change
    found["gold_customer_daily_transactions_by_change"] = _gold_daily_by_change
    for name, hub in HUBS.items():
        found[name] = lambda bank, h=hub: build_hub(bank.current(h.table), h)
        found[f"{name}_incremental"] = lambda bank, h=hub: _hub_in_two_steps(bank, h)
    for name, link in LINKS.items():
        found[name] = lambda bank, l=link: build_link(_link_rows(bank, l), l)
        found[f"{name}_incremental"] = lambda bank, l=link: _link_in_two_steps(bank, l)
    for name, satellite in SATELLITES.items():
        found[name] = lambda bank, s=satellite: build_satellite(bank.history(s.table), s)
        found[f"{name}_incremental"] = lambda bank, s=satellite: _satellite_in_two_steps(bank, s)
        found[f"{name}_newer_captures"] = lambda bank, s=satellite: _satellite_in_two_steps(
            bank, s, newer_only=True
        )
    found["sts_customer_account"] = lambda bank: _status(bank, bank.history("accounts"))
    found["sts_customer_account_unlogged_capture"] = _status_beside_unlogged_rows
    found["sat_journal_posting_amount_crowded"] = _crowded_satellite
    found["sts_customer_account_incremental"] = _status_in_two_steps
    found["sts_customer_account_newer_captures"] = lambda bank: _status_in_two_steps(bank, True)
    for name, pit in POINTS_IN_TIME.items():
        found[name] = lambda bank, p=pit: _pit(bank, p)
        found[f"{name}_range_form"] = lambda bank, p=pit: _pit_of_remaining(bank, p)
        subject = name.removeprefix("pit_")
        found[f"{subject}_as_of"] = lambda bank, p=pit: _as_of(bank, p)
        found[f"{name}_incremental"] = lambda bank, p=pit: _pit_in_two_steps(bank, p)
    found["transactions_as_of"] = _transactions_as_of
    found["sts_customer_account_kept_state"] = _kept_state
    return {
        name: lambda spark, directory, b=build: b(SampleBank(spark, directory))
        for name, build in found.items()
    }


def _source_row_counts(bank: SampleBank) -> DataFrame:
    return row_counts(bank.table, list(SOURCE_TABLES))


def _load_audit(bank: SampleBank) -> DataFrame:
    """Rows each load stored: per current table, and per table and capture."""
    count = F.count(F.lit(1)).alias("row_count")
    parts = []
    for table in SOURCE_TABLES:
        parts.append(
            bank.current(table)
            .agg(count)
            .select(
                F.lit("bronze").alias("layer"),
                F.lit(table).alias("table_name"),
                F.lit(None).cast("string").alias("snapshot_id"),
                "row_count",
            )
        )
        parts.append(
            bank.history(table)
            .groupBy(F.col(SNAPSHOT_ID).alias("snapshot_id"))
            .agg(count)
            .select(
                F.lit("bronze_history").alias("layer"),
                F.lit(table).alias("table_name"),
                "snapshot_id",
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _capture_append_idempotent(bank: SampleBank) -> DataFrame:
    """Stored captures 1 to 3, then a repeated load which offers 2 to 4: only 4 is added."""
    stored = bank.history("accounts", last=3)
    offered = bank.history("accounts", first=2)
    loaded = capture_list(stored).select(F.col("snapshot_id").alias(SNAPSHOT_ID))
    return stored.unionByName(new_rows(offered, loaded, [SNAPSHOT_ID]))


def _silver(bank: SampleBank, name: str) -> DataFrame:
    table, build = SILVER[name]
    return build(bank.current(table))


def _gold_summary(bank: SampleBank) -> DataFrame:
    return gold.account_transaction_summary(
        _silver(bank, "silver_accounts"),
        _silver(bank, "silver_customers"),
        _silver(bank, "silver_transactions"),
        _silver(bank, "silver_gl_accounts"),
    )


def _gold_daily(bank: SampleBank) -> DataFrame:
    return gold.customer_daily_transactions(
        _silver(bank, "silver_transactions"), _silver(bank, "silver_customers")
    )


def _kept_totals(bank: SampleBank, totals: DayTotals) -> DataFrame:
    """Totals kept from a copy before corrections, brought up to the present one.

    Before, amounts of each January were others, half of each February's transactions had yet to come,
    and each March had some that are gone.
    """
    now = _silver(bank, "silver_transactions")
    month, number = F.month(totals.day), F.substring("transaction_id", 2, 20).cast("long")
    before = now.filter(~((month == 2) & (number % 2 == 0)) | F.col(totals.day).isNull()).withColumn(
        totals.amount, F.when(month == 1, F.col(totals.amount) + 1).otherwise(F.col(totals.amount)).cast(gold.AMOUNT)
    )
    gone = now.filter(F.month(totals.day) == 3).filter(number % 3 == 0)
    before = before.unionByName(gone.withColumn("transaction_id", F.concat("transaction_id", F.lit("-gone"))))
    kept = next_totals(before, None, totals, touched_days(before, None, totals))
    return next_totals(now, kept, totals, touched_days(now, kept, totals))


def _gold_summary_by_change(bank: SampleBank) -> DataFrame:
    return gold.account_summary_of_days(
        _silver(bank, "silver_accounts"),
        _silver(bank, "silver_customers"),
        _kept_totals(bank, gold.ACCOUNT_DAYS),
        _silver(bank, "silver_transactions"),
        _silver(bank, "silver_gl_accounts"),
    )


def _gold_daily_by_change(bank: SampleBank) -> DataFrame:
    return gold.customer_daily_of_days(_kept_totals(bank, gold.CUSTOMER_DAYS), _silver(bank, "silver_customers"))


def _hub_in_two_steps(bank: SampleBank, hub: Hub) -> DataFrame:
    stored = build_hub(bank.earlier_current(hub.table), hub)
    built = build_hub(bank.current(hub.table), hub)
    return stored.unionByName(new_rows(built, stored, [hub.hash_key]))


def _link_rows(bank: SampleBank, link: Link, earlier: bool = False) -> DataFrame:
    if link.seen_at == SNAPSHOT_AT:
        return bank.history(link.table, last=STORED_CAPTURES) if earlier else bank.history(
            link.table
        )
    return bank.earlier_current(link.table) if earlier else bank.current(link.table)


def _link_in_two_steps(bank: SampleBank, link: Link) -> DataFrame:
    stored = build_link(_link_rows(bank, link, earlier=True), link)
    return stored.unionByName(link_increment(_link_rows(bank, link), stored, link))


def _newer(bank: SampleBank, table: str, newer_only: bool) -> tuple[DataFrame, Moment | None]:
    """The captures a stored model has yet to see, and the last it has; or all, and None."""
    if not newer_only:
        return bank.history(table), None
    last = Moment(capture_time(STORED_CAPTURES), f"cap-{STORED_CAPTURES}")
    return bank.history(table, first=STORED_CAPTURES + 1), last


def _satellite_in_two_steps(
    bank: SampleBank, satellite: Satellite, newer_only: bool = False
) -> DataFrame:
    stored = build_satellite(bank.history(satellite.table, last=STORED_CAPTURES), satellite)
    history, last = _newer(bank, satellite.table, newer_only)
    return stored.unionByName(satellite_increment(history, stored, satellite, last))


def _crowded_satellite(bank: SampleBank) -> DataFrame:
    """Postings a third of which are versions of one, in every capture."""
    crowd = F.col("journal_entry_id").substr(2, 20).cast("long") % 3 == 0
    same = {"posting_id": "P0-D", "journal_entry_id": "J0", "gl_account_code": "1000"}
    rows = bank.history("journal_postings").withColumn("_crowd", crowd)
    rows = rows.withColumns(
        {name: F.when(F.col("_crowd"), value).otherwise(F.col(name)) for name, value in same.items()}
    )
    return build_satellite(rows.drop("_crowd"), SATELLITES["sat_journal_posting_amount"])


def _status(bank: SampleBank, history: DataFrame) -> DataFrame:
    return build_status(history, CUSTOMER_ACCOUNT_STATUS)


def _status_in_two_steps(bank: SampleBank, newer_only: bool = False) -> DataFrame:
    stored = _status(bank, bank.history("accounts", last=STORED_CAPTURES))
    history, last = _newer(bank, "accounts", newer_only)
    captures = logged_captures(bank.load_log(), "accounts")
    return stored.unionByName(
        status_increment(history, stored, CUSTOMER_ACCOUNT_STATUS, captures, last)
    )


def _kept_state(bank: SampleBank) -> DataFrame:
    """What every relationship is after all captures, carried on from one to the next."""
    status = CUSTOMER_ACCOUNT_STATUS
    captures = logged_captures(bank.load_log(), "accounts")
    stored = _status(bank, bank.history("accounts", last=1))
    state = status_state(stored, status)
    for number in range(2, CAPTURES + 1):
        last = Moment(capture_time(number - 1), f"cap-{number - 1}")
        until = captures.filter(F.col("load_dts") <= wall_clock(capture_time(number)))
        one = bank.history("accounts", first=number, last=number)
        # Nothing but the state is read of what is stored.
        changes = status_increment(one, stored.limit(0), status, until, last, state)
        state = next_state(state, changes, status)
    return state


def _status_beside_unlogged_rows(bank: SampleBank) -> DataFrame:
    """A history that also holds rows of a run which ended before it was logged."""
    partial = bank.history("accounts", first=CAPTURES).filter(F.col("account_id").endswith("1"))
    partial = partial.withColumns(
        {
            SNAPSHOT_ID: F.concat(F.col(SNAPSHOT_ID), F.lit("-unlogged")),
            SNAPSHOT_AT: F.col(SNAPSHOT_AT) + F.expr("interval 1 day"),
        }
    )
    captures = logged_captures(bank.load_log(), "accounts")
    history = of_captures(bank.history("accounts").unionByName(partial), captures)
    return build_status(history, CUSTOMER_ACCOUNT_STATUS, captures)


def _pit(bank: SampleBank, pit: PointInTime) -> DataFrame:
    return _pit_over(bank, pit, _pit_satellite(bank, pit))


def _as_of(bank: SampleBank, pit: PointInTime) -> DataFrame:
    satellite = _pit_satellite(bank, pit)
    return as_of(_pit_over(bank, pit, satellite), satellite, LOOKUP_AT, pit)


def _pit_in_two_steps(bank: SampleBank, pit: PointInTime) -> DataFrame:
    """Pointers after some captures, with the hub of the day before, and then those of the other ones."""
    table, last = pit.satellite.table, Moment(capture_time(STORED_CAPTURES), f"cap-{STORED_CAPTURES}")
    captures = logged_captures(bank.load_log(), table)
    satellite = _pit_satellite(bank, pit)
    earlier = bank.history(table, last=STORED_CAPTURES)
    stored = build_pit(
        build_hub(bank.earlier_current(table), pit.hub),
        build_satellite(earlier, pit.satellite),
        capture_list(earlier),
        pit,
    )
    hub = build_hub(bank.current(table), pit.hub)
    return stored.unionByName(pit_increment(hub, satellite, captures, stored, pit, last))


def _transactions_as_of(bank: SampleBank) -> DataFrame:
    """Every transaction with the state of its account at a moment of the transaction's own.

    The sample's transactions are years older than its captures, so their moments are dealt out over
    the days of these, one per hour.
    """
    pit = POINTS_IN_TIME["pit_account"]
    hour = F.substring("transaction_id", 2, 20).cast("long") % (24 * (CAPTURES + 1))
    facts = bank.current("transactions").select(
        "transaction_id",
        "account_id",
        entity_key(F.col(SOURCE_COLUMN), F.trim("account_id")).alias(pit.hub.hash_key),
        (wall_clock(capture_time(0)) + F.make_dt_interval(F.lit(0), hour.cast("int"))).alias("asked_at"),
    )
    satellite = _pit_satellite(bank, pit)
    found = as_of_join(facts, _pit_over(bank, pit, satellite), satellite, pit, "asked_at")
    names = [*pit.satellite.attribute_names, "snapshot_id", "snapshot_at", pit.pointer]
    return found.select(
        "transaction_id",
        "account_id",
        "asked_at",
        *[F.col(f"{pit.satellite.name}.{name}").alias(name) for name in names],
    )


def _pit_of_remaining(bank: SampleBank, pit: PointInTime) -> DataFrame:
    captures = capture_list(bank.history(pit.satellite.table))
    return build_pit_pruned(
        build_hub(bank.current(pit.satellite.table), pit.hub),
        _pit_satellite(bank, pit),
        captures.filter(~F.col("snapshot_id").isin(REMOVED_CAPTURES)),
        pit,
    )


def _pit_satellite(bank: SampleBank, pit: PointInTime) -> DataFrame:
    return build_satellite(bank.history(pit.satellite.table), pit.satellite)


def _pit_over(bank: SampleBank, pit: PointInTime, satellite: DataFrame) -> DataFrame:
    table = pit.satellite.table
    return build_pit(
        build_hub(bank.current(table), pit.hub),
        satellite,
        capture_list(bank.history(table)),
        pit,
    )
