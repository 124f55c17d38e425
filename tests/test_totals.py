"""Kept totals: always what the whole table gives, made again only where rows have changed."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import bag, kept as stored
from pyspark.sql import functions as F
from test_gold import TRANSACTION, frames
from test_warehouse import empty  # noqa: F401

from ledgerloom.operators.totals import MARK, TOTAL, day_marks, next_totals, of_days, touched_days
from ledgerloom.plans import gold
from ledgerloom.plans.run import refresh_totals
from ledgerloom.sources.warehouse import Warehouse

BOTH = [gold.ACCOUNT_DAYS, gold.CUSTOMER_DAYS]
FIRST = date(2026, 9, 1)


def random_rows(rng: random.Random, number: int = 300):
    def one(i):
        pick = rng.choice
        day = None if rng.random() < 0.1 else FIRST + timedelta(days=rng.randrange(12))
        amount = None if rng.random() < 0.1 else f"{rng.randrange(-500, 500)}.25"
        # A third of all rows has one account, customer and day.
        if rng.random() < 0.33:
            return (f"T{i}", "C0", "A0", "1", amount, "EUR", FIRST)
        return (f"T{i}", pick([None, "C1", "C2"]), pick([None, "A1", "A2"]), pick([None, "1", "2"]), amount, pick(["EUR", None]), day)

    return [one(i) for i in range(number)]


def corrected(rng: random.Random, rows):
    """Some amounts, days and keys changed, some rows gone, some repeated, a day without rows."""
    found = []
    for row in rows:
        if row[6] == FIRST + timedelta(days=3) or rng.random() < 0.02:
            continue
        if rng.random() < 0.02:
            row = (*row[:4], "9.99", row[5], row[6])
        if rng.random() < 0.02:
            row = (*row[:6], FIRST + timedelta(days=20))
        found += [row] * (2 if rng.random() < 0.02 else 1)
    return found


def reports(accounts, customers, transactions, ledger, kept):
    return [
        (
            gold.account_summary_of_days(accounts, customers, kept[0], transactions, ledger),
            gold.account_transaction_summary(accounts, customers, transactions, ledger),
        ),
        (
            gold.customer_daily_of_days(kept[1], customers),
            gold.customer_daily_transactions(transactions, customers),
        ),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_same_as_the_whole(spark, seed):
    rng = random.Random(seed)
    accounts = [("A0", "C0", "EUR"), ("A1", "C1", "EUR"), ("A2", None, None), ("A3", "C2", "EUR")]
    customers = [("C0", "Hot", None), ("C1", "Ann", "Bo"), ("C1", "An", "Other")]
    rows, kept = random_rows(rng), [None, None]
    for _ in range(2):
        a, c, transactions, g = frames(spark, rows, accounts, customers, [("1", "L"), ("2", "M")])
        kept = [
            stored(next_totals(transactions, k, t, stored(touched_days(transactions, k, t))))
            for k, t in zip(kept, BOTH)
        ]
        for found, expected in reports(a, c, transactions, g, kept):
            assert bag(found) == bag(expected)
        rows = corrected(rng, rows)


def table(spark, rows):
    return frames(spark, rows, [("A1", "C1", "EUR")])[2]


def row(number, amount="1.00", day=FIRST, customer="C1"):
    return (f"T{number}", customer, "A1", "1", amount, "EUR", day)


def test_other_days_are_taken_over(spark):
    """A total that was falsified stays while its day is as it was, and is mended once it changes."""
    totals, later = gold.CUSTOMER_DAYS, FIRST + timedelta(days=1)
    rows = [row(1), row(2, day=later)]
    now = table(spark, rows)
    kept = next_totals(now, None, totals, touched_days(now, None, totals))
    false = stored(kept.withColumn(TOTAL, F.lit(Decimal("77")).cast("decimal(28,2)")))
    now = table(spark, [*rows, row(3, day=later)])
    days = touched_days(now, false, totals)
    assert [r["booking_date"] for r in days.collect()] == [later]
    found = next_totals(now, false, totals, days)
    assert {(r["booking_date"], str(r[TOTAL])) for r in found.collect()} == {(FIRST, "77.00"), (later, "2.00")}


def test_marks(spark):
    """Order does not matter; number, values and the place of a null do."""
    totals = gold.CUSTOMER_DAYS

    def mark(*rows):
        return [r[MARK] for r in day_marks(table(spark, list(rows)), totals).collect()]

    a, b = row(1, "1.00"), row(2, "2.00")
    assert mark(a, b) == mark(b, a)
    assert mark(a, b) != mark(a, b, b)
    assert mark(a, a) != mark(b, b)
    assert mark(row(1, None)) != mark(row(1, "0.00"))
    whole = [("T1", "C1", "A1", "1", None, "EUR", FIRST)], [("T1", "C1", "A1", "1", None, None, FIRST)]
    assert mark(*whole[0]) != mark(*whole[1])
    assert mark() == mark(row(1, customer=None)) == mark(row(1, day=None)) == []


def test_empty_tables(spark):
    totals = gold.CUSTOMER_DAYS
    none = spark.createDataFrame([], TRANSACTION)
    kept = next_totals(none, None, totals, touched_days(none, None, totals))
    assert kept.count() == 0
    some = table(spark, [row(1)])
    kept = stored(next_totals(some, kept, totals, touched_days(some, kept, totals)))
    assert kept.count() == 1
    # All rows go again.
    assert next_totals(none, kept, totals, touched_days(none, kept, totals)).count() == 0


def test_rows_of_other_days_are_not_read(spark, tmp_path):
    """Outside the first and last day touched the scan leaves partitions out, of those between the join."""
    totals = gold.CUSTOMER_DAYS
    rows = [row(i, day=FIRST + timedelta(days=i % 10)) for i in range(100)]
    table(spark, rows).write.partitionBy("booking_date").parquet(str(tmp_path / "rows"))
    now = spark.read.parquet(str(tmp_path / "rows"))
    days = [(FIRST + timedelta(days=d), "x") for d in (6, 8)]
    spark.createDataFrame(days, f"booking_date date, {MARK} string").write.parquet(str(tmp_path / "days"))
    listed = spark.read.parquet(str(tmp_path / "days"))
    found = of_days(now, totals, listed)
    assert found.count() == 20
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString() and "Exchange hash" not in plan.toString()
    scans = [line for line in plan.toString().split("\n") if "FileScan" in line and "currency" in line]
    # Once in the final plan, once in the first one.
    assert len(scans) == 2 and all("subquery" in scan.split("PartitionFilters")[1].lower() for scan in scans)


def test_interrupted_and_going_back(empty, monkeypatch):  # noqa: F811
    """A run that stops before its totals are stored leaves the old ones with their marks; a copy that
    goes back to what it was then is told from them."""
    warehouse, totals = Warehouse(empty), gold.CUSTOMER_DAYS
    one, two = table(empty, [row(1)]), table(empty, [row(1, "5.00")])
    first = bag(refresh_totals(warehouse, one, totals))
    replace = Warehouse.replace

    def stop(self, namespace, name, df):
        if name == totals.name:
            raise KeyboardInterrupt
        return replace(self, namespace, name, df)

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(Warehouse, "replace", stop)
        refresh_totals(warehouse, two, totals)
    assert bag(refresh_totals(warehouse, one, totals)) == first
    assert [str(r[TOTAL]) for r in refresh_totals(warehouse, two, totals).collect()] == ["5.00"]
    # Nothing touched: the totals are not written again.
    seen = []
    monkeypatch.setattr(Warehouse, "replace", lambda self, n, name, df: seen.append(name) or replace(self, n, name, df))
    refresh_totals(warehouse, two, totals)
    assert seen == [f"{totals.name}_touched"]
    refresh_totals(warehouse, two, totals, newer_only=False)
    assert totals.name in seen
