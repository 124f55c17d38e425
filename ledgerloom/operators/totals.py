"""Totals per day that are kept, and made again only for days whose rows have changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.keyed import with_values

COUNT, TOTAL, MARK = "row_count", "total", "day_mark"
TOTAL_TYPE = "decimal(28,2)"


@dataclass(frozen=True)
class DayTotals:
    """Count and total of ``amount`` per ``keys`` and day; rows without a value in ``needed`` are left out."""

    name: str
    keys: tuple[str, ...]
    day: str
    amount: str
    needed: tuple[str, ...] = ()

    def rows(self, rows: DataFrame) -> DataFrame:
        """What the totals look at: the rows with a day, and of these four or so columns."""
        columns = dict.fromkeys([*self.keys, self.day, self.amount])
        return with_values(rows, [*self.needed, self.day]).select(*columns)


def day_marks(rows: DataFrame, totals: DayTotals) -> DataFrame:
    """Per day a mark of its rows, whatever their order: their number and the sum of their hashes.

    Each task combines a day's rows before the exchange, so a day with a third of all rows crosses it as
    one row per task. Two sets of rows have the same mark by a chance of one in 2^64.
    """
    seen = totals.rows(rows)
    # A null leaves a hash as it was, so which columns are null is hashed as well.
    whole = F.xxhash64(*seen.columns, *[F.col(name).isNull() for name in seen.columns])
    marks = seen.groupBy(totals.day).agg(
        F.count(F.lit(1)).alias("n"), F.sum(whole.cast("decimal(20,0)")).alias("hashes")
    )
    return marks.select(totals.day, F.concat_ws(":", "n", "hashes").alias(MARK))


def touched_days(rows: DataFrame, kept: DataFrame | None, totals: DayTotals) -> DataFrame:
    """Days whose rows are not those the kept totals were made from, with their mark now (null: no rows)."""
    now = day_marks(rows, totals)
    if kept is None:
        return now
    before = kept.select(totals.day, F.col(MARK).alias("_before")).distinct()
    both = now.join(before, totals.day, "full")
    return both.filter(~F.col(MARK).eqNullSafe(F.col("_before"))).select(totals.day, MARK)


def of_days(rows: DataFrame, totals: DayTotals, days: DataFrame) -> DataFrame:
    """The rows of the days listed, of which there is at least one or no row is read.

    The first and last of them are known before the scan begins, which leaves out partitions, or parts of
    files, that lie outside. A list of days is no longer than the calendar, so as a table it is small enough
    for Spark to send it to the scan, and rows of the days between do not reach an exchange.
    """
    day = F.col(totals.day)
    first, last = (days.select(end(totals.day)).scalar() for end in (F.min, F.max))
    between = totals.rows(rows).filter((day >= first) & (day <= last))
    return between.join(days.select(totals.day), totals.day, "left_semi")


def next_totals(rows: DataFrame, kept: DataFrame | None, totals: DayTotals, days: DataFrame) -> DataFrame:
    """The kept totals with those of the days listed made again, each with the mark its day has in the list.

    Other days' totals are taken over as they are, without an exchange; days that have no rows any more
    are gone. Without kept totals the list has every day.
    """
    changed = totals.rows(rows) if kept is None else of_days(rows, totals, days)
    fresh = (
        changed.groupBy(*totals.keys, totals.day)
        .agg(F.count(F.lit(1)).alias(COUNT), F.sum(totals.amount).cast(TOTAL_TYPE).alias(TOTAL))
        .join(days, totals.day)
        .select(*totals.keys, totals.day, COUNT, TOTAL, MARK)
    )
    if kept is None:
        return fresh
    stay = kept.join(days.select(totals.day), totals.day, "left_anti")
    return stay.select(*fresh.columns).unionByName(fresh)
