"""The captures of a table: what the load log says was stored, a row per run of the loader."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.stamping import wall_clock
from ledgerloom.sources.tables import SNAPSHOT_AT, SNAPSHOT_ID, SOURCE_COLUMN


@dataclass(frozen=True)
class Moment:
    """A capture as a point in the order of captures: by time, then by id."""

    load_dts: datetime
    snapshot_id: str

    @property
    def at_literal(self) -> Column:
        return wall_clock(self.load_dts)

    def before(self, at: Column, snapshot_id: Column) -> Column:
        """Whether the given capture comes after this one."""
        return (at > self.at_literal) | (
            (at == self.at_literal) & (snapshot_id > F.lit(self.snapshot_id))
        )


def logged_captures(log: DataFrame, table: str, with_empty: bool = False) -> DataFrame:
    """The captures of a table which the load log has: snapshot_id, load_dts.

    A capture counts once it is logged, whatever rows the history holds. One without rows leaves no
    trace in the history, so by default it is no observation either.
    """
    entries = log.filter(F.col("table_name") == table)
    if not with_empty:
        entries = entries.filter(F.col("row_count") > 0)
    return entries.select("snapshot_id", F.col("snapshot_at").alias("load_dts")).distinct()


def capture_list(history: DataFrame, per_source: bool = False) -> DataFrame:
    """Distinct captures found in a history that has no log: snapshot_id, load_dts (and record_source)."""
    source = [F.col(SOURCE_COLUMN).alias("record_source")] if per_source else []
    return history.select(
        F.col(SNAPSHOT_ID).alias("snapshot_id"), F.col(SNAPSHOT_AT).alias("load_dts"), *source
    ).distinct()


def of_captures(history: DataFrame, captures: DataFrame) -> DataFrame:
    """Rows of the captures listed. The history is partitioned by capture, so a short list prunes."""
    listed = captures.select(F.col("snapshot_id").alias(SNAPSHOT_ID)).distinct()
    return history.join(listed, SNAPSHOT_ID, "left_semi")
