"""Metadata columns of a load. Ids and times are arguments, so that a run can be repeated."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import SEPARATOR
from ledgerloom.sources.tables import (
    INGESTED_AT,
    SNAPSHOT_AT,
    SNAPSHOT_ID,
    SOURCE_COLUMN,
    SOURCE_SYSTEM,
)


def utc_now() -> datetime:
    """UTC wall clock without zone, to the microsecond."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_capture_id() -> str:
    return str(uuid4())


def wall_clock(moment: datetime) -> Column:
    """Literal UTC wall-clock time, independent of the session zone."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _source(system: str) -> Column:
    # Grouping by (source, key) equals grouping by their joined hash only without this character.
    if SEPARATOR in system:
        raise ValueError(f"source system name must not contain {SEPARATOR!r}: {system!r}")
    return F.lit(system)


def stamp_current(df: DataFrame, ingested_at: datetime, system: str = SOURCE_SYSTEM) -> DataFrame:
    """Add source system and load time to a current copy."""
    return df.withColumns({SOURCE_COLUMN: _source(system), INGESTED_AT: wall_clock(ingested_at)})


def stamp_capture(
    df: DataFrame, capture_id: str, captured_at: datetime, system: str = SOURCE_SYSTEM
) -> DataFrame:
    """Add source system, capture id and capture time to one full capture."""
    return df.withColumns(
        {
            SOURCE_COLUMN: _source(system),
            SNAPSHOT_ID: F.lit(capture_id),
            SNAPSHOT_AT: wall_clock(captured_at),
        }
    )
