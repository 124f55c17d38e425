"""Point-in-time tables and the lookup through them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment
from ledgerloom.operators.specs import PointInTime
from ledgerloom.sources.stamping import wall_clock


def build_pit(
    hub: DataFrame, satellite: DataFrame, captures: DataFrame, spec: PointInTime
) -> DataFrame:
    """Per hub key, the captures at which the valid satellite version changes.

    A version starts at the time of a capture, so the valid version can only change there: each
    distinct version time of a key is one row, and no key is expanded over the captures. Every
    version time must still be in ``captures``; otherwise use ``build_pit_pruned``.
    """
    pointers = _version_times(satellite, spec).join(
        _first_per_instant(captures), F.col("load_dts") == F.col("snapshot_at")
    )
    return _with_hub(hub, pointers, spec)


def build_pit_pruned(
    hub: DataFrame, satellite: DataFrame, captures: DataFrame, spec: PointInTime
) -> DataFrame:
    """The same for a capture list from which old captures may have been removed.

    A version counts from the first remaining capture at or after it; of several versions that meet
    at one capture the latest is valid. The range condition is settled between the two short lists
    of distinct times, and the keys join on equality.
    """
    return _with_hub(hub, _pointers(_version_times(satellite, spec), captures, spec), spec)


def _pointers(times: DataFrame, captures: DataFrame, spec: PointInTime) -> DataFrame:
    """Version times of keys with the capture each of them counts from."""
    # From the last time back to the first, so that the minimum runs along instead of being taken
    # anew for every row.
    from_here = Window.orderBy(F.desc("_at")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # One row per distinct time: as long as the list of runs, whatever the size of the satellite.
    starts = (
        times.select("load_dts")
        .distinct()
        .select(F.col("load_dts").alias("_at"), "load_dts", F.lit(None).alias("_capture"))
        .unionByName(
            captures.select(
                F.col("load_dts").alias("_at"),
                F.lit(None).alias("load_dts"),
                F.col("load_dts").alias("_capture"),
            ).distinct()
        )
        .withColumn("snapshot_at", F.min("_capture").over(from_here))
        .filter(F.col("load_dts").isNotNull() & F.col("snapshot_at").isNotNull())
        .select("load_dts", "snapshot_at")
        .join(_first_per_instant(captures), "snapshot_at")
    )
    return (
        times.join(starts, "load_dts")
        .groupBy(spec.hub.hash_key, "snapshot_id", "snapshot_at")
        .agg(F.max("load_dts").alias("load_dts"))
    )


def as_of(
    pit: DataFrame, satellite: DataFrame, moment: datetime, spec: PointInTime
) -> DataFrame:
    """The state of every key at a moment: its latest pointer up to then, and that version.

    Several versions of one key can share a time; the one with the greatest capture id is taken.
    """
    key, attributes = spec.hub.hash_key, spec.satellite.attribute_names
    at = wall_clock(moment)
    pointer = F.struct("snapshot_at", "snapshot_id", spec.pointer)
    latest = (
        pit.filter(F.col("snapshot_at") <= at)
        .groupBy(key, spec.hub.key)
        .agg(F.max(pointer).alias("_pointer"))
        .select(key, spec.hub.key, "_pointer.*")
        .withColumnRenamed(spec.pointer, "load_dts")
    )
    versions = satellite.filter(F.col("load_dts") <= at).select(
        key, "load_dts", F.col("snapshot_id").alias("_version_capture"), *attributes
    )
    return (
        latest.join(versions, [key, "load_dts"])
        .groupBy(key, spec.hub.key, "snapshot_id", "snapshot_at", "load_dts")
        .agg(F.max(F.struct("_version_capture", *attributes)).alias("_version"))
        .select(
            key,
            spec.hub.key,
            *[F.col("_version")[name].alias(name) for name in attributes],
            "snapshot_id",
            "snapshot_at",
            F.col("load_dts").alias(spec.pointer),
        )
    )


def as_of_join(
    facts: DataFrame, pit: DataFrame, satellite: DataFrame, spec: PointInTime, at: str
) -> DataFrame:
    """Every fact with the state its key had at the fact's own time.

    ``facts`` has the hub's hash key and a time without zone, ``at``; all its columns stay. The state is one
    column named after the satellite: a struct of the attributes, ``snapshot_id``, ``snapshot_at`` and the
    pointer, null where key or time is null, unknown, or before the key's first pointer.

    Time is cut into days. Per key, one running window over its pointers and the days on which it has
    facts (both short lists, however many facts there are) says what each such day begins with; with the
    pointers within the day these are intervals, and a fact meets only those of its key and day. Facts
    are exchanged once, for that join, where a key and day with very many of them is a partition
    Spark splits.
    """
    key, name, pointer = spec.hub.hash_key, spec.satellite.name, spec.pointer
    taken = F.struct("snapshot_id", *spec.satellite.attribute_names)
    versions = (
        satellite.groupBy(key, F.col("load_dts").alias(pointer))
        .agg(F.max(taken).alias("_version"))
        .withColumn("_version", F.col("_version").dropFields("snapshot_id"))
    )
    state = F.struct("_version.*", "snapshot_id", "snapshot_at", pointer).alias("_state")
    pointers = pit.join(versions, [key, pointer]).select(
        F.col(key).alias("_key"), F.to_date("snapshot_at").alias("_day"), F.col("snapshot_at").alias("_from"), state
    )
    # A fact travels as one column, so that its columns' names meet no others.
    packed = facts.select(
        F.struct("*").alias("_fact"), F.col(key).alias("_key"), F.to_date(at).alias("_day"), F.col(at).alias("_at")
    )
    days = packed.filter("_key is not null and _day is not null").select("_key", "_day").distinct()
    begins = days.select(
        "_key",
        "_day",
        F.col("_day").cast("timestamp_ntz").alias("_from"),
        F.lit(None).cast(pointers.schema["_state"].dataType).alias("_state"),
        F.lit(True).alias("_begins"),
    )
    # A pointer at midnight comes before the day that begins then.
    order = Window.partitionBy("_key").orderBy("_day", "_from", "_begins")
    in_day = Window.partitionBy("_key", "_day")
    until_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    midnight_first = F.when(F.col("_begins") | (F.col("_from") > F.col("_day").cast("timestamp_ntz")), F.col("_from"))
    intervals = (
        pointers.withColumn("_begins", F.lit(False))
        .unionByName(begins)
        .withColumn("_state", F.last("_state", ignorenulls=True).over(until_now))
        .withColumn("_asked", F.max("_begins").over(in_day))
        .filter("_asked")
        .withColumn("_from", midnight_first)
        .filter("_from is not null")
        .withColumn("_until", F.lead("_from").over(in_day.orderBy("_from", "_begins")))
        .select(F.col("_key").alias("_of"), F.col("_day").alias("_on"), "_from", "_until", F.col("_state").alias(name))
    )
    valid = (F.col("_at") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("_at") < F.col("_until")))
    same = (F.col("_key") == F.col("_of")) & (F.col("_day") == F.col("_on")) & valid
    return packed.join(intervals, same, "left").select("_fact.*", name)


def pit_increment(
    hub: DataFrame,
    satellite: DataFrame,
    captures: DataFrame,
    existing: DataFrame,
    spec: PointInTime,
    last: Moment,
) -> DataFrame:
    """Rows to append to a stored point-in-time table that is complete up to the capture ``last``.

    ``captures`` are all captures; of those up to ``last`` none may have come or gone since (their number in
    the load log tells), and none after it may share its time. Only versions after ``last`` are looked at, by a filter on their time which the
    scan takes over. The earlier versions are looked at for keys without any pointer alone, as a key may
    enter the hub later than the captures; where there is no such key, Spark drops that part while it
    runs.
    """
    key = spec.hub.hash_key
    after = F.col("load_dts") > last.at_literal
    newer = satellite.filter(after)
    without = hub.join(existing.select(key).distinct(), key, "left_anti").select(key)
    earlier = satellite.filter(~after).join(without, key, "left_semi")
    times = _version_times(newer.select(key, "load_dts").unionByName(earlier.select(key, "load_dts")), spec)
    # A run may have been interrupted after it had stored its rows.
    pointed = existing.filter(F.col("snapshot_at") > last.at_literal).select(key, "snapshot_at")
    pointers = _pointers(times, captures, spec).join(pointed, [key, "snapshot_at"], "left_anti")
    return _with_hub(hub, pointers, spec)


def _version_times(satellite: DataFrame, spec: PointInTime) -> DataFrame:
    return satellite.select(spec.hub.hash_key, "load_dts").distinct()


def _first_per_instant(captures: DataFrame) -> DataFrame:
    return captures.groupBy(F.col("load_dts").alias("snapshot_at")).agg(
        F.min("snapshot_id").alias("snapshot_id")
    )


def _with_hub(hub: DataFrame, pointers: DataFrame, spec: PointInTime) -> DataFrame:
    key = spec.hub.hash_key
    return (
        hub.select(key, spec.hub.key)
        .join(pointers, key)
        .select(
            key,
            spec.hub.key,
            "snapshot_id",
            "snapshot_at",
            F.col("load_dts").alias(spec.pointer),
        )
    )
