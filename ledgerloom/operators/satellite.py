"""Satellites: attribute versions, one row per change between captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.keys import change_hash, require_stable_text
from ledgerloom.operators.captures import Moment
from ledgerloom.operators.keyed import identified_rows, new_rows, with_values
from ledgerloom.operators.specs import Satellite
from ledgerloom.sources.tables import SNAPSHOT_AT, SNAPSHOT_ID, SOURCE_COLUMN

CAPTURE = ["load_dts", "snapshot_id"]
# The hash key in bytes, half as long as its text and no more compressible: exchanges carry this one.
KEY = "_key"


def build_satellite(history: DataFrame, satellite: Satellite) -> DataFrame:
    """Every version of every key in the whole history.

    Versions are compared on the attributes themselves, per trimmed key and source. That is the same
    as comparing change hashes per hash key, but only the surviving rows need the two hashes, and the
    exchanges carry neither.
    """
    rows = _capture_rows(history, satellite)
    by = ["record_source", *satellite.parent.columns]
    changed = changed_versions(rows, by, satellite.attribute_names)
    return changed.select(*_columns(satellite, _hash_key(satellite)))


def satellite_increment(
    history: DataFrame,
    existing: DataFrame | None,
    satellite: Satellite,
    last: Moment | None = None,
) -> DataFrame:
    """Rows to append to a stored satellite.

    Without ``last``, ``history`` is the whole history; it is compared again, and rows stored for the
    same key and capture are left out, which also takes up captures that arrive late. With it,
    ``history`` holds only the captures after ``last``, up to which the satellite is complete; they
    are compared with the last stored version per key. The result is the same as long as captures
    arrive in order, and its cost does not grow with the history.
    """
    if existing is None:
        return build_satellite(history, satellite)
    rows = _capture_rows(history, satellite)
    by = ["record_source", *satellite.parent.columns]
    if last is None:
        changed = changed_versions(rows, by, satellite.attribute_names)
        return _unstored(_keyed(changed, satellite), existing, satellite)

    later = last.before(F.col("load_dts"), F.col("snapshot_id"))
    # Within the newer captures the raw keys are compared, as in a whole history. Only what is left meets
    # the stored versions, which are known by hash key: of each key, its first row.
    lows, others = _compared(rows.filter(later), by, satellite.attribute_names)
    begins = F.col("_before").isNull().alias("_begins")
    lows = _keyed(lows, satellite, F.struct(*satellite.attribute_names).alias("_version"), begins)
    keys = lows.filter("_begins").select(KEY)
    seen = _last_versions(existing.filter(~later).select(_stored_key(satellite), "*"), keys, satellite, KEY)
    seen = seen.select(KEY, F.struct(*satellite.attribute_names).alias("_seen"))
    known = F.col("_begins") & F.col("_seen").isNotNull() & F.col("_seen").eqNullSafe(F.col("_version"))
    lows = lows.join(seen, KEY, "left").filter(~known).drop("_version", "_begins", "_seen")
    changed = lows.unionByName(_keyed(others, satellite))
    # Rows that a run stored before it was interrupted are there already.
    return _unstored(changed, existing.filter(later), satellite)


def satellite_repair(
    history: DataFrame, existing: DataFrame, satellite: Satellite, late: DataFrame, first: Moment
) -> tuple[DataFrame, DataFrame]:
    """What captures that arrived late change in a stored satellite: rows to add, and rows to take back.

    ``late`` are those captures, ``first`` the earliest of them, and ``history`` all captures from ``first`` up to
    the last one the satellite has seen. Only keys of the late captures can change, and only from
    ``first`` on: these are compared again, beginning with their last stored version before. The result is
    that of comparing the whole history.
    """
    since = ~_before(first)
    key, carried = satellite.hash_key, [satellite.label, "record_source"]
    rows = _hashed_rows(history, satellite)
    arrived = late.select(F.col("snapshot_id").alias("_late")).distinct()
    touched = rows.join(arrived, F.col("snapshot_id") == F.col("_late"), "left_semi").select(key).distinct()
    again = rows.join(touched, key, "left_semi")
    last = _last_versions(existing.filter(_before(first)), touched, satellite)
    changed = changed_versions(again.unionByName(last), [key], satellite.attribute_names, carried)
    right = changed.filter(since).select(*_columns(satellite, F.col(key)))
    stored = existing.filter(F.col("load_dts") >= first.at_literal).filter(since).join(touched, key, "left_semi")
    same = [key, *CAPTURE, "hashdiff"]
    columns = existing.columns
    return (
        right.join(stored, same, "left_anti").select(*columns),
        stored.join(right, same, "left_anti").select(*columns),
    )


def _before(moment: Moment) -> Column:
    """Whether a row is of a capture before this one."""
    same = (F.col("load_dts") == moment.at_literal) & (F.col("snapshot_id") >= F.lit(moment.snapshot_id))
    return ~(moment.before(F.col("load_dts"), F.col("snapshot_id")) | same)


def changed_versions(
    rows: DataFrame, by: Sequence[str], attributes: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Rows which differ from the row before them, per key, in capture order.

    Several rows of one key in one capture follow each other in attribute order. ``carried`` columns
    depend on the key and are only passed along.
    """
    lows, others = _compared(rows, by, attributes, carried)
    return lows.drop("_before").unionByName(others)


def _compared(
    rows: DataFrame, by: Sequence[str], attributes: Sequence[str], carried: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Changed rows in two parts: the lowest of a key in a capture, and the others of that capture.

    The former have ``_before``, the highest version of the key in the capture before, null in its first.

    Per key and capture only the lowest and the highest version are needed to compare with the
    capture before; each task finds its own before the exchange, so that a key with any number of
    rows is one row per capture and task from there on. The versions between them differ from their
    neighbours anyway. They are looked up in the captures that have a key with several versions, a list
    no longer than that of captures, which Spark sends to the scan: where it is empty, Spark leaves
    out that part of the plan while it runs, and the rows are read once. There, copies are combined and the
    lowest taken out in one grouping by the whole row: a key with any number of versions is spread over all
    tasks.
    """
    # A join on these would leave out nulls below it, and so find no use for the exchange of another part
    # of the plan; a row without key or capture is none anyway.
    rows = with_values(rows, [*by, *CAPTURE])
    # Packed once, the attributes travel once; a separate lag column would double the exchange.
    packed = rows.select(*by, *CAPTURE, *carried, F.struct(*attributes).alias("_version"))
    where = [*by, *CAPTURE, *carried]
    ends = packed.groupBy(*where).agg(
        F.min("_version").alias("_version"), F.max("_version").alias("_highest")
    )
    # Mostly both are the same, which the second exchange then carries once.
    several = ~F.col("_version").eqNullSafe(F.col("_highest"))
    order = Window.partitionBy(*by).orderBy(*CAPTURE)
    before = F.coalesce(F.lag("_highest").over(order), F.lag("_version").over(order))
    lows = (
        ends.withColumn("_highest", F.when(several, F.col("_highest")))
        .withColumn("_before", before)
        .filter(~F.col("_before").eqNullSafe(F.col("_version")))
        .select(*where, "_version.*", "_before")
    )
    crowded = F.broadcast(ends.filter(several).select(F.col("snapshot_id").alias("_crowded")).distinct())
    # This always holds; asking keeps both columns, so that the exchange is used again.
    lowest = ends.filter(F.col("_version") <= F.col("_highest")).select(*where, "_version")
    there = packed.withColumn("_is_lowest", F.lit(False)).unionByName(lowest.withColumn("_is_lowest", F.lit(True)))
    others = (
        there.join(crowded, F.col("snapshot_id") == F.col("_crowded"), "left_semi")
        .groupBy(*where, "_version")
        .agg(F.max("_is_lowest").alias("_is_lowest"))
        .filter("not _is_lowest")
    )
    return lows, others.select(*where, "_version.*")


def _capture_rows(history: DataFrame, satellite: Satellite) -> DataFrame:
    require_stable_text(history, satellite.attribute_names)
    identity = satellite.parent.columns
    return identified_rows(history, identity).select(
        *[F.trim(F.col(column)).alias(column) for column in identity],
        *satellite.attribute_names,
        F.col(SNAPSHOT_AT).alias("load_dts"),
        F.col(SNAPSHOT_ID).alias("snapshot_id"),
        F.col(SOURCE_COLUMN).alias("record_source"),
    )


def _hashed_rows(history: DataFrame, satellite: Satellite) -> DataFrame:
    return _capture_rows(history, satellite).select(
        _hash_key(satellite).alias(satellite.hash_key),
        satellite.label,
        "record_source",
        *satellite.attribute_names,
        *CAPTURE,
    )


def _last_versions(existing: DataFrame, fresh: DataFrame, satellite: Satellite, key: str | None = None) -> DataFrame:
    """The last stored version of the keys that occur in the newer captures."""
    key = key or satellite.hash_key
    # The last stored version is also the last seen one: what was not stored equalled it.
    passed = [satellite.label, *satellite.attribute_names, *CAPTURE, "record_source"]
    latest = F.struct(*CAPTURE, *satellite.attribute_names)
    return (
        existing.join(fresh.select(key).distinct(), key, "left_semi")
        .groupBy(key)
        .agg(F.max_by(F.struct(*passed), latest).alias("_last"))
        .select(key, "_last.*")
    )


def _keyed(changed: DataFrame, satellite: Satellite, *more: Column) -> DataFrame:
    """Changed rows by hash key in bytes, still without change hash."""
    columns = [satellite.label, *satellite.attribute_names, *CAPTURE, "record_source"]
    return changed.select(_bytes(_hash_key(satellite)), *columns, *more)


def _stored_key(satellite: Satellite) -> Column:
    return _bytes(F.col(satellite.hash_key))


def _bytes(hash_key: Column) -> Column:
    # Never null, so that no join adds a filter on it, which would keep Spark from using an exchange again.
    return F.coalesce(F.unhex(hash_key), F.lit(b"")).alias(KEY)


def _unstored(changed: DataFrame, existing: DataFrame, satellite: Satellite) -> DataFrame:
    """Of changed rows by key in bytes, those of which no row of that key and capture is stored."""
    stored = existing.select(_stored_key(satellite), "snapshot_id")
    fresh = new_rows(changed, stored, [KEY, "snapshot_id"], unique=False)
    return fresh.select(*_columns(satellite, F.lower(F.hex(KEY))))


def _hash_key(satellite: Satellite) -> Column:
    # Rows have all parts of it by now. Knowing that, Spark adds no filter for a join above.
    return F.coalesce(satellite.parent.hash(F.col("record_source")), F.lit(""))


def _columns(satellite: Satellite, hash_key: Column) -> list:
    return [
        hash_key.alias(satellite.hash_key),
        satellite.label,
        *satellite.attribute_names,
        change_hash(satellite.hashed).alias("hashdiff"),
        "load_dts",
        "snapshot_id",
        "record_source",
    ]
