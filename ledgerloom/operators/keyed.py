"""Hubs, links and the append filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.specs import Hub, Link
from ledgerloom.sources.tables import INGESTED_AT, SOURCE_COLUMN


def identified_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a full identity: no key column and no source system is null.

    A null in either makes the hash key null, and a null key in a target would defeat every later
    comparison against it. The tests are on the stored columns, one by one, so they reach the file
    scan.
    """
    return with_values(rows, [*columns, SOURCE_COLUMN])


def with_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null, as filters a file scan can take over."""
    for column in columns:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def _first_seen(rows: DataFrame, columns: Sequence[str], seen_at: str) -> DataFrame:
    # Grouping the raw keys first combines copies inside each task, whatever the share of one key;
    # hashes are then computed once per distinct key.
    keys = [F.trim(F.col(column)).alias(column) for column in columns]
    return (
        identified_rows(rows, columns)
        .groupBy(*keys, F.col(SOURCE_COLUMN).alias("record_source"))
        .agg(F.min(seen_at).alias("load_dts"))
    )


def build_hub(current: DataFrame, hub: Hub) -> DataFrame:
    """One row per distinct trimmed key and source, with the earliest load time."""
    source = F.col("record_source")
    return _first_seen(current, hub.columns, INGESTED_AT).select(
        hub.hash(source).alias(hub.hash_key), hub.key, "load_dts", "record_source"
    )


def build_link(rows: DataFrame, link: Link) -> DataFrame:
    """One row per distinct combination of trimmed keys and source, with the earliest time seen."""
    for column in link.not_blank:
        rows = rows.filter(F.trim(F.col(column)) != "")
    source = F.col("record_source")
    child = [link.child] if link.child else []
    return _first_seen(rows, link.columns, link.seen_at).select(
        link.hash(source).alias(link.hash_key),
        *child,
        *link.role_keys(source),
        "load_dts",
        "record_source",
    )


def link_increment(rows: DataFrame, existing: DataFrame | None, link: Link) -> DataFrame:
    """Rows to append to a stored link; of a link read from captures, ``rows`` may be the newer
    captures only, as relationships of the others are stored already."""
    return new_rows(build_link(rows, link), existing, [link.hash_key])


def new_rows(
    built: DataFrame, existing: DataFrame | None, keys: Sequence[str], unique: bool = True
) -> DataFrame:
    """Rows of ``built`` whose keys are not stored yet.

    A plain anti join: it may be shuffled, broadcast by size, or read a bucketed target in place.
    ``unique=False`` says that a key may be stored more than once; copies are then combined before
    the exchange, so that a key with many of them does not weigh on one task.
    """
    if existing is None:
        return built
    stored = existing.select(*keys)
    if not unique:
        stored = stored.distinct()
    return built.join(stored, list(keys), "left_anti")
