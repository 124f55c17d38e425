"""Status satellite: when a relationship appears in, and disappears from, the captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment, capture_list
from ledgerloom.operators.keyed import identified_rows, new_rows
from ledgerloom.operators.specs import Status
from ledgerloom.sources.tables import SNAPSHOT_ID, SOURCE_COLUMN


def build_status(
    history: DataFrame, status: Status, captures: DataFrame | None = None
) -> DataFrame:
    """One row per change of presence, per relationship.

    Captures are numbered; the numbers at which a relationship is present form runs without gaps.
    Each run gives an active row at its start and an inactive row at the capture after its end. The
    work is linear in the rows of the history: no relationship meets a capture it is not part of,
    except the one after a run. ``captures`` (snapshot_id, load_dts, with record_source if compared
    per source) may come from a run log which also knows captures without any row; by default it is
    read off the history.
    """
    if captures is None:
        captures = capture_list(history, status.per_source)
    present = _present(history, status).join(
        _numbered(captures, status.per_source), _matching(status)
    )
    changed = _changes(present, ["record_source", *status.link.columns])
    # Hashed last: only changes need their keys.
    return _result(changed.select(*_hashed(status), "_event"), status)


def status_increment(
    history: DataFrame,
    existing: DataFrame | None,
    status: Status,
    captures: DataFrame | None = None,
    last: Moment | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Rows to append to a stored status satellite.

    Without ``last``, the whole history is compared again. With it, ``history`` holds only the
    captures after ``last``, up to which the satellite is complete, and ``captures`` all captures
    from the time of ``last`` on; a relationship is until then what its last row says. ``state`` is that
    kept apart, a row per relationship (see ``status_state``), so that rows of past changes are not read
    again. The result is the same as long as captures arrive in order.
    """
    if existing is None or last is None:
        built = build_status(history, status, captures)
        return new_rows(built, existing, [status.link.hash_key, "snapshot_id"], unique=False)

    if captures is None:
        captures = capture_list(history, status.per_source)
    later = last.before(F.col("load_dts"), F.col("snapshot_id"))
    if state is None:
        state = status_state(existing.filter(~later), status)
    captures = _from_moment(captures, state, last, status)
    seen = _present(history, status).select(*_hashed(status), "snapshot_id").withColumns(
        {"_present": F.lit(True), "_stored": F.lit(False)}
    )
    # Stored relationships enter at the last capture seen, in the state they are in.
    entering = state.select(*_state_keys(status), F.col("is_active").alias("_present")).withColumns(
        {"snapshot_id": F.lit(last.snapshot_id), "_stored": F.lit(True)}
    )
    rows = seen.unionByName(entering).join(_numbered(captures, status.per_source), _matching(status))
    changed = _changes(
        rows,
        [status.link.hash_key, "record_source"],
        present=F.col("_present"),
        stored=F.col("_stored"),
    )
    # Rows that a run stored before it was interrupted are there already.
    stored = existing.filter(F.col("load_dts") >= last.at_literal).filter(later)
    return new_rows(_result(changed, status), stored, [status.link.hash_key, "snapshot_id"], unique=False)


def status_state(rows: DataFrame, status: Status) -> DataFrame:
    """What every relationship is after the rows of a status satellite: its keys and ``is_active``."""
    return (
        rows.groupBy(*_state_keys(status))
        .agg(F.max(F.struct("load_dts", "snapshot_id", "is_active"))["is_active"].alias("is_active"))
    )


def next_state(state: DataFrame, changes: DataFrame, status: Status) -> DataFrame:
    """The state after ``changes``, the rows appended since: a full outer join of two sides with one row
    per relationship."""
    keys = _state_keys(status)
    now = status_state(changes, status).withColumnRenamed("is_active", "_now")
    return state.join(now, keys, "full_outer").select(*keys, F.coalesce("_now", "is_active").alias("is_active"))


def _state_keys(status: Status) -> list[str]:
    return [status.link.hash_key, *[role.hash_key for role in status.link.roles], "record_source"]


def _present(history: DataFrame, status: Status) -> DataFrame:
    # Copies of a relationship within a capture collapse inside each task before the exchange, so a
    # relationship has at most one row per capture from here on.
    identity = status.link.columns
    return (
        identified_rows(history, identity)
        .select(
            *[F.trim(F.col(column)).alias(column) for column in identity],
            F.col(SOURCE_COLUMN).alias("record_source"),
            F.col(SNAPSHOT_ID).alias("snapshot_id"),
        )
        .distinct()
    )


def _matching(status: Status) -> list[str]:
    return ["snapshot_id", "record_source"] if status.per_source else ["snapshot_id"]


def _hashed(status: Status) -> list:
    source = F.col("record_source")
    return [
        status.link.hash(source).alias(status.link.hash_key),
        *status.link.role_keys(source),
        "record_source",
    ]


def _changes(
    rows: DataFrame,
    by: Sequence[str],
    present: Column | None = None,
    stored: Column | None = None,
) -> DataFrame:
    """Rows of ``rows`` at which presence changes, once per change, as column ``_event``."""
    present = F.lit(True) if present is None else present
    stored = F.lit(False) if stored is None else stored
    in_order = Window.partitionBy(*by).orderBy("_number")
    number, before, after = F.col("_number"), F.col("_before"), F.col("_after")
    first = ~stored & before.isNull()
    appears = present & (first | ~F.col("_was_present") | (number - before > 1)) & ~stored
    disappears = (
        present & F.col("_next").isNotNull() & (after.isNull() | (after - number > 1))
    )
    # Captures of the same instant but lower id count as observations too: absent there.
    late_start = first & F.col("_tied").isNotNull()

    def event(condition: Column, active: bool, capture: str) -> Column:
        return F.when(
            condition, F.struct(F.lit(active).alias("is_active"), F.col(capture).alias("capture"))
        )

    events = F.array_compact(
        F.array(
            event(late_start, False, "_tied"),
            event(appears, True, "_this"),
            event(disappears, False, "_next"),
        )
    )
    return (
        rows.withColumns(
            {
                "_before": F.lag("_number").over(in_order),
                "_was_present": F.lag(present).over(in_order),
                "_after": F.lead("_number").over(in_order),
            }
        )
        .filter(appears | disappears)
        .withColumn("_event", F.explode(events))
    )


def _result(changed: DataFrame, status: Status) -> DataFrame:
    return changed.select(
        status.link.hash_key,
        *[role.hash_key for role in status.link.roles],
        "_event.is_active",
        "_event.capture.load_dts",
        "_event.capture.snapshot_id",
        "record_source",
    )


def _from_moment(
    captures: DataFrame, state: DataFrame, last: Moment, status: Status
) -> DataFrame:
    """``captures`` from the time of ``last`` on, that capture included for every source."""
    found = captures.filter(F.col("load_dts") >= last.at_literal)
    sources = state.select("record_source").distinct() if status.per_source else (
        state.limit(1).select()
    )
    start = sources.select(
        F.lit(last.snapshot_id).alias("snapshot_id"),
        last.at_literal.alias("load_dts"),
        *(["record_source"] if status.per_source else []),
    )
    return found.unionByName(start).distinct()


def _numbered(captures: DataFrame, per_source: bool) -> DataFrame:
    """Captures with their number, themselves, the next one, and the first of the same instant.

    The windows span the capture list only: one row per run of the loader.
    """
    source = ["record_source"] if per_source else []
    every = Window.partitionBy(*source).orderBy("load_dts", "snapshot_id")
    instant = Window.partitionBy(*source, "load_dts").orderBy("snapshot_id")
    this = F.struct("load_dts", "snapshot_id")
    position = F.row_number().over(instant)
    return captures.select(
        "snapshot_id",
        *source,
        F.row_number().over(every).alias("_number"),
        this.alias("_this"),
        F.lead(this).over(every).alias("_next"),
        F.when(position > 1, F.first(this).over(instant)).alias("_tied"),
    )
