"""One run: current copies, current state, reports, captures, vault, point in time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment
from ledgerloom.operators.keyed import build_hub, link_increment
from ledgerloom.operators.point_in_time import build_pit_pruned, pit_increment
from ledgerloom.operators.satellite import (
    build_satellite,
    satellite_increment,
    satellite_repair,
)
from ledgerloom.operators.specs import Hub, Link, Satellite, Status
from ledgerloom.operators.status import next_state, status_increment, status_state
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
from ledgerloom.sources.guard import RunGuard
from ledgerloom.sources.readers import Reader
from ledgerloom.sources.stamping import new_capture_id, stamp_current, utc_now
from ledgerloom.sources.tables import SNAPSHOT_AT, SOURCE_TABLES, check_columns
from ledgerloom.sources.warehouse import HISTORY, LOAD_LOG, RUN_LOG, Warehouse

CURRENT = "bronze"
SILVER_SPACE = None  # current-state models name no namespace and go to the default one
GOLD_SPACE = "gold"
VAULT = "raw_vault"
BUSINESS_VAULT = "business_vault"
# After a status satellite's name: what each relationship is now.
STATE = "_state"
# After the name of kept totals: the days that were totalled last.
TOUCHED = "_touched"


def load_current(
    warehouse: Warehouse, source: Reader, ingested_at: datetime, parallel: int = 1
) -> dict[str, int]:
    """Replace the current copy of every source table; returns rows per table."""

    def load(name: str) -> int:
        rows = check_columns(source(name), SOURCE_TABLES[name])
        return warehouse.replace(CURRENT, name, stamp_current(rows, ingested_at))

    return _each(warehouse, {name: lambda n=name: load(n) for name in SOURCE_TABLES}, parallel)


def load_captures(
    warehouse: Warehouse, source: Reader, capture_id: str, captured_at: datetime, parallel: int = 1
) -> dict[str, int | None]:
    """Append one capture of every source table; returns rows per table, None if loaded before.

    All tables are logged in one write. If one of them fails, those stored before are logged still,
    so that a repeated run goes on where this one stopped.
    """
    stored: dict[str, int | None] = {}

    def load(name: str) -> int | None:
        rows = check_columns(source(name), SOURCE_TABLES[name])
        stored[name] = warehouse.store_capture(name, rows, capture_id, captured_at)
        return stored[name]

    try:
        return _each(warehouse, {name: lambda n=name: load(n) for name in SOURCE_TABLES}, parallel)
    finally:
        warehouse.log_captures(
            [(name, capture_id, captured_at, n) for name, n in stored.items() if n is not None]
        )


def write_silver(warehouse: Warehouse, parallel: int = 1) -> dict[str, int]:
    def write(name: str) -> int:
        table, build = SILVER[name]
        return warehouse.replace(SILVER_SPACE, name, build(warehouse.read(CURRENT, table)))

    return _each(warehouse, {name: lambda n=name: write(n) for name in SILVER}, parallel)


def write_gold(warehouse: Warehouse, parallel: int = 1, newer_only: bool = True) -> dict[str, int]:
    """Replace the reports; returns the rows of each.

    Both reports over transactions keep their totals per day, each with a mark of the rows it was made
    from. Only days whose rows are others now are totalled again; without ``newer_only`` all are.
    """

    def silver(name: str) -> DataFrame:
        return warehouse.read(SILVER_SPACE, name)

    customers, transactions = silver("silver_customers"), silver("silver_transactions")
    summary_name, daily_name = "gold_account_transaction_summary", "gold_customer_daily_transactions"

    def kept(totals: DayTotals) -> DataFrame:
        return refresh_totals(warehouse, transactions, totals, newer_only)

    def summary() -> int:
        rows = gold.account_summary_of_days(
            silver("silver_accounts"), customers, kept(gold.ACCOUNT_DAYS), transactions, silver("silver_gl_accounts")
        )
        return warehouse.replace(GOLD_SPACE, summary_name, rows)

    def daily() -> int:
        rows = gold.customer_daily_of_days(kept(gold.CUSTOMER_DAYS), customers)
        return warehouse.replace(GOLD_SPACE, daily_name, rows)

    written = _each(warehouse, {summary_name: summary, daily_name: daily}, parallel)
    top = gold.top_customers(warehouse.read(GOLD_SPACE, daily_name))
    written["gold_top_customer"] = warehouse.replace(GOLD_SPACE, "gold_top_customer", top)
    return written


def refresh_totals(
    warehouse: Warehouse, rows: DataFrame, totals: DayTotals, newer_only: bool = True
) -> DataFrame:
    """Bring kept totals up to the rows of now, and return them.

    The list of days is written first, so that rows are marked once and the list's size is known. Totals
    and the marks they stand for are replaced in one step: a run that stops before leaves both as they were.
    """
    kept = warehouse.read_if_exists(GOLD_SPACE, totals.name) if newer_only else None
    listed = f"{totals.name}{TOUCHED}"
    touched = warehouse.replace(GOLD_SPACE, listed, touched_days(rows, kept, totals).coalesce(1))
    if touched or kept is None:
        fresh = next_totals(rows, kept, totals, warehouse.read(GOLD_SPACE, listed))
        warehouse.replace(GOLD_SPACE, totals.name, fresh)
    return warehouse.read(GOLD_SPACE, totals.name)


def write_vault(
    warehouse: Warehouse, newer_only: bool = True, parallel: int = 1
) -> dict[str, int]:
    """Append what is new to hubs, links, satellites and the status satellite.

    Only logged captures are read. A model over captures enters in the run log up to which capture it
    is complete; with ``newer_only`` it reads those after that one, whether or not they changed
    anything. If a capture was logged since with an earlier time, satellites are repaired from there on,
    for its keys, and the other models compare the whole history. No
    model reads another one, so up to ``parallel`` of them are written at a time, and one with a long
    last task does not leave the cluster idle.
    """
    read = warehouse.read
    stored = partial(warehouse.read_if_exists, VAULT)
    done: list[tuple[str, Moment, int]] = []

    def captured(model: str, table: str, write: Callable[[DataFrame, _Seen], int]) -> int:
        """Write from the captures a model has yet to see, and note that it has seen them."""
        seen = _seen(warehouse, VAULT, model, table, newer_only, repairs=model in SATELLITES)
        newer = seen.captures
        if seen.last:
            newer = newer.filter(seen.last.before(F.col("load_dts"), F.col("snapshot_id")))
        written = write(warehouse.history(table, newer), seen)
        done.extend(seen.entries(model))
        return written

    def hub(model: Hub) -> int:
        built = build_hub(read(CURRENT, model.table), model)
        return warehouse.append_new(VAULT, model.name, built, [model.hash_key], model.hash_key)

    def link(model: Link) -> int:
        def write(rows: DataFrame, *_) -> int:
            fresh = link_increment(rows, stored(model.name), model)
            return warehouse.append(VAULT, model.name, fresh, model.hash_key)

        if model.seen_at == SNAPSHOT_AT:
            return captured(model.name, model.table, write)
        return write(read(CURRENT, model.table))

    def satellite(model: Satellite) -> int:
        def write(rows: DataFrame, seen: _Seen) -> int:
            repaired = repair_satellite(warehouse, model, seen.captures, seen.late, seen.last) if seen.late else 0
            fresh = satellite_increment(rows, stored(model.name), model, seen.last)
            return repaired + warehouse.append(VAULT, model.name, fresh)

        return captured(model.name, model.table, write)

    def status(model: Status) -> int:
        kept = f"{model.name}{STATE}"

        def write(rows: DataFrame, seen: _Seen) -> int:
            listed = None if model.per_source else seen.captures
            state = _state_at(stored(kept), seen.last)
            fresh = status_increment(rows, stored(model.name), model, listed, seen.last, state)
            written = warehouse.append(VAULT, model.name, fresh)
            if seen.newest is not None:
                changes = read(VAULT, model.name)
                if state is None:
                    now = status_state(changes, model)
                else:
                    # The rows just appended, and those of a run that was interrupted after its own.
                    changes = changes.filter(F.col("load_dts") >= seen.last.at_literal)
                    now = next_state(state, changes, model)
                at = {"state_dts": seen.newest.at_literal, "state_id": F.lit(seen.newest.snapshot_id)}
                warehouse.replace(VAULT, kept, now.withColumns(at))
            return written

        return captured(model.name, model.link.table, write)

    steps = {}
    # The longest first: satellites compare whole captures.
    for write, models in (
        (satellite, SATELLITES.values()),
        (status, [CUSTOMER_ACCOUNT_STATUS]),
        (link, LINKS.values()),
        (hub, HUBS.values()),
    ):
        steps |= {model.name: lambda w=write, m=model: w(m) for model in models}
    try:
        return _each(warehouse, steps, parallel)
    finally:
        warehouse.log_progress(VAULT, done)


def repair_satellite(
    warehouse: Warehouse, model: Satellite, captures: DataFrame, late: Sequence[Moment], last: Moment
) -> int:
    """Take captures that arrived late into a stored satellite; returns the rows added.

    Captures before them are not read. Where no row has to be taken back, rows are appended; else the
    satellite is replaced by its rows without those.
    """
    first = min(late, key=_order)
    from_there = captures.filter(F.col("load_dts") >= first.at_literal)
    from_there = from_there.filter(~last.before(F.col("load_dts"), F.col("snapshot_id")))
    arrived = captures.filter(F.col("snapshot_id").isin([one.snapshot_id for one in late]))
    existing = warehouse.read(VAULT, model.name)
    add, gone = satellite_repair(warehouse.history(model.table, from_there), existing, model, arrived, first)
    if gone.isEmpty():
        return warehouse.append(VAULT, model.name, add)
    # Before the rows themselves change.
    added = add.count()
    same = [model.hash_key, "load_dts", "snapshot_id", "hashdiff"]
    warehouse.replace(VAULT, model.name, existing.join(gone.select(*same), same, "left_anti").unionByName(add))
    return added


def compact(warehouse: Warehouse, parallel: int = 1) -> dict[str, bool]:
    """Rewrite the tables that grow by small appends once they have gathered many files."""
    steps = {
        model.name: lambda m=model: warehouse.compact(VAULT, m.name, m.hash_key)
        for model in [*HUBS.values(), *LINKS.values()]
    }
    for name in [*SATELLITES, CUSTOMER_ACCOUNT_STATUS.name, RUN_LOG]:
        steps[name] = lambda n=name: warehouse.compact(VAULT, n)
    for name in POINTS_IN_TIME:
        steps[name] = lambda n=name: warehouse.compact(BUSINESS_VAULT, n)
    steps[LOAD_LOG] = lambda: warehouse.compact(HISTORY, LOAD_LOG)
    return _each(warehouse, steps, parallel)


def rebuild_satellites(warehouse: Warehouse) -> dict[str, int]:
    """Replace every satellite by a full comparison of the history, and the point-in-time tables over
    them.

    Appended rows are never taken back, so a capture that arrives after a later one can leave a
    version which a full comparison would not have. This gives the exact result.
    """
    def rows(table: str) -> DataFrame:
        return warehouse.history(table, warehouse.captures(table))

    rebuilt = {
        name: warehouse.replace(VAULT, name, build_satellite(rows(satellite.table), satellite))
        for name, satellite in SATELLITES.items()
    }
    if any(warehouse.exists(BUSINESS_VAULT, name) for name in POINTS_IN_TIME):
        write_business_vault(warehouse, newer_only=False)
    return rebuilt


def write_business_vault(
    warehouse: Warehouse, newer_only: bool = True, parallel: int = 1
) -> dict[str, int]:
    """Append to the point-in-time tables what newer captures and keys bring; returns the rows written.

    A capture that was logged late or removed since changes the number of captures up to the last one
    seen. Then, after a capture of the very time of the last one, and without ``newer_only``, the table is
    replaced; captures that were removed are no
    pointers, and versions from them count from the next one on.
    """
    done: list[tuple[str, Moment, int]] = []

    def write(name: str) -> int:
        pit = POINTS_IN_TIME[name]
        seen = _seen(warehouse, BUSINESS_VAULT, name, pit.satellite.table, newer_only)
        hub = warehouse.read(VAULT, pit.hub.name)
        satellite = warehouse.read(VAULT, pit.satellite.name)
        existing = warehouse.read_if_exists(BUSINESS_VAULT, name)
        if existing is not None and seen.last and not _shares_time(seen):
            fresh = pit_increment(hub, satellite, seen.captures, existing, pit, seen.last)
            written = warehouse.append(BUSINESS_VAULT, name, fresh)
        else:
            table = build_pit_pruned(hub, satellite, seen.captures, pit)
            written = warehouse.replace(BUSINESS_VAULT, name, table)
        done.extend(seen.entries(name))
        return written

    try:
        return _each(warehouse, {name: lambda n=name: write(n) for name in POINTS_IN_TIME}, parallel)
    finally:
        warehouse.log_progress(BUSINESS_VAULT, done)


@dataclass(frozen=True)
class _Seen:
    """The captures of a table, how many, the newest, those a model has yet to enter, the last one it has
    seen, if it can go on from there, and those before that one which arrived after it."""

    captures: DataFrame
    number: int
    newest: Moment | None
    unseen: tuple[Moment, ...]
    last: Moment | None
    late: tuple[Moment, ...] = ()

    def entries(self, model: str) -> list[tuple[str, Moment, int]]:
        """What the run log is to say once the model has taken all of them in."""
        if self.newest is None:
            return []
        # The newest again, even if it was seen, as the number may have changed.
        return [(model, one, self.number) for one in dict.fromkeys([*self.unseen, self.newest])]


def _seen(
    warehouse: Warehouse, namespace: str, model: str, table: str, newer_only: bool, repairs: bool = False
) -> _Seen:
    captures = warehouse.captures(table)
    # Lists of runs, compared here rather than by a job each.
    listed = sorted(_moments(captures), key=_order)
    entered = set() if (known := warehouse.seen(namespace, model)) is None else {row[0] for row in known.collect()}
    unseen = tuple(one for one in listed if one.snapshot_id not in entered)
    seen = _Seen(captures, len(listed), listed[-1] if listed else None, unseen, None)
    progress = warehouse.progress(namespace, model) if newer_only else None
    if progress is None:
        return seen
    last, before = progress
    up_to_last = [one for one in listed if _order(one) <= _order(last)]
    if len(up_to_last) == before:
        return replace(seen, last=last)
    # Some arrived late, or were removed; what was seen is known by name, or, from older runs, not.
    late = tuple(one for one in up_to_last if one.snapshot_id not in entered)
    if repairs and late and len(entered) == before == len(up_to_last) - len(late):
        return replace(seen, last=last, late=late)
    return seen


def _moments(captures: DataFrame) -> list[Moment]:
    return [Moment(row["load_dts"], row["snapshot_id"]) for row in captures.collect()]


def _order(moment: Moment) -> tuple[datetime, str]:
    return moment.load_dts, moment.snapshot_id


def _shares_time(seen: _Seen) -> bool:
    """Whether a capture after the last one seen has its time."""
    later = seen.last.before(F.col("load_dts"), F.col("snapshot_id"))
    return not seen.captures.filter(F.col("load_dts") == seen.last.at_literal).filter(later).isEmpty()


def _state_at(kept: DataFrame | None, last: Moment | None) -> DataFrame | None:
    """The kept state, if it is that after the capture ``last``."""
    if kept is None or last is None:
        return None
    at = kept.select("state_dts", "state_id").first()
    if at is None or Moment(at["state_dts"], at["state_id"]) != last:
        return None
    return kept.drop("state_dts", "state_id")


def run_all(
    warehouse: Warehouse,
    source: Reader,
    run_at: datetime | None = None,
    capture_id: str | None = None,
    newer_only: bool = True,
    parallel: int = 1,
    guard: RunGuard | None = None,
) -> dict[str, dict]:
    """Run every step in order; repeating a run with its capture id and time adds nothing twice.

    Only one run at a time is let in (``RunRefused``), by a claim beside the warehouse; one that was taken
    for dead stops before its next step (``RunLost``).

    ``newer_only`` lets each model read only the captures it has not seen, so that the cost of a run
    does not grow with the history; False compares the whole history, as happens by itself after
    a capture that arrives late. A run that failed is to be repeated.
    """
    run_at = run_at or utc_now()
    capture_id = capture_id or new_capture_id()
    steps = {
        "current": lambda: load_current(warehouse, source, run_at, parallel),
        "silver": lambda: write_silver(warehouse, parallel),
        "gold": lambda: write_gold(warehouse, parallel, newer_only),
        "captures": lambda: load_captures(warehouse, source, capture_id, run_at, parallel),
        "vault": lambda: write_vault(warehouse, newer_only, parallel),
        "business_vault": lambda: write_business_vault(warehouse, newer_only, parallel),
        "compacted": lambda: compact(warehouse, parallel),
    }
    guard = guard or warehouse.guard()
    done = {}
    with guard.run(f"capture {capture_id} of {run_at.isoformat()}") as claim:
        for name, step in steps.items():
            guard.check(claim)
            done[name] = step()
    return done


def _each(
    warehouse: Warehouse, steps: Mapping[str, Callable[[], int]], parallel: int
) -> dict[str, int]:
    """Results of independent writes to different tables, up to ``parallel`` at a time."""
    carried = inheritable_thread_target(warehouse.spark)
    with ThreadPoolExecutor(parallel) as pool:
        running = {name: pool.submit(carried(step)) for name, step in steps.items()}
    return {name: future.result() for name, future in running.items()}
