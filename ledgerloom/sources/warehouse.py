"""Writing and reading warehouse tables through the session's catalog."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment, logged_captures, of_captures
from ledgerloom.operators.keyed import new_rows
from ledgerloom.sources.guard import DEAD_AFTER, RENEW_EVERY, RunGuard
from ledgerloom.sources.stamping import stamp_capture, wall_clock
from ledgerloom.sources.tables import SNAPSHOT_ID

HISTORY = "bronze_history"
LOAD_LOG = "load_log"
RUN_LOG = "run_log"
CAPTURE_ID = re.compile(r"[A-Za-z0-9._:-]+")
LOAD_LOG_COLUMNS = (
    "table_name string, snapshot_id string, snapshot_at timestamp_ntz, row_count bigint"
)
# A model is complete up to this capture, which was the n-th of its table.
RUN_LOG_COLUMNS = "model_name string, snapshot_id string, load_dts timestamp_ntz, captures bigint"
# Files of a table beyond which ``compact`` rewrites it, per bucket (or in all without buckets).
FILES_PER_BUCKET = 8
# The claims of runs, beside the tables.
CLAIMS = "_runs"


class Warehouse:
    """Tables in namespaces of one catalog.

    A model that names a namespace goes there, one that names none to ``default_namespace``.

    ``catalog`` None means the session catalog. There a table is a view of its present generation, a file
    table of its own that is complete before the view turns to it: a reader finds the old rows or
    the new ones, never no table, and whatever stops a write leaves the old ones. The generation
    before stays for readers that have begun, until the next replacement. The captures are plain
    tables, as only partitions of them are ever replaced. Any other catalog is written through
    ``writeTo``, which makes replacing a table atomic where the table format supports it. ``buckets`` stores hubs and links bucketed by hash key: their keys are
    unique, so buckets are even, and the append filter and the point-in-time join then read them
    without an exchange. Satellites are not bucketed, as one key may have any number of versions.
    """

    def __init__(
        self,
        spark: SparkSession,
        table_format: str = "parquet",
        catalog: str | None = None,
        buckets: int | None = None,
        default_namespace: str = "silver",
    ) -> None:
        self.spark = spark
        self.table_format = table_format
        self.catalog = catalog
        self.buckets = None if catalog else buckets
        self.default_namespace = default_namespace

    def namespace(self, named: str | None) -> str:
        space = self.default_namespace if named is None else named.strip()
        return f"{self.catalog}.{space}" if self.catalog else space

    def name(self, namespace: str | None, table: str) -> str:
        return f"{self.namespace(namespace)}.{table}"

    def ensure_namespace(self, namespace: str | None) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.namespace(namespace)}")

    def guard(
        self, folder: str | None = None, renew_every: float = RENEW_EVERY, dead_after: float = DEAD_AFTER
    ) -> RunGuard:
        """What lets one run at a time into this warehouse; see :class:`RunGuard`."""
        root = folder or f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{CLAIMS}"
        return RunGuard(self.spark, root, renew_every, dead_after)

    def exists(self, namespace: str | None, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(namespace, table))

    def read(self, namespace: str | None, table: str) -> DataFrame:
        return self.spark.table(self.name(namespace, table))

    def read_if_exists(self, namespace: str | None, table: str) -> DataFrame | None:
        return self.read(namespace, table) if self.exists(namespace, table) else None

    def replace(self, namespace: str | None, table: str, df: DataFrame) -> int:
        """Create or replace a table; returns the rows written, counted during the write."""
        self.ensure_namespace(namespace)
        name = self.name(namespace, table)
        counted, rows = self._counted(df)
        if self.catalog:
            counted.writeTo(name).using(self.table_format).createOrReplace()
        else:
            fresh = _generation(name)
            counted.write.format(self.table_format).saveAsTable(fresh)
            self._turn(name, fresh)
        return rows()

    def append(
        self,
        namespace: str | None,
        table: str,
        df: DataFrame,
        bucket_key: str | None = None,
        partition_by: str | None = None,
    ) -> int:
        """Append rows, creating the table first if need be; returns the rows written."""
        self.ensure_namespace(namespace)
        name = self.name(namespace, table)
        created = self.exists(namespace, table)
        if created:
            df = _in_order(df, self.spark.table(name), name)
        if bucket_key and self.buckets:
            # One file per bucket: rows meet in the task that writes their bucket.
            df = df.repartition(self.buckets, bucket_key)
        counted, rows = self._counted(df)
        if self.catalog:
            if created:
                counted.writeTo(name).append()
            else:
                writer = counted.writeTo(name).using(self.table_format)
                if partition_by:
                    writer = writer.partitionedBy(F.col(partition_by))
                writer.create()
            return rows()
        # A table that is partitioned is never replaced as a whole.
        target = name if partition_by else self._stored(name) if created else _generation(name)
        writer = counted.write.format(self.table_format).mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if bucket_key and self.buckets:
            writer = writer.bucketBy(self.buckets, bucket_key)
        writer.saveAsTable(target)
        if not created and not partition_by:
            self._turn(name, target)
        return rows()

    def append_new(
        self,
        namespace: str | None,
        table: str,
        built: DataFrame,
        keys: Sequence[str],
        bucket_key: str | None = None,
        unique: bool = True,
    ) -> int:
        """Append the rows whose keys are not stored yet; repeating it appends nothing."""
        existing = self.read_if_exists(namespace, table)
        return self.append(namespace, table, new_rows(built, existing, keys, unique), bucket_key)

    def append_capture(
        self, table: str, source: DataFrame, capture_id: str, captured_at: datetime
    ) -> int | None:
        """Append one full capture of a source table, once per capture id, and log it.

        A capture counts as loaded when the load log says so, which is written last. Without that
        entry, rows an interrupted run may have left under the id are replaced, so an interrupted
        run can be repeated with its id. Returns None if the capture was loaded already.
        """
        written = self.store_capture(table, source, capture_id, captured_at)
        if written is not None:
            self.log_captures([(table, capture_id, captured_at, written)])
        return written

    def store_capture(
        self, table: str, source: DataFrame, capture_id: str, captured_at: datetime
    ) -> int | None:
        """The same without the entry in the log; several captures can be logged in one write."""
        if not CAPTURE_ID.fullmatch(capture_id):
            raise ValueError(f"capture id must consist of letters, digits and ._:-, not {capture_id!r}")
        if self._logged(table, capture_id):
            return None
        self.ensure_namespace(HISTORY)
        name = self.name(HISTORY, table)
        stamped = stamp_capture(source, capture_id, captured_at)
        if not self.exists(HISTORY, table):
            return self.append(HISTORY, table, stamped, partition_by=SNAPSHOT_ID)
        counted, rows = self._counted(_in_order(stamped, self.spark.table(name), name))
        if self.catalog:
            counted.writeTo(name).overwrite(F.col(SNAPSHOT_ID) == capture_id)
        else:
            # Naming the partition limits the replacement to it, whatever the session settings,
            # and takes away files an interrupted write left there unregistered.
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {name} PARTITION ({SNAPSHOT_ID} = '{capture_id}') "
                "SELECT * FROM {rows}",
                rows=counted.drop(SNAPSHOT_ID),
            )
        return rows()

    def log_captures(self, entries: Sequence[tuple[str, str, datetime, int]]) -> None:
        """Enter stored captures: table, capture id, time, rows. From here on they count."""
        if entries:
            rows = self.spark.createDataFrame(list(entries), LOAD_LOG_COLUMNS).coalesce(1)
            self.append(HISTORY, LOAD_LOG, rows)

    def captures(self, table: str) -> DataFrame:
        """The captures of a source table that are logged and have rows."""
        return logged_captures(self.load_log(), table)

    def history(self, table: str, captures: DataFrame) -> DataFrame:
        """The rows of these captures, reading only their partitions."""
        return of_captures(self.read(HISTORY, table), captures)

    def progress(self, namespace: str, model: str) -> tuple[Moment, int] | None:
        """The capture up to which a model is complete, and the how manieth it was."""
        log = self.read_if_exists(namespace, RUN_LOG)
        if log is None:
            return None
        entries = log.filter(F.col("model_name") == model)
        last = entries.agg(F.max(F.struct("load_dts", "snapshot_id", "captures"))).first()[0]
        return None if last is None else (Moment(last["load_dts"], last["snapshot_id"]), last["captures"])

    def seen(self, namespace: str, model: str) -> DataFrame | None:
        """The captures a model has entered in the run log: snapshot_id."""
        log = self.read_if_exists(namespace, RUN_LOG)
        if log is None:
            return None
        return log.filter(F.col("model_name") == model).select("snapshot_id").distinct()

    def log_progress(self, namespace: str, entries: Sequence[tuple[str, Moment, int]]) -> None:
        """Enter captures that models have taken in, after their rows are stored; up to the last of
        them a model is complete, and that was the n-th of its table."""
        if entries:
            rows = [(model, last.snapshot_id, last.load_dts, number) for model, last, number in entries]
            frame = self.spark.createDataFrame(rows, RUN_LOG_COLUMNS).coalesce(1)
            self.append(namespace, RUN_LOG, frame)

    def compact(self, namespace: str | None, table: str, bucket_key: str | None = None) -> bool:
        """Rewrite a table that has gathered many files; whether it had.

        The rewritten copy becomes the present generation only when it is complete. A table of another
        catalog is left to that catalog's own means.
        """
        if self.catalog or not self.exists(namespace, table):
            return False
        buckets = self.buckets if bucket_key and self.buckets else None
        rows = self.read(namespace, table)
        if len(rows.inputFiles()) <= FILES_PER_BUCKET * (buckets or 1):
            return False
        name = self.name(namespace, table)
        fresh = _generation(name)
        if buckets:
            rows = rows.repartition(buckets, bucket_key)
            writer = rows.write.bucketBy(buckets, bucket_key)
        else:
            # As many files as their size asks for.
            writer = rows.hint("rebalance").write
        writer.format(self.table_format).saveAsTable(fresh)
        self._turn(name, fresh)
        return True

    def _stored(self, name: str) -> str:
        """The file table a name stands for: its present generation, or itself."""
        for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
            if row["col_name"] == "View Text":
                return row["data_type"].removeprefix(_VIEW)
        return name

    def _turn(self, name: str, fresh: str) -> None:
        """Let a name stand for a complete generation, in one step of the catalog; older ones than the
        one before go, among them such as an interrupted run left."""
        before = None
        if self.spark.catalog.tableExists(name):
            before = self._stored(name)
            if before == name:
                # A plain table, from before there were generations.
                before = _generation(name)
                self.spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        # CREATE OR REPLACE would drop the view first.
        turn = "ALTER" if self.spark.catalog.tableExists(name) else "CREATE"
        self.spark.sql(f"{turn} VIEW {name} AS {_VIEW}{fresh}")
        space, _, table = name.rpartition(".")
        for row in self.spark.sql(f"SHOW TABLES IN {space} LIKE '{table}{_MARK}*'").collect():
            found = f"{space}.{row['tableName']}"
            if found not in (fresh, before):
                self.spark.sql(f"DROP TABLE IF EXISTS {found}")

    def is_latest(self, captured_at: datetime) -> bool:
        """Whether a capture at this time comes after every logged one."""
        log = self.read_if_exists(HISTORY, LOAD_LOG)
        if log is None:
            return True
        return log.filter(F.col("snapshot_at") >= wall_clock(captured_at)).isEmpty()

    def load_log(self) -> DataFrame:
        return self.read(HISTORY, LOAD_LOG)

    def _logged(self, table: str, capture_id: str) -> bool:
        log = self.read_if_exists(HISTORY, LOAD_LOG)
        if log is None:
            return False
        matching = (F.col("table_name") == table) & (F.col("snapshot_id") == capture_id)
        return not log.filter(matching).isEmpty()

    def _counted(self, df: DataFrame):
        """``df`` with its rows counted as they are written, instead of by a second read."""
        observation = Observation()
        counted = df.observe(observation, F.count(F.lit(1)).alias("rows"))
        return counted, lambda: observation.get["rows"]


_MARK = "__g_"
_VIEW = "SELECT * FROM "


def _generation(name: str) -> str:
    """A name no other generation has, not even one an interrupted run left files of."""
    return f"{name}{_MARK}{uuid.uuid4().hex}"


def _in_order(df: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """``df`` in the target's column order; a changed set of columns or types is refused."""
    have = {field.name: field.dataType for field in df.schema.fields}
    want = {field.name: field.dataType for field in target.schema.fields}
    if have != want:
        changed = sorted(
            column for column in have.keys() | want.keys() if have.get(column) != want.get(column)
        )
        raise ValueError(f"{name}: columns differ from the stored table: {changed}")
    return df.select(*target.columns)
