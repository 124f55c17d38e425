"""Banking tables and their captures derived from a directory of order and customer tables.

The numbers below say how the simulated bank changes from capture to capture, so that every kind of
change is met: late arrival, absence and return, deletion, flips there and back, nulls that become
values, new owners. They select what changes, not what is read: all rows of the input take part.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.stamping import stamp_current, wall_clock
from ledgerloom.sources.tables import (
    INGESTED_AT as INGESTED_AT_COLUMN,
)
from ledgerloom.sources.tables import (
    SNAPSHOT_AT,
    SNAPSHOT_ID,
    SOURCE_COLUMN,
    SOURCE_SYSTEM,
    SOURCE_TABLES,
)

CAPTURES = 4
FIRST_CAPTURE = datetime(2026, 9, 27)
INGESTED_AT = datetime(2026, 9, 27)
EARLIER_INGESTED_AT = datetime(2026, 9, 26)
# Part of a current copy arrives with a second load.
SECOND_LOAD_AT = datetime(2026, 9, 27, 6)

# Integer key a table's rows derive from; kept until the change rules are applied.
ROW = "_n"
NUMBER = "_k"
# Whether a row's key is one that has left the source since.
GONE = "_gone"
# Captures that still have such keys.
GONE_AFTER = 2
KEYS = {"customers": "customer_id", "accounts": "account_id"}
# Tables whose rows a history multiplies, and the key by which they are dealt out before.
DEALT = {"customer": "c_custkey", "orders": "o_orderkey"}

Read = Callable[[str], DataFrame]


class SampleBank:
    """Source tables, current copies and captures over the Parquet files in one directory."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        """A source table as it is now."""
        return self._base(name).drop(ROW)

    def current(self, name: str) -> DataFrame:
        """The current copy: every row of the source, some of them from a second load."""
        return self._current(name, self._base(name), INGESTED_AT, SECOND_LOAD_AT)

    def earlier_current(self, name: str) -> DataFrame:
        """The current copy of the day before, without the rows that arrive late."""
        base = self._base(name)
        if name != "gl_accounts":
            base = base.filter(F.col(ROW) % 5 != 0)
        return self._current(name, base, EARLIER_INGESTED_AT, EARLIER_INGESTED_AT)

    def load_log(self) -> DataFrame:
        """What the loads of all captures would have logged."""
        counted = [
            self.history(name)
            .groupBy(F.col(SNAPSHOT_ID).alias("snapshot_id"), F.col(SNAPSHOT_AT).alias("snapshot_at"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("table_name", F.lit(name))
            for name in SOURCE_TABLES
        ]
        return reduce(DataFrame.unionByName, counted)

    def capture(self, name: str, number: int) -> DataFrame:
        """The source table as it was at one capture."""
        return self._states(name, [number]).drop(ROW, NUMBER, GONE)

    def history(self, name: str, first: int = 1, last: int = CAPTURES) -> DataFrame:
        """Stamped captures ``first`` to ``last`` of a table."""
        stamps = {
            SOURCE_COLUMN: F.lit(SOURCE_SYSTEM),
            SNAPSHOT_ID: F.concat(F.lit("cap-"), F.col(NUMBER).cast("string")),
            SNAPSHOT_AT: F.element_at(
                F.array(*[wall_clock(capture_time(k)) for k in range(1, CAPTURES + 1)]),
                F.col(NUMBER),
            ),
        }
        states = self._states(name, list(range(first, last + 1)))
        return states.withColumns(stamps).drop(ROW, NUMBER, GONE)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def _dealt(self, name: str) -> DataFrame:
        """The rows of one file, dealt out to as many tasks as an exchange has.

        A history makes several rows of each, up to some ten times as many. A task that scans a file, or a
        split of one, would hold them all at once.
        """
        rows = self._read(name)
        if name not in DEALT:
            return rows
        return rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), DEALT[name])

    def _base(self, name: str, read: Read | None = None) -> DataFrame:
        columns = [field.name for field in SOURCE_TABLES[name].schema.fields]
        return getattr(self, f"_{name}")(read or self._read).select(ROW, *columns)

    def _current(
        self, name: str, base: DataFrame, first: datetime, second: datetime
    ) -> DataFrame:
        stamped = stamp_current(base, first)
        at = F.when(F.col(ROW) % 3 == 0, wall_clock(second)).otherwise(F.col(INGESTED_AT_COLUMN))
        return stamped.withColumn(INGESTED_AT_COLUMN, at).drop(ROW)

    def _states(self, name: str, numbers: list[int]) -> DataFrame:
        n, k = F.col(ROW), F.col(NUMBER)
        base = self._base(name, self._dealt).withColumn(GONE, F.lit(False))
        if name in KEYS:
            # Captures have keys which the current copy no longer has.
            gone = base.filter(n % 37 == 0).withColumns(
                {KEYS[name]: F.concat(F.trim(KEYS[name]), F.lit("-gone")), GONE: F.lit(True)}
            )
            base = base.unionByName(gone)
        states = base.withColumn(
            NUMBER, F.explode(F.array(*[F.lit(number) for number in numbers]))
        ).filter(~F.col(GONE) | (k <= GONE_AFTER))
        if name != "gl_accounts":
            states = states.filter(~((n % 5 == 0) & (k == 1)))
        if name == "accounts":
            states = states.filter(~((n % 11 == 0) & (k == 3)) & ~((n % 13 == 0) & (k == 4)))
        return states.withColumns(_changes(name, n, k))

    def _customers(self, read: Read) -> DataFrame:
        n = F.col("c_custkey")
        plain = F.concat(F.lit("C"), n.cast("string"))
        padded = F.concat(F.lit("  "), plain, F.lit(" "))
        return read("customer").select(
            n.alias(ROW),
            F.when(n % 10 == 0, padded).otherwise(plain).alias("customer_id"),
            F.when(n % 23 != 0, F.col("c_mktsegment")).alias("first_name"),
            F.when(n % 29 != 0, F.col("c_name")).alias("last_name"),
            wall_clock(datetime(2023, 1, 1, 8, 30)).alias("created_at"),
        )

    def _accounts(self, read: Read) -> DataFrame:
        """One account per customer, a second one for some; some are there twice, padded."""
        n = F.col("c_custkey")
        text = n.cast("string")
        plain = F.concat(F.lit("A"), text)
        ids = F.array_compact(
            F.array(
                plain,
                F.when(n % 3 == 0, F.concat(F.lit("B"), text)),
                F.when(n % 12 == 0, F.concat(F.lit(" "), plain, F.lit("  "))),
            )
        )
        return read("customer").withColumn("account_id", F.explode(ids)).select(
            n.alias(ROW),
            "account_id",
            F.concat(F.lit("C"), text).alias("customer_id"),
            F.concat(F.lit("DE"), F.lpad(text, 10, "0")).alias("iban"),
            F.when(n % 20 == 0, "USD").otherwise("EUR").alias("currency"),
            F.lit("ACTIVE").alias("status"),
            F.date_add(F.lit("2023-01-01").cast("date"), (n % 1000).cast("int")).alias("opened_at"),
        )

    def _gl_accounts(self, read: Read) -> DataFrame:
        n, region = F.col("n_nationkey"), F.col("n_regionkey")
        category = (
            F.when(region == 0, "ASSET")
            .when(region == 1, "LIABILITY")
            .when(region == 2, "INCOME")
            .otherwise("EXPENSE")
        )
        return read("nation").select(
            n.alias(ROW),
            (n + 1000).cast("string").alias("gl_account_code"),
            F.col("n_name").alias("account_name"),
            category.alias("account_category"),
            (n % 6 != 0).alias("is_active"),
        )

    def _transactions(self, read: Read) -> DataFrame:
        n, owner = F.col("o_orderkey"), F.col("o_custkey")
        destination = (
            F.when(n % 4 == 0, F.concat(F.lit("A"), ((owner + 1) % 150).cast("string")))
            .when(n % 4 == 1, "")
            .when(n % 4 == 3, "   ")
        )
        return read("orders").select(
            n.alias(ROW),
            F.concat(F.lit("T"), n.cast("string")).alias("transaction_id"),
            F.when(owner % 97 != 0, F.concat(F.lit("C"), owner.cast("string"))).alias(
                "customer_id"
            ),
            F.concat(F.lit("A"), owner.cast("string")).alias("account_id"),
            destination.alias("destination_account_id"),
            F.when(n % 9 != 0, (n % 27 + 1000).cast("string")).alias("gl_account_code"),
            F.col("o_orderpriority").alias("transaction_type"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.when(n % 50 == 0, "USD").otherwise("EUR").alias("currency"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").cast("date").alias("booking_date"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        )

    def _journal_entries(self, read: Read) -> DataFrame:
        n = F.col("o_orderkey")
        text = n.cast("string")
        return read("orders").select(
            n.alias(ROW),
            F.concat(F.lit("J"), text).alias("journal_entry_id"),
            F.when(n % 31 != 0, F.concat(F.lit("T"), text)).alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("posting_date"),
            F.when(F.col("o_orderstatus") == "F", "POSTED").otherwise("DRAFT").alias("status"),
        )

    def _journal_postings(self, read: Read) -> DataFrame:
        """Two postings per order, some of them delivered more than once: as often as the order has
        lines."""
        n, side = F.col("o_orderkey"), F.col("side")
        text = n.cast("string")
        amount = F.col("o_totalprice").cast("decimal(18,2)")
        code = (n + F.when(side == "D", 0).otherwise(1)) % 25 + 1000
        return (
            self._delivered(read)
            .withColumn("side", F.explode(F.array(F.lit("D"), F.lit("C"))))
            .select(
                n.alias(ROW),
                F.concat(F.lit("P"), text, F.lit("-"), side).alias("posting_id"),
                F.concat(F.lit("J"), text).alias("journal_entry_id"),
                F.when(side == "D", F.concat(F.lit("A"), F.col("o_custkey").cast("string"))).alias(
                    "account_id"
                ),
                F.when(n % 41 != 0, code.cast("string")).alias("gl_account_code"),
                F.when(side == "D", amount).alias("debit_amount"),
                F.when(side == "C", amount).alias("credit_amount"),
            )
        )

    def _delivered(self, read: Read) -> DataFrame:
        """Orders, every seventh once per line item, but at least once."""
        orders, lines = read("orders"), self._read("lineitem").select("l_orderkey")
        same = F.col("o_orderkey") == F.col("l_orderkey")
        again = orders.join(lines, same, "left").drop("l_orderkey")
        seventh = F.col("o_orderkey") % 7 == 0
        return orders.filter(~seventh).unionByName(again.filter(seventh))


def capture_time(number: int) -> datetime:
    return FIRST_CAPTURE + timedelta(days=number - 1)


def _changes(name: str, n: Column, k: Column) -> dict[str, Column]:
    """Columns of a source table that differ from its present state at capture ``k``."""
    if name == "accounts":
        inactive = (n % 7 == 0) & (k >= 2) & ~((n % 14 == 0) & (k == 4))
        before = F.concat(F.lit("C"), F.greatest(n - 1, F.lit(0)).cast("string"))
        return {
            "status": F.when(inactive, "INACTIVE").otherwise(F.col("status")),
            "iban": F.when(~((n % 19 == 0) & (k == 1)), F.col("iban")),
            "customer_id": F.when((n % 17 == 0) & (k >= 3), before).otherwise(
                F.col("customer_id")
            ),
        }
    if name == "customers":
        changed = (n % 8 == 0) & (k == 2)
        return {"first_name": F.when(changed, "CHANGED").otherwise(F.col("first_name"))}
    if name == "gl_accounts":
        flipped = (n % 4 == 0) & (k >= 3)
        return {"is_active": F.col("is_active") != flipped}
    if name == "transactions":
        reversed_ = (n % 7 == 0) & (k >= 2)
        return {"status": F.when(reversed_, "REVERSED").otherwise(F.col("status"))}
    if name == "journal_entries":
        posted = (n % 2 == 0) & (k >= 3) & (F.col("status") == "DRAFT")
        return {"status": F.when(posted, "POSTED").otherwise(F.col("status"))}
    raised = F.when((n % 43 == 0) & (k >= 2), 1).otherwise(0).cast("decimal(18,2)")
    return {
        side: (F.col(side) + raised).cast("decimal(18,2)")
        for side in ("debit_amount", "credit_amount")
    }
