"""Reporting tables over current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.keyed import with_values
from ledgerloom.operators.totals import COUNT, DayTotals
from ledgerloom.operators.totals import TOTAL as DAY_TOTAL

AMOUNT = "decimal(18,2)"
TOTAL = "decimal(28,2)"
TOP_CUSTOMERS = 20
TOP_CURRENCY = "EUR"
# What the two reports over transactions keep from run to run.
ACCOUNT_DAYS = DayTotals(
    "account_day_totals",
    ("account_id", "currency", "gl_account_code"),
    "booking_date",
    "amount",
    needed=("transaction_id",),
)
CUSTOMER_DAYS = DayTotals(
    "customer_day_totals", ("customer_id", "currency"), "booking_date", "amount", needed=("customer_id",)
)


def _full_name() -> Column:
    return F.concat_ws(" ", "first_name", "last_name").alias("customer_name")


def account_transaction_summary(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame, gl_accounts: DataFrame
) -> DataFrame:
    """Count and total per account, ledger code and currency; accounts without any are kept.

    Only transactions in the account's own currency count. They are totalled below the joins, so an
    account with very many of them enters a join as one row per ledger code; the second sum restores
    the result where a key occurs more than once in a lookup table.
    """
    return _account_report(accounts, customers, _account_totals(transactions), gl_accounts)


def account_summary_of_days(
    accounts: DataFrame, customers: DataFrame, kept: DataFrame, transactions: DataFrame, gl_accounts: DataFrame
) -> DataFrame:
    """The same from kept totals per day; only transactions without a day are read themselves."""
    undated = _account_totals(transactions.filter(F.col(ACCOUNT_DAYS.day).isNull()))
    dated = kept.groupBy(*ACCOUNT_DAYS.keys).agg(F.sum(COUNT).alias("_count"), F.sum(DAY_TOTAL).alias("_total"))
    return _account_report(accounts, customers, dated.unionByName(undated), gl_accounts)


def _account_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(*ACCOUNT_DAYS.keys).agg(
        F.count("transaction_id").alias("_count"), F.sum("amount").alias("_total")
    )


def _account_report(
    accounts: DataFrame, customers: DataFrame, totals: DataFrame, gl_accounts: DataFrame
) -> DataFrame:
    return (
        accounts.select("account_id", "customer_id", "currency")
        .join(customers.select("customer_id", "first_name", "last_name"), "customer_id", "left")
        .join(totals, ["account_id", "currency"], "left")
        .join(gl_accounts.select("gl_account_code", "account_name"), "gl_account_code", "left")
        .groupBy(
            "account_id",
            "customer_id",
            "first_name",
            "last_name",
            "gl_account_code",
            "account_name",
            "currency",
        )
        .agg(
            F.coalesce(F.sum("_count"), F.lit(0)).cast("long").alias("transaction_count"),
            F.coalesce(F.sum("_total"), F.lit(0).cast(AMOUNT))
            .cast(TOTAL)
            .alias("total_transaction_amount"),
        )
        .select(
            "account_id",
            "customer_id",
            _full_name(),
            "gl_account_code",
            F.col("account_name").alias("gl_account_name"),
            "currency",
            "transaction_count",
            "total_transaction_amount",
        )
    )


def customer_daily_transactions(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Count and total per customer, day and currency; the name is looked up on the totals."""
    daily = (
        with_values(transactions, ["customer_id", "booking_date"])
        .groupBy("customer_id", "booking_date", "currency")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").cast(TOTAL).alias("total_amount"),
        )
    )
    return _daily_report(daily, customers)


def customer_daily_of_days(kept: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from kept totals per day."""
    daily = kept.withColumnsRenamed({COUNT: "transaction_count", DAY_TOTAL: "total_amount"})
    return _daily_report(daily, customers)


def _daily_report(daily: DataFrame, customers: DataFrame) -> DataFrame:
    names = customers.select("customer_id", "first_name", "last_name")
    return daily.join(names, "customer_id", "left").select(
        "customer_id",
        _full_name(),
        "booking_date",
        "currency",
        "transaction_count",
        "total_amount",
    )


def top_customers(daily: DataFrame) -> DataFrame:
    """The customers with the highest totals, ranked without ties.

    The limit keeps the best rows of each partition, so only those reach the ranking window.
    """
    order = [F.desc("total_transaction_amount"), F.asc("customer_id"), F.asc("customer_name")]
    return (
        daily.filter(F.col("currency") == TOP_CURRENCY)
        .groupBy("customer_id", "customer_name", "currency")
        .agg(
            F.sum("transaction_count").alias("transaction_count"),
            F.sum("total_amount").cast(TOTAL).alias("total_transaction_amount"),
        )
        .orderBy(*order)
        .limit(TOP_CUSTOMERS)
        .withColumn("customer_rank", F.row_number().over(Window.orderBy(*order)))
    )
