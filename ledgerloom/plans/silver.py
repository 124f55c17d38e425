"""Current-state tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerloom.operators.keyed import with_values

# Pinned: a new source column must not widen the reporting input; the destination is left to the vault.
TRANSACTION_COLUMNS = [
    "transaction_id",
    "customer_id",
    "account_id",
    "gl_account_code",
    "transaction_type",
    "amount",
    "currency",
    "status",
    "booking_date",
    "created_at",
    "_source_system",
    "_ingested_at",
]


def pass_through(current: DataFrame) -> DataFrame:
    return current


def silver_transactions(current: DataFrame) -> DataFrame:
    return with_values(current, ["transaction_id"]).select(*TRANSACTION_COLUMNS)


# Model name -> (source table, builder).
SILVER: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "silver_customers": ("customers", pass_through),
    "silver_accounts": ("accounts", pass_through),
    "silver_gl_accounts": ("gl_accounts", pass_through),
    "silver_transactions": ("transactions", silver_transactions),
}
