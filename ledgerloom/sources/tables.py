"""The six source tables and the metadata columns a load adds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SOURCE_SYSTEM = "core_banking"

SOURCE_COLUMN = "_source_system"
INGESTED_AT = "_ingested_at"
SNAPSHOT_ID = "_snapshot_id"
SNAPSHOT_AT = "_snapshot_at"


@dataclass(frozen=True)
class SourceTable:
    """One source table: its name, its key column and the columns the models rely on."""

    name: str
    key: str
    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


SOURCE_TABLES = {
    table.name: table
    for table in (
        SourceTable(
            "customers",
            "customer_id",
            "customer_id string, first_name string, last_name string, created_at timestamp_ntz",
        ),
        SourceTable(
            "accounts",
            "account_id",
            "account_id string, customer_id string, iban string, currency string, status string, "
            "opened_at date",
        ),
        SourceTable(
            "transactions",
            "transaction_id",
            "transaction_id string, customer_id string, account_id string, "
            "destination_account_id string, gl_account_code string, transaction_type string, "
            "amount decimal(18,2), currency string, status string, booking_date date, "
            "created_at timestamp_ntz",
        ),
        SourceTable(
            "gl_accounts",
            "gl_account_code",
            "gl_account_code string, account_name string, account_category string, "
            "is_active boolean",
        ),
        SourceTable(
            "journal_entries",
            "journal_entry_id",
            "journal_entry_id string, transaction_id string, posting_date date, status string",
        ),
        SourceTable(
            "journal_postings",
            "posting_id",
            "posting_id string, journal_entry_id string, account_id string, "
            "gl_account_code string, debit_amount decimal(18,2), credit_amount decimal(18,2)",
        ),
    )
}


def check_columns(df: DataFrame, table: SourceTable) -> DataFrame:
    """Return ``df`` unchanged, or fail loudly if a column is missing or has another type.

    Further columns are let through: the current copy and its pass-through models carry them along.
    """
    found = {field.name: field.dataType for field in df.schema.fields}
    problems = []
    for field in table.schema.fields:
        if field.name not in found:
            problems.append(f"{field.name} is missing")
        elif not _compatible(found[field.name], field.dataType):
            problems.append(
                f"{field.name} is {found[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    if problems:
        raise ValueError(f"source table {table.name}: " + "; ".join(problems))
    return df


def _compatible(found: T.DataType, expected: T.DataType) -> bool:
    times = (T.TimestampType, T.TimestampNTZType)
    if isinstance(expected, times):
        return isinstance(found, times)
    if isinstance(expected, T.DecimalType):
        return isinstance(found, T.DecimalType)
    return found == expected
