"""Comparing results, and small made histories."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame

ACCOUNT_HISTORY = (
    "account_id string, customer_id string, iban string, currency string, status string, "
    "opened_at date, _source_system string, _snapshot_id string, _snapshot_at timestamp_ntz"
)
DAY = datetime(2026, 1, 1)


def bag(table) -> list[tuple]:
    """Rows of a DataFrame or an Arrow table, columns by name, in a fixed order."""
    arrow = table.toArrow() if isinstance(table, DataFrame) else table
    names = sorted(arrow.column_names)
    columns = [arrow.column(name).to_pylist() for name in names]
    return sorted((tuple(row) for row in zip(*columns)), key=repr)


def same(df: DataFrame, duck, sql: str) -> None:
    expected = duck.sql(sql).to_arrow_table()
    found = df.toArrow()
    assert sorted(found.column_names) == sorted(expected.column_names)
    assert bag(found) == bag(expected)


def account(key, capture, at, owner="C1", status="ACTIVE", iban="DE1", source="core_banking"):
    return (
        key,
        owner,
        iban,
        "EUR",
        status,
        date(2024, 1, 1),
        source,
        capture,
        DAY + timedelta(days=at),
    )


def account_history(spark, rows) -> DataFrame:
    """Made rows as a local relation, so that reading them needs no Python worker."""
    kinds = [pa.string()] * 5 + [pa.date32()] + [pa.string()] * 2 + [pa.timestamp("us")]
    names = [column.split()[0] for column in ACCOUNT_HISTORY.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names), ACCOUNT_HISTORY)


def random_accounts(seed: int, keys: int = 40, captures: int = 7, crowded: bool = False):
    """Rows with absences, flips, new owners, nulls, padded keys and captures of equal time.

    ``crowded`` lets one key occur many times per capture, with copies and with differences.
    """
    rng = random.Random(seed)
    rows, at = [], 0
    names = rng.sample([f"s{i}" for i in range(captures)], captures)
    for name in names:
        at += rng.choice([0, 1, 2])
        for key in range(keys):
            if rng.random() < 0.25:
                continue
            text = f"A{key}" if rng.random() < 0.8 else f" A{key} "
            owner = None if rng.random() < 0.1 else f"C{rng.randrange(3)}"
            status = rng.choice(["ACTIVE", "INACTIVE"])
            iban = rng.choice([None, "DE1", ""])
            rows.append(account(text, name, at, owner, status, iban))
        if crowded:
            for _ in range(60):
                iban = rng.choice([None, "", "X", "Y", "Z"])
                status = rng.choice([None, "ACTIVE", "INACTIVE"])
                rows.append(account("HOT", name, at, "C1", status, iban))
    return rows


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as they would be read back from a table."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def load_duck(duck, name: str, df: DataFrame) -> str:
    """Make rows available to DuckDB; returns SQL that reads them."""
    duck.register(f"{name}_arrow", df.toArrow())
    duck.execute(f"create or replace table {name} as select * from {name}_arrow")
    return f"select * from {name}"
