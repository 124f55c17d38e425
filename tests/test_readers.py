"""JDBC options. No database is started here; the reader itself is Spark's."""

from __future__ import annotations

import pytest

from ledgerloom.sources.readers import JdbcSource, Split
from ledgerloom.sources.tables import SOURCE_TABLES, check_columns


def test_plain_options(monkeypatch):
    monkeypatch.setenv("PGUSER", "reader")
    monkeypatch.setenv("PGPASSWORD", "secret")
    options = JdbcSource("jdbc:postgresql://host/db").options("accounts")
    assert options["dbtable"] == "source.accounts"
    assert (options["user"], options["password"]) == ("reader", "secret")
    assert options["driver"] == "org.postgresql.Driver"
    assert options["preferTimestampNTZ"] == "true"
    assert "numPartitions" not in options


def test_split_by_column():
    source = JdbcSource(
        "jdbc:x", user="u", password="p", schema="",
        splits={"transactions": Split("created_at", "2020-01-01", "2026-01-01", 200)},
    )
    options = source.options("transactions")
    assert options["dbtable"] == "transactions"
    assert options["partitionColumn"] == "created_at"
    assert (options["lowerBound"], options["upperBound"]) == ("2020-01-01", "2026-01-01")
    assert options["numPartitions"] == "200"
    assert "partitionColumn" not in source.options("accounts")


def test_split_by_predicates_reads_one_partition_each():
    calls = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            calls.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    parts = tuple(f"mod(abs(hashtext(account_id)), 3) = {i}" for i in range(3))
    source = JdbcSource("jdbc:x", user="u", password="p", splits={"accounts": Split(predicates=parts)})
    source.reader(Session())("accounts")
    assert calls["predicates"] == list(parts)
    assert calls["table"] == "source.accounts"
    assert "url" not in calls["properties"] and "dbtable" not in calls["properties"]


@pytest.mark.parametrize(
    "wrong",
    [
        {"column": "a"},
        {"column": "a", "lower": 0, "upper": 1, "predicates": ("x",)},
        {"column": "a", "lower": 0, "upper": 1, "partitions": 0},
    ],
)
def test_half_given_split(wrong):
    with pytest.raises(ValueError):
        Split(**wrong)


def test_columns_are_checked(spark):
    table = SOURCE_TABLES["gl_accounts"]
    good = spark.createDataFrame([], table.schema).selectExpr("*", "1 as more")
    assert check_columns(good, table) is good
    with pytest.raises(ValueError, match="is_active is string, expected boolean"):
        check_columns(good.withColumn("is_active", good["is_active"].cast("string")), table)
