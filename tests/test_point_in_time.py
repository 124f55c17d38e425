from __future__ import annotations

import random
import time
from datetime import timedelta

import pytest
from helpers import DAY, account, account_history, bag, kept, load_duck, random_accounts, same
from pyspark.sql import functions as F

from ledgerloom.operators.captures import Moment, capture_list
from ledgerloom.operators.keyed import build_hub
from ledgerloom.operators.point_in_time import (
    as_of,
    as_of_join,
    build_pit,
    build_pit_pruned,
    pit_increment,
)
from ledgerloom.operators.satellite import build_satellite
from ledgerloom.plans.models import ACCOUNT, ACCOUNT_DETAILS, POINTS_IN_TIME
from oracle import sql

PIT = POINTS_IN_TIME["pit_account"]


def parts(spark, rows):
    history = account_history(spark, rows)
    current = history.filter("account_id not like '%3%'").withColumn(
        "_ingested_at", F.col("_snapshot_at")
    )
    return (
        kept(build_hub(current, ACCOUNT)),
        kept(build_satellite(history, ACCOUNT_DETAILS)),
        capture_list(history),
    )


def literal(duck, hub, satellite, captures):
    load_duck(duck, "hub", hub)
    load_duck(duck, "sat", satellite)
    load_duck(duck, "runs", captures.withColumnRenamed("load_dts", "snapshot_at"))
    return sql.pit("pit_account", "select * from hub", "select * from sat", "select * from runs")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("build", [build_pit, build_pit_pruned])
def test_random_history(spark, duck, seed, build):
    hub, satellite, captures = parts(spark, random_accounts(seed, crowded=seed % 2 == 1))
    expected = literal(duck, hub, satellite, captures)
    same(build(hub, satellite, captures, PIT), duck, expected)


@pytest.mark.parametrize("seed", range(3))
def test_removed_captures(spark, duck, seed):
    hub, satellite, captures = parts(spark, random_accounts(seed))
    kept = captures.filter(~F.col("snapshot_id").isin("s0", "s3", "s5"))
    expected = literal(duck, hub, satellite, kept)
    same(build_pit_pruned(hub, satellite, kept, PIT), duck, expected)


@pytest.mark.parametrize("seed", range(2))
def test_lookup(spark, duck, seed):
    hub, satellite, captures = parts(spark, random_accounts(seed))
    pit = kept(build_pit(hub, satellite, captures, PIT))
    pit_sql = load_duck(duck, "pit", pit)
    satellite_sql = load_duck(duck, "sat", satellite)
    for day in (-1, 0, 2, 3.5, 100):
        moment = DAY + timedelta(days=day)
        literal_sql = sql.as_of("pit_account", pit_sql, satellite_sql, f"timestamp '{moment}'")
        # Several versions at one time: SQL takes any of the greatest capture, so compare the rest.
        same(
            as_of(pit, satellite, moment, PIT).drop("status", "iban"),
            duck,
            f"select * exclude (status, iban) from ({literal_sql}) as found",
        )


def test_active_then_inactive(spark):
    rows = [account("A1", f"s{i}", i, status=s) for i, s in enumerate("AABBB")]
    hub, satellite, captures = parts(spark, rows)
    pit = build_pit(hub, satellite, captures, PIT)
    assert [r["snapshot_id"] for r in pit.orderBy("snapshot_at").collect()] == ["s0", "s2"]
    before = as_of(pit, satellite, DAY + timedelta(days=1), PIT).collect()
    after = as_of(pit, satellite, DAY + timedelta(days=4), PIT).collect()
    assert (before[0]["status"], after[0]["status"]) == ("A", "B")


def test_key_without_version(spark):
    hub, satellite, captures = parts(spark, [account("A1", "s0", 0)])
    other = hub.withColumn("account_hk", F.lit("none"))
    assert build_pit(other, satellite, captures, PIT).isEmpty()
    assert build_pit_pruned(other, satellite, captures, PIT).isEmpty()


def test_many_captures(spark):
    """The list of captures is gone through once: a hundred thousand take seconds, not minutes."""
    captures = spark.range(100_000).select(
        F.format_string("s%06d", "id").alias("snapshot_id"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_interval(mins=F.col("id"))).alias("load_dts"),
    )
    hub = spark.sql("select 'h' as account_hk, 'A1' as account_id")
    satellite = captures.filter("snapshot_id like '%77'").select(
        F.lit("h").alias("account_hk"), "load_dts"
    )
    removed = captures.filter("snapshot_id not like '%77'")
    started = time.monotonic()
    found = build_pit_pruned(hub, satellite, removed, PIT)
    assert found.filter("snapshot_id not like '%78'").isEmpty()
    assert found.count() == 1_000
    assert time.monotonic() - started < 30


def in_order(captures):
    return sorted((r["load_dts"], r["snapshot_id"]) for r in captures.collect())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("removed", [[], ["s0", "s3"]])
def test_pointers_appended_run_by_run(spark, seed, removed):
    """Captures one after another, keys that enter the hub late, and an append that is repeated."""
    hub, satellite, captures = parts(spark, random_accounts(seed, crowded=seed % 2 == 1))
    captures = kept(captures.filter(~F.col("snapshot_id").isin(removed)))
    ordered = in_order(captures)
    late = F.crc32("account_id") % 3 == 0
    stored = kept(build_pit_pruned(hub.filter(~late), satellite.limit(0), captures.limit(0), PIT))
    last = None
    for number, (at, name) in enumerate(ordered):
        moment = Moment(at, name)
        past = ~moment.before(F.col("load_dts"), F.col("snapshot_id"))
        # A capture that was removed may share its time with one that was not.
        known, versions = captures.filter(past), satellite.filter(F.col("load_dts") <= moment.at_literal)
        seen = hub if number > 3 else hub.filter(~late)
        if last is None or last.load_dts == at:
            stored = kept(build_pit_pruned(seen, versions, known, PIT))
        else:
            for _ in range(2):
                fresh = pit_increment(seen, versions, known, stored, PIT, last)
                stored = kept(stored.unionByName(fresh))
        last = moment
        assert bag(stored) == bag(build_pit_pruned(seen, versions, known, PIT))


def test_increment_filters_versions_at_the_scan(spark, tmp_path):
    hub, satellite, captures = parts(spark, random_accounts(1))
    satellite.write.parquet(str(tmp_path / "satellite"))
    stored = kept(build_pit_pruned(hub, satellite, captures, PIT))
    at, name = in_order(captures)[-2]
    fresh = pit_increment(hub, spark.read.parquet(str(tmp_path / "satellite")), captures, stored, PIT, Moment(at, name))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(load_dts" in plan


def plain_states(facts, pit, satellite):
    versions = {}
    for row in satellite:
        key = (row["account_hk"], row["load_dts"])
        taken = (row["snapshot_id"], *[row[a] for a in ACCOUNT_DETAILS.attribute_names])
        if key not in versions or versions[key][0] < taken[0]:
            versions[key] = taken
    found = []
    for fact in facts:
        before = [p for p in pit if p["account_hk"] == fact[1] and fact[2] is not None and p["snapshot_at"] <= fact[2]]
        if before:
            p = max(before, key=lambda p: p["snapshot_at"])
            state = (*versions[p["account_hk"], p["sat_account_load_dts"]][1:], p["snapshot_id"], p["snapshot_at"], p["sat_account_load_dts"])
        found.append((*fact, state if before else None))
    return sorted(found, key=repr)


FACTS = "n int, account_hk string, at timestamp_ntz, status string, _day string, _state string"


@pytest.mark.parametrize("seed", range(3))
def test_facts_with_their_state(spark, seed):
    """Facts at midnight, within a day, before all captures, without key or time, a third of one key; their
    columns may be named like those of the state."""
    hub, satellite, captures = parts(spark, random_accounts(seed))
    # Some captures within a day, so that several pointers fall on one.
    hours = F.expr("make_interval(0, 0, 0, 0, pmod(crc32(snapshot_id), 3) * 5)")
    captures = captures.withColumn("load_dts", F.col("load_dts") + hours)
    satellite = kept(satellite.withColumn("load_dts", F.col("load_dts") + hours))
    pit = kept(build_pit_pruned(hub, satellite, captures, PIT))
    keys = [row["account_hk"] for row in hub.collect()]
    rng = random.Random(seed)
    facts = []
    for n in range(400):
        key = keys[0] if n % 3 == 0 else rng.choice([*keys, "unknown", None])
        at = None if rng.random() < 0.05 else DAY + timedelta(hours=rng.randrange(-48, 360))
        facts.append((n, key, at, "own", "d", "s"))
    found = as_of_join(spark.createDataFrame(facts, FACTS), pit, satellite, PIT, "at")
    assert found.columns == [*[f.split()[0] for f in FACTS.split(", ")], "sat_account_details"]
    rows = sorted(((*r[:6], r[6] and tuple(r[6])) for r in found.collect()), key=repr)
    # The first version of a capture that has several is any of them, see test_lookup.
    assert rows == plain_states(facts, pit.collect(), satellite.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert as_of_join(spark.createDataFrame([], FACTS), pit, satellite, PIT, "at").isEmpty()
    assert as_of_join(spark.createDataFrame(facts, FACTS), pit.limit(0), satellite, PIT, "at").count() == 400
