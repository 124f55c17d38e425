"""Runs that meet: one is refused, a dead one is taken over, and nothing is stored twice."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from helpers import account
from test_warehouse import SPACES, bank_of_accounts

from ledgerloom.plans.run import run_all
from ledgerloom.sources.guard import RunGuard, RunLost, RunRefused
from ledgerloom.sources.warehouse import Warehouse


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/claims"


def test_one_of_many_claims(spark, folder):
    """However many begin at once, each number goes to one of them."""
    def claim(_):
        try:
            return RunGuard(spark, folder).claim()
        except RunRefused:
            return None

    for number in range(1, 4):
        with ThreadPoolExecutor(8) as pool:
            got = [one for one in pool.map(claim, range(8)) if one]
        assert [one.number for one in got] == [number]
        RunGuard(spark, folder).end(got[0])


def test_refused_until_ended(spark, folder):
    guard = RunGuard(spark, folder)
    with guard.run("first"):
        with pytest.raises(RunRefused, match="first"):
            RunGuard(spark, folder).claim()
    with pytest.raises(KeyError), guard.run("fails"):
        raise KeyError
    assert guard.claim().number == 3


def test_a_dead_run_is_taken_over(spark, folder):
    dead = RunGuard(spark, folder, 0.05, 0.4)
    lost = dead.claim()
    time.sleep(0.1)
    dead.renew(lost)
    with pytest.raises(RunRefused):
        dead.claim()
    time.sleep(0.6)
    assert dead.claim().number == 2
    for step in (dead.check, dead.renew):
        with pytest.raises(RunLost):
            step(lost)


def test_a_live_run_renews_itself(spark, folder):
    guard = RunGuard(spark, folder, 0.05, 1.0)
    with guard.run():
        time.sleep(1.5)
        with pytest.raises(RunRefused):
            guard.claim()


def test_two_runs_at_once_store_nothing_twice(spark, tmp_path):
    for space in SPACES:
        spark.sql(f"DROP DATABASE IF EXISTS {space} CASCADE")
    warehouse, folder = Warehouse(spark), f"file://{tmp_path}/claims"
    source = bank_of_accounts(spark, [account(f"A{i}", "x", 0) for i in range(7)])
    both = threading.Barrier(2)

    def run(number):
        both.wait()
        try:
            return run_all(warehouse, source, datetime(2026, 1, number), f"c{number}", guard=warehouse.guard(folder))
        except RunRefused:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(run, (1, 2)))
    assert sum(one is not None for one in done) == 1
    assert warehouse.read("raw_vault", "hub_account").count() == 7
    assert warehouse.read("raw_vault", "sat_account_details").count() == 7
    # The refused one comes later, and finds nothing new.
    again = run_all(warehouse, source, datetime(2026, 1, 3), "c3", guard=warehouse.guard(folder))
    assert again["vault"]["hub_account"] == again["vault"]["sat_account_details"] == 0
    for space in SPACES:
        spark.sql(f"DROP DATABASE IF EXISTS {space} CASCADE")


def test_a_run_taken_for_dead_stops_at_its_next_step(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark)
    guard = warehouse.guard(f"file://{tmp_path}/claims", 0.1, 0.3)
    monkeypatch.setattr(guard, "renew", lambda claim: None)
    monkeypatch.setattr("ledgerloom.plans.run.load_current", lambda *_: [time.sleep(0.6), guard.claim()])
    with pytest.raises(RunLost):
        run_all(warehouse, lambda name: None, datetime(2026, 1, 1), "c1", guard=guard)
