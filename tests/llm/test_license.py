from __future__ import annotations

import random
import re
import time

import pytest
from cases import documents, empty_documents, odd_documents
from pyspark.sql import functions as F

from ledgerloom.llm import license
from ledgerloom.llm.queries import QUERIES


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_base(words):
    return sorted(
        (i, label)
        for phrase, label in license.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )


def plain_detections(words):
    """All matches of all rules, each compared with each."""
    line = f" {' '.join(words)} "
    found = []
    for rule in license.RULES:
        for match in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", line):
            start = line.count(" ", 0, match.start()) - 1
            found.append((start, start + match[0].count(" ") + 1, rule))
    kept = []
    for start, end, rule in found:
        def beats(other):
            s, e, r = other
            if not (s <= start and end <= e and r.priority >= rule.priority) or r is rule and (s, e) == (start, end):
                return False
            return (s, e) != (start, end) or r.priority > rule.priority or r.name < rule.name
        if not any(beats(other) for other in found):
            kept.append((start, end, rule.name))
    return sorted(kept)


def texts(rng, count):
    families = ["MIT License", "Apache License, Version 2.0", "GNU General Public License, version 3", "BSD 3-Clause",
                "GNU GPL v2 or later", "CC BY-SA 4.0", "SPDX-License-Identifier: Apache-2.0", "Mozilla Public License 2.0",
                "all rights reserved", "redistribution and use in source and binary forms", "GNU Lesser General Public License 2.1",
                "http://www.apache.org/licenses/LICENSE-2.0", "This is free software", "mit", "License", "general public"]
    grants = ["Licensed under the ", "Released under the terms of the ", "", "see ", "über ", "the "]
    return [
        " ".join(rng.choice(grants) + rng.choice(families) + rng.choice(["", ".", ",", "\n"]) for _ in range(rng.randrange(1, 9)))
        for _ in range(count)
    ]


def test_rules_are_sound():
    assert 250 <= len(license.RULES) <= 600
    for rule in license.RULES:
        assert rule.keyword == rule.keyword.lower() and 0 <= rule.priority < license.PRIORITIES
        re.compile(rule.pattern)


def test_gate_lets_every_rule_through():
    """A word of the gate is in the keyword, or in what is left of the pattern without optional parts."""
    for rule in license.RULES:
        left, before = rule.pattern.replace("licen[sc]e", "license"), None
        while left != before:
            before, left = left, re.sub(r"\(\?:[^()]*\)\?", "", left)
        assert re.search(license.GATE, rule.keyword) or re.search(license.GATE, left), rule


@pytest.mark.parametrize(
    "text, label",
    [
        ("Neither the name of the holder may be used to endorse or promote products derived from it.", "bsd-3-clause"),
        (f"Neither the name of {'the Very Long ' * 40} Foundation nor the names of its contributors may be used to "
         "endorse or promote products derived from this software", "bsd-3-clause"),
        ("This program is free software; either version 2 of the License, or (at your option) any later version.", "gpl"),
        ("Altered source versions must be plainly marked as such", "zlib"),
        ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
        ("Redistributions of source code must retain the above copyright notice", "bsd"),
    ],
)
def test_notices(spark, text, label):
    row = license.scan(documents(spark, [text])).select("detections.label").first()
    assert label in row[0]


def test_matches_brute_force(spark):
    frame = documents(spark, texts(random.Random(4), 400))
    for row in license.scan(frame).collect():
        words = words_of(row["text"])
        assert row["n_words"] == len(words)
        assert sorted((b["start"], b["label"]) for b in row["base"]) == plain_base(words)
        assert sorted((d["start"], d["end"], d["rule"]) for d in row["detections"]) == plain_detections(words), row["text"]


def test_odd_rows(spark):
    frame = odd_documents(spark)
    found = license.scan(frame)
    for row in found.collect():
        assert row["n_words"] == len(words_of(row["text"])) and row["base"] == [] and row["detections"] == []
    assert found.count() == frame.count()
    assert license.scan(empty_documents(spark)).count() == 0


def test_very_many_places(spark):
    """Time grows with the places: their square would take ten minutes here."""
    began = time.monotonic()
    frame = documents(spark, ["MIT License and " * 64_000, "mit license " * 300])
    rows = license.scan(frame).select(F.size("base"), F.size("detections"), "n_words", F.element_at("base", -1)["start"]).collect()
    assert sorted(tuple(row) for row in rows) == [(300, 300, 600, 598), (64_000, 64_000, 192_000, 191_997)]
    assert time.monotonic() - began < 120


@pytest.mark.parametrize("native", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, data, native):
    plan = QUERIES["op9_license_scans"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert native not in plan


def test_query(spark, data):
    found = {r["doc_id"]: r for r in QUERIES["op9_license_scans"](spark, data).collect()}
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        row, words = found[doc_id], words_of(text)
        base = plain_base(words)
        starts = [start for start, _ in base]
        labels = {label for _, label in base}
        method = {rule.label for _, _, name in plain_detections(words) for rule in license.RULES if rule.name == name}
        assert (row["n_words"], row["n_base"]) == (len(words), len(base))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert row["labels"] == ",".join(sorted(labels | method))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(labels | method)
