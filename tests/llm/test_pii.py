from __future__ import annotations

import hashlib
import random
import re

import pytest
from cases import documents, empty_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from ledgerloom.llm import pii
from ledgerloom.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    found = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": all(int(part) <= 255 for part in match[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, match.start(), match.end()))
    return found


def noise(rng):
    """Texts of the characters that matter to the patterns, in all orders."""
    bits = ["@", ".", "-", " ", "+", "1", "23", "a", "_", "%", "(", ")", "4111111111111111", "10.0.0.255", "é", "😀",
            "x@y.zz", "+1 (555) 010-9999", "4111 1111 1111 1111", "256", "..", "  ", "\n"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(60)))


def base_of(frame):
    found = pii.find(frame, None).withColumn("spans", F.filter("spans", lambda span: span["base"]))
    return [(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in found.collect()]


def test_base_spans(spark):
    rng = random.Random(5)
    texts = [noise(rng) for _ in range(1_500)] + ["a@b.c_x@d.e", "a@b@c.d", "1.2.3.4.5.6.7.8", "+1+12345678"]
    for text, found in base_of(documents(spark, texts)):
        assert found == plain(text), text


def test_long_runs(spark):
    """Runs on which a matcher that recurses or starts over would fail or never end."""
    texts = ["a" * 200_000, "1 " * 100_000, "a." * 100_000 + "@" + "b." * 100_000 + "c", "1" * 200_000,
             "+" + "1(" * 100_000, "@" * 100_000, "1.1.1.1 " * 500, "a@b.c " * 500]
    counts = [len(found) for _, found in base_of(documents(spark, texts))]
    assert counts == [0, 0, 1, 0, 0, 0, 500, 500]


def test_odd_rows(spark):
    frame = odd_documents(spark)
    found = pii.find(frame, pii.fit(frame))
    assert found.count() == frame.count() and found.columns == [*frame.columns, "spans"]
    assert found.filter("size(spans) > 0").count() == 0
    empty = empty_documents(spark)
    assert pii.fit(empty) is None and pii.find(empty, None).count() == 0


def test_votes_add_spans(spark):
    texts = ["write an e-mail to jane.doe@example.com", "call +1 (555) 010-9999 or phone 555-234-5678 today"] * 20
    texts += ["card 378282246310005 of mine", "my ssn 219-09-9999 ok", "version 000-00-0000 of it"] * 5
    texts += ["jane [at] example [dot] org"] * 3
    frame = documents(spark, texts)
    model = pii.fit(frame)
    found = {r["text"]: [(s["kind"], s["base"]) for s in r["spans"]] for r in pii.find(frame, model).collect()}
    assert found[texts[0]] == [("email", True)]
    assert found[texts[1]] == [("phone", True), ("phone", False)]
    assert found["card 378282246310005 of mine"] == [("card", False)]
    assert found["my ssn 219-09-9999 ok"] == [("ssn", False)]
    assert found["version 000-00-0000 of it"] == []


def test_reliabilities_follow_agreement():
    rows = [((1, 1, 1, 1), "x", 50), ((-1, 1, 1, 0), "x", 5), ((-1, 0, 0, 0), "x", 40), ((-1, 0, -1, 0), "x", 10)]
    found = pii.reliabilities(rows)
    assert found["x", (1, 1, 1, 1)] > 0.9 > 0.1 > found["x", (-1, 0, 0, 0)]


def test_redaction(spark):
    frame = documents(spark, ["é mail a@b.cc or +1 555 010 9999.", "none", None, "1.2.3.4"])
    found = pii.find(frame, None)
    texts = rows_of(found.select("doc_id", pii.redact(F.col("text"), F.col("spans"))))
    assert texts == [(0, "é mail [EMAIL] or [PHONE]."), (1, "none"), (2, None), (3, "[IP]")]


@pytest.mark.parametrize("native", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, data, native):
    plan = QUERIES["op8_personal_data"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert native not in plan


def test_query(spark, data):
    found = {r["doc_id"]: r for r in QUERIES["op8_personal_data"](spark, data).collect()}
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        expected = plain(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in expected)
        row = found[doc_id]
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == kind for k, _, _ in expected) for kind in pii.KINDS]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(row["spans"].split(",")) or not joined
