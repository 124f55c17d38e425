from __future__ import annotations

import zlib

import numpy as np
import pytest
from cases import documents, empty_documents, odd_documents
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize(
    "written",
    ["idiot", "IDIOT", "1d10t", "іdіоt", "ｉｄｉｏｔ", "i​diot", "ídìöt", "id!ot", "idi0t"],
)
def test_disguises_fold_to_the_word(written):
    assert toxicity.fold(f"an {written}, yes") == toxicity.fold("an idiot yes")


def test_folding_leaves_numbers_and_other_words_alone():
    assert toxicity.fold("In 1999 we had 42 items!") == " in we had items "
    assert toxicity.fold("東京 tower 7") == " 東京 tower "
    assert toxicity.fold("") == "  ".replace("  ", "  ") and toxicity.fold("123 !!").strip() == ""


def plain_features(text, lexicon, exceptions):
    """Every place of every entry, compared with each exception."""
    folded = toxicity.fold(text)
    best = {}
    for entry, weight in lexicon:
        at = folded.find(entry)
        while at >= 0:
            if at not in best or best[at][0] < len(entry):
                best[at] = (len(entry), weight)
            at = folded.find(entry, at + 1)
    for entry in exceptions:
        at = folded.find(entry)
        while at >= 0:
            for start in list(best):
                if at <= start < at + len(entry) - 1:
                    del best[start]
            at = folded.find(entry, at + 1)
    return sum(weight for _, weight in best.values()), len(best)


def test_entries_and_exceptions():
    lexicon = ((" trash", 2.0), (" trasher ", 3.0), (" stupid ", 1.5))
    exceptions = (" trash can ", " trashtalk ")
    for text in (
        "trash trash", "trash can", "a trash can and trash", "trasher", "trashers", "stupid", "stupidly", "Trashtalk trash",
        "tr4sh", "nothing here", "", "trash can trash can trash", "stupid trash can stupid",
    ):
        weight, number = plain_features(text, lexicon, exceptions)
        found = toxicity.features(text, lexicon, exceptions)
        assert found[1] == pytest.approx(np.log1p(weight)), text
        assert (found[2] > 0) == (number > 0)


def test_shorter_texts_weigh_more():
    lexicon = ((" scum ", 4.0),)
    dense = toxicity.features("you scum " * 3, lexicon, ())
    thin = toxicity.features("you scum " * 3 + "word " * 500, lexicon, ())
    assert dense[0] > thin[0] and dense[1] == thin[1]


def labelled(spark):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdeimnorst"), 5)) for _ in range(300)]
    texts, labels = [], []
    for i in range(900):
        body = list(rng.choice(words, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                body.insert(int(rng.integers(60)), rng.choice(["grumpf", "zonker", "zonkish", "Gru​mpf"]))
        texts.append(" ".join(body))
        labels.append((i, 1, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS)


def test_learns_what_is_not_known(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(docs, model).join(labels.drop("quality"), "doc_id")
    held = found.filter(toxicity.held_out(F.col("doc_id")))
    assert held.count() == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(900))
    assert held.filter("predicted <> toxic").count() <= 0.03 * held.count()


def test_caps_leave_the_scores_about_as_they_are(spark):
    """Where the sample has half of toxic rows and the table an eighth, scores keep to the table."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(6_000):
        toxic = i % 8 == 0
        body = list(rng.choice(["sun", "tree", "house", "road", "paper", "water"], 20))
        # The word is in most toxic texts, and in some clean ones.
        if rng.random() < (0.8 if toxic else 0.1):
            body.insert(int(rng.integers(20)), "grumpf")
        texts.append(" ".join(body))
        labels.append((i, 1, int(toxic)))
    docs, labels = documents(spark, texts), spark.createDataFrame(labels, LABELS)

    def mean_scores(**caps):
        found = toxicity.scored(docs, toxicity.fit(docs, labels, **caps)).groupBy(F.col("text").contains("grumpf"))
        return [row["score"] for row in found.agg(F.avg("score").alias("score")).collect()]

    whole, cut = sorted(mean_scores()), sorted(mean_scores(toxic_rows=400, clean_rows=400))
    assert len(whole) == 2 and cut == pytest.approx(whole, abs=0.12)
    print("mean scores", whole, cut)


def test_held_out_labels_are_not_used(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_odd_rows_and_labels(spark):
    frame = odd_documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (None, 1, 1), (3, 1, None), (99, 1, 1)], LABELS)
    for model in (toxicity.fit(frame, labels), toxicity.fit(empty_documents(spark), labels.limit(0))):
        rows = toxicity.scored(frame, model).collect()
        assert len(rows) == frame.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in rows)
        assert toxicity.scored(empty_documents(spark), model).count() == 0
        insult = documents(spark, ["you stupid idiot, pathetic moron", "a stupid simple plan"])
        assert [r["predicted"] for r in toxicity.scored(insult, model).orderBy("doc_id").collect()] == [1, 0]


def test_query(spark):
    """Held-out labels of the larger test table, which has enough to learn from."""
    data = "/root/testdata/sf0.01"
    found = QUERIES["op10_toxicity"](spark, data)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").collect()
    clean = [r for r in rows if r["held_out"] and not r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert found.count() == spark.read.parquet(f"{data}/documents.parquet").count()
