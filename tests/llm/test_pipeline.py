from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from cases import empty_documents, odd_documents, rows_of
from test_packing import plain_pieces, sound
from test_pii import plain as plain_spans
from test_simhash import groups, plain_fingerprint

from ledgerloom.llm import pii, toxicity


def test_contract(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_duplicates", "personal_data", "best_fit_packing",
    ]


def test_stages_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    model = toxicity.fit(docs, spark.read.parquet(f"{data}/labels.parquet"))
    kept = corpus_pipeline.toxicity_stage(spark, docs, data)
    assert kept.columns == docs.columns
    found = np.array([toxicity.features(r["text"] or "", model.lexicon, model.exceptions) for r in rows.values()])
    scores = toxicity._probability(found, model.coefficients)
    expected = [tuple(r) for r, score in zip(rows.values(), scores) if score < toxicity.THRESHOLD]
    assert rows_of(kept) == sorted(expected, key=repr)
    assert 0 < len(expected) < len(rows)

    once = corpus_pipeline.simhash_stage(spark, kept, data)
    assert once.columns == docs.columns
    prints = [plain_fingerprint(r[1]) for r in expected]
    ids = [r[0] for r in expected]
    stays = [r for r, group in zip(expected, groups(prints, ids)) if r[0] == group]
    assert rows_of(once) == sorted(stays, key=repr)

    clean = corpus_pipeline.pii_stage(spark, once, data)
    assert clean.schema == docs.schema
    after = {r["doc_id"]: r for r in clean.collect()}
    assert sorted(after) == sorted(r[0] for r in stays)
    for row in stays:
        text = after[row[0]]["text"]
        if not plain_spans(row[1]):
            assert tuple(after[row[0]]) == row
        else:
            assert plain_spans(text) == [] and after[row[0]]["n_chars"] == len(text)

    packed = corpus_pipeline.packing_stage(spark, clean, data)
    pieces = sorted(plain_pieces([(i, r["text"]) for i, r in after.items()]), key=repr)
    assert rows_of(packed.select("doc_id", "piece", "start", "length", "ids_crc32")) == pieces
    sound([tuple(r) for r in packed.select("length", "sequence_id", "offset").collect()], 4_096)


def test_odd_rows_and_empty_table(spark, data):
    for frame in (odd_documents(spark), empty_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = frame.columns
            frame = stage(spark, frame, data).cache()
            assert frame.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, frame, data).collect()


def test_run(spark, data):
    found = corpus_pipeline.run(spark, data)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 0


@pytest.mark.parametrize("name", ["text", "spans"])
def test_columns_of_documents_stay(spark, data, name):
    frame = odd_documents(spark).selectExpr("*", "'mine' as spans")
    assert corpus_pipeline.pii_stage(spark, frame, data).select(name).count() == frame.count()
    assert corpus_pipeline.pii_stage(spark, frame, data).filter("spans <> 'mine'").count() == 0
