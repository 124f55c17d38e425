"""The operators over the given tables, by query name."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    embeddings,
    fingerprints,
    knn,
    lexical,
    license,
    neighbours,
    packing,
    pii,
    runs,
    simhash,
    token_files,
    toxicity,
    warc,
)
from ledgerloom.llm.common import Derive

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def simhash_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, directory, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def exact_top_k(spark: SparkSession, directory: str) -> DataFrame:
    rows = _table(spark, directory, "embeddings")
    vectors = rows.select("vec_id", knn.quantised(F.col("embedding")).alias("vector"))
    return knn.nearest(vectors, F.col("vec_id") % 50 == 0)


def embedding_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, directory, "embeddings"))


def token_id_files(spark: SparkSession, directory: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    files = token_files.write(_table(spark, directory, "documents"), tokenizer, end_id=2)
    folder = files.select("folder").first()
    if folder is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    starts = files.select(F.col("file").alias("of_file"), "start")
    digests = Derive("n_tokens long, ids_crc32 long", _token_digests)
    found = token_files.read(spark, folder["folder"], digests)
    return found.join(starts, F.col("file") == F.col("of_file")).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def _token_digests(found: list[pa.Array]) -> list[pa.Array]:
    ids = found[0].to_pylist()
    return [pa.array([len(of) // 4 for of in ids], pa.int64()), pa.array([*map(zlib.crc32, ids)], pa.int64())]


def best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(_table(spark, directory, "documents"), tokenizer, end_id=1))


def byte_level_bpe(spark: SparkSession, directory: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    digests = Derive("n_tokens long, ids_sha256 string, decoded_sha256 string", _bpe_digests)
    documents = _table(spark, directory, "documents")
    return bpe.encode(documents, ranks, pattern, decoded=True, derive=digests)


def _bpe_digests(found: list[pa.Array]) -> list[pa.Array]:
    ids, decoded = found
    numbers = ids.flatten().to_numpy().tolist()
    ends = np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))
    starts = np.concatenate(([0], ends[:-1]))
    lines = [" ".join(map(str, numbers[s:e])) for s, e in zip(starts.tolist(), ends.tolist())]
    return [
        pa.array(ends - starts, pa.int64()),
        pa.array([sha256(line.encode()).hexdigest() for line in lines], pa.string()),
        pa.array([sha256(text.as_buffer()).hexdigest() for text in decoded], pa.string()),
    ]


def toxicity_scores(spark: SparkSession, directory: str) -> DataFrame:
    documents = _table(spark, directory, "documents")
    model = toxicity.fit(documents, _table(spark, directory, "labels"))
    return toxicity.scored(documents.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def personal_data(spark: SparkSession, directory: str) -> DataFrame:
    documents = _table(spark, directory, "documents").select("doc_id", "text")
    found = pii.find(documents, pii.fit(documents)).select("doc_id", "spans")
    base = F.filter("spans", lambda span: span["base"])
    number = {kind: F.size(F.filter(base, lambda span: span["kind"] == kind)) for kind in pii.KINDS}
    return found.select(
        "doc_id",
        *[count.cast("long").alias(f"n_{kind}") for kind, count in number.items()],
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def warc_archives(spark: SparkSession, directory: str) -> DataFrame:
    folder = warc.write(_table(spark, directory, "pages")).select("folder").first()
    if folder is None:
        kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        return spark.createDataFrame([], kinds)
    return warc.read(spark, folder["folder"]).select(
        "page_id",
        F.coalesce(F.length("payload").cast("long"), "http_length").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def license_scans(spark: SparkSession, directory: str) -> DataFrame:
    found = license.scan(_table(spark, directory, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda place: place["start"].cast("long"))
    base = F.array_distinct(F.transform("base", lambda place: place["label"]))
    others = F.transform("detections", lambda span: span["label"])
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, others)), ",").alias("labels"),
        license.certainty(F.col("detections")).alias("score"),
    )


def periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    found = runs.periodic_runs(runs.made_periodic(_table(spark, directory, "documents")))
    # The longest run; of several the one with the smallest start, then period.
    best = F.array_min(F.transform("runs", lambda run: F.struct((-run["length"]).alias("shorter"), run["start"], run["period"])))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.shorter) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def document_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    rows = neighbours.with_next(_table(spark, directory, "documents"))
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.substring("next_text", F.lit(1), half))
    found = rows.withColumn("edited", edited).select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.sketches([F.col("text"), F.col("edited"), F.col("next_text")]).alias("of"),
    )
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.written(F.col("of.sketch_0")).alias("fingerprint"),
        fingerprints.written(F.col("of.sketch_1")).alias("edited_fingerprint"),
        F.col("of.resemblance_1").alias("near_edited"),
        F.col("of.resemblance_2").alias("near_next"),
    )


def ranked_search(spark: SparkSession, directory: str) -> DataFrame:
    return lexical.search(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_simhash_near_duplicates": simhash_near_duplicates,
    "op2_exact_top_k": exact_top_k,
    "op3_embedding_near_duplicates": embedding_near_duplicates,
    "op4_token_id_files": token_id_files,
    "op5_best_fit_packing": best_fit_packing,
    "op6_warc_archives": warc_archives,
    "op7_byte_level_bpe": byte_level_bpe,
    "op8_personal_data": personal_data,
    "op9_license_scans": license_scans,
    "op10_toxicity": toxicity_scores,
    "op11_periodic_runs": periodic_runs,
    "op12_document_fingerprints": document_fingerprints,
    "op13_ranked_search": ranked_search,
}

# Where SQL cannot say it, the tests compare with brute force.
SQL: dict[str, str] = {
    "op2_exact_top_k": """
        with usable as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
            from embeddings
            where embedding is not null and vec_id is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.vec_id as query_id, r.vec_id, cast(list_dot_product(q.v, r.v) as bigint) as score
            from usable q join usable r on q.vec_id % 50 = 0 and q.vec_id <> r.vec_id
        ),
        ranked as (
            select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op6_warc_archives": """
        with payloads as (select page_id, coalesce(html, '') as payload from pages),
        sized as (select *, cast(octet_length(encode(payload)) as bigint) as payload_bytes from payloads),
        held as (select *, max(page_id) over (partition by payload) as holder from sized)
        select page_id, payload_bytes, sha1(payload) as payload_digest,
            case when payload_bytes >= 1000 and page_id <> holder then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 1000 and page_id <> holder then holder end as refers_to
        from held
    """,
    "op13_ranked_search": r"""
        with terms_of as (
            select doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents where text is not null
        ),
        sized as (select doc_id, len(terms) as n from terms_of where len(terms) > 0),
        totals as (select count(*) as docs, cast(sum(n) as bigint) as all_terms from sized),
        lengths as (select doc_id, 100 - 90 + ((90 * n * docs) // all_terms) as m from sized, totals),
        wanted as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ),
        occurring as (
            select doc_id, term, count(*) as tf from (select doc_id, unnest(terms) as term from terms_of)
            where term in (select term from wanted) group by doc_id, term
        ),
        weights as (
            select term, cast(floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * count(*) + 1))) as bigint) as w
            from occurring, totals group by term, docs
        ),
        scored as (
            select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
            from wanted join occurring using (term) join weights using (term) join lengths using (doc_id)
            group by item_id, doc_id
        ),
        ranked as (
            select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
            from scored where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
}
