"""Registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm import (decontamination, exact_dedup, language_id, mixing, near_dedup, piece_codec, pii, prefix_trie, quality,
                           token_alignment, token_counts, token_output, warc)
from vaultmart.llm.common import new_path, read_table, stored


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_remainder(n: int):
    """crc32 of the document id as text, modulo n: decides which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def store(spark: SparkSession):
    return lambda df, name: stored(spark, df, name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(4) == 2, F.lit(False))
    model = language_id.train(docs.where(~held_out).select("lang", "text"), store(spark))
    return language_id.identify(docs, model, keep={"held_out": held_out})


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), store(spark))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), store(spark))
    return got["documents"].select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.personal_data(read_table(spark, sf_dir, "documents"), store(spark))
    counts = [pii.of_kind("base", k).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return got.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.spelled("base"), 256).alias("base_sha256"),
                      pii.spelled("spans").alias("spans"))


def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sizes = stored(spark, mixing.word_sizes(docs, "doc_id", "source", "text"), "sizes")
    return mixing.mix_digest(sizes, store(spark), weights=(5, 2, 1), ratio=1.5, repeat=2.0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(5) == 0, F.lit(False))
    stats = stored(spark, quality.document_statistics(docs, keep={"doc_id": F.col("doc_id"), "held_out": held_out}), "statistics")
    labels = read_table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", F.col("quality").alias("label"))
    training = stored(spark, stats.where(~F.col("held_out")).join(labels, "doc_id").select("stats", "label"), "training")
    scored = quality.score(stats, quality.fit(training))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    folder = new_path(spark, "warc")
    index = stored(spark, warc.write_archives(warc.mark_revisits(pages, "page_id", "url", "html", min_bytes=0), folder), "warc-index")
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(index, folder, store(spark)).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), store(spark), n=3, percent=85)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    token_output.write_token_ids(read_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_output.read_digests(spark, path)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), store(spark), family=5, heads=9)


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.codec_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                           tokenizer_path("piece_bpe_32k.model"), store(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_exact_dedup, op3_decontamination, op4_pii, op5_curriculum_mix, op6_quality,
                            op7_warc, op8_token_counts, op9_near_dedup, op10_token_ids, op11_conversation_trie,
                            op12_piece_codec, op13_token_alignment)
}

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, {FOLD} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op3_decontamination": fr"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLD}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({FOLD}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS words
       FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
run AS (SELECT doc_id, p, list(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS next FROM dw),
hit AS (SELECT r.doc_id, r.p, z.size, array_to_string(list_slice(r.next, 1, z.size), ' ') AS words
        FROM run r JOIN (SELECT DISTINCT size FROM iw) z ON len(r.next) >= z.size),
found AS (SELECT DISTINCT h.doc_id, h.p, h.size, iw.item_id FROM hit h JOIN iw ON iw.size = h.size AND iw.words = h.words),
marked AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN owners USING (doc_id)""",
}
