"""The registered queries of the llm operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.llm import (bpe, exact_dedup, html_text, language_id, license_scan, packing, quality,
                         shingle_join, spelling_variants, token_counts, vector_links, warc, whitening)
from legwise.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify_documents(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "language", "confidence", F.col("accepted").alias("kept"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts every document, then redacts in each the longest run of digits
    (the first of them; without digits, the text gets a closing line), and
    recounts from the trees. The edits are derived from the texts."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    runs = F.regexp_extract_all("text", F.lit("[0-9]+"), 0)
    longest = F.aggregate(runs, F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    digits = docs.withColumn("digits", longest)
    edit = F.when(F.length("digits") > 0, F.struct(
        (F.instr("text", F.col("digits")) - 1).alias("start"), F.length("digits").alias("removed"),
        F.lit("[number]").alias("inserted"))).otherwise(
        F.struct(F.length("text").alias("start"), F.lit(0).alias("removed"), F.lit("\n[end]").alias("inserted")))
    counted = token_counts.count(digits.select("doc_id", "text", F.array(edit).alias("edits")), vocabulary)
    return token_counts.recount(counted, vocabulary).select("doc_id", "n_before", "n_tokens", "n_encoded_chars")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("notices")


def op9_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.vector_components(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_back(spark, warc.write_archive(table(spark, sf_dir, "pages")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_counts": op5_token_counts,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_license_scan": op8_license_scan,
    "op9_vector_links": op9_vector_links,
    "op10_warc": op10_warc,
    "op11_quality": op11_quality,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, digest AS text_sha256
        FROM (SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents)
        WINDOW w AS (PARTITION BY digest)""",
    "op10_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
        q AS (SELECT *, octet_length(b) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to, TRUE AS verified
        FROM q""",
}
