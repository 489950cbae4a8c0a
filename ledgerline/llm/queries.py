"""One query per operator, over whole tables with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archive, attribution, credentials, decontaminate, dialogues, fingerprint, hosts, oracles, packing, shuffle, superminhash, tokenfiles, toxicity, variants
from .common import table, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.with_next(table(spark, folder, "documents"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = superminhash.components(table(spark, folder, "documents"), shingle=2)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    manifest, content = tokenfiles.write(docs, tokenfiles.new_folder(docs))
    return tokenfiles.read(manifest, content)


def op5_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = shuffle.shuffle(rows, shards=8)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        counted("assign").alias("n_assign"),
        counted("access").alias("n_access"),
        counted("hex").alias("n_hex"),
        F.sha2(credentials.listed(base).cast("binary"), 256).alias("base_sha256"),
        credentials.listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(toxicity.labelled(docs, table(spark, folder, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id",
        (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontaminate.digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return hosts.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.count(table(spark, folder, "documents"))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return dialogues.rebuilt_trie(table(spark, folder, "conversations"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    records = archive.read(archive.write(pages, archive.new_folder(pages)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = written(variants.words(table(spark, folder, "documents")), "vocabulary")
    return variants.forms(vocabulary).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_packing": op3_packing,
    "op4_token_files": op4_token_files,
    "op5_shards": op5_shards,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_warc": op12_warc,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op2_near_duplicates": oracles.NEAR_DUPLICATES,
    "op8_decontamination": oracles.DECONTAMINATION,
    "op11_conversation_trie": oracles.CONVERSATION_TRIE,
    "op12_warc": oracles.WARC,
    "op13_spelling_variants": oracles.SPELLING_VARIANTS,
}
