"""The registered queries of this package: each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.llm import bpe, trie
from fieldmill.llm.chat import as_records, digests, format_records
from fieldmill.llm.decontamination import contaminated
from fieldmill.llm.fingerprints import fingerprints
from fieldmill.llm.html_text import extract
from fieldmill.llm.licenses import scan
from fieldmill.llm.mixing import mix
from fieldmill.llm.near_duplicates import near_duplicates
from fieldmill.llm.repeats import repeated_spans
from fieldmill.llm.tables import cut, shared_dir, table
from fieldmill.llm.toxicity import toxicity
from fieldmill.llm.warc import through_archives
from fieldmill.llm.whitening import whiten


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    return through_archives(table(spark, sf_dir, "pages"), folder).drop("uri", "record_id")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("n_copies")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_records(as_records(turns.unionByName(extra))))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "block", "place", "repeats")


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(trie.numbered(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(*trie.with_shared_starts(turns, cut(trie.lengths(turns))))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


LLM_QUERIES = {
    "op1_warc": op1_warc,
    "op2_fingerprints": op2_fingerprints,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_chat": op4_chat,
    "op5_mixing": op5_mixing,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_toxicity": op9_toxicity,
    "op10_html_text": op10_html_text,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe": op12_bpe,
    "op13_whitening": op13_whitening,
}
