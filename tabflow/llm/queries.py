"""The registered queries of this package and the SQL that some of them are held against."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import gru_langid, quality_mil
from tabflow.llm.anchor_tree import NEGATIVE_SQL, hard_negatives
from tabflow.llm.bestfit_pack import pack_documents
from tabflow.llm.collocations import COLLOCATION_SQL, collocations
from tabflow.llm.common import in_bucket, table
from tabflow.llm.golay_simhash import simhash_groups
from tabflow.llm.line_windows import LINE_SQL, drop_repeated_lines
from tabflow.llm.lpt_shards import shard_documents
from tabflow.llm.piece_agenda import encode_decode
from tabflow.llm.pivot_index import near_vectors
from tabflow.llm.run_length_index import repeated_bytes
from tabflow.llm.scaled_sketch import edited_likeness
from tabflow.llm.token_count import count_tokens

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def vocabulary(name: str) -> bytes:
    return Path(public_tokenizers.path(name)).read_bytes()


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_mil.learn(docs, table(spark, sf_dir, "labels"), folds=5, held=0)
    scored = quality_mil.score_quality(docs, model, threshold=0.3)
    return scored.select("doc_id", (in_bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(op2_token_counts(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = drop_repeated_lines(table(spark, sf_dir, "documents"), window=3)
    text = F.coalesce("text", F.lit(""))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"), length=50)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary(PIECE_VOCABULARY))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = gru_langid.identify(docs, gru_langid.learn(docs, folds=3, held=1))
    return found.select("doc_id", (in_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "agreement")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, top=2000, covered=80)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = table(spark, sf_dir, "embeddings").where(finite).select("vec_id", label.alias("label"), whole.alias("vector"))
    return hard_negatives(rows, every=50, positives=5, negatives=3, low=50, high=95)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_counts": op2_token_counts,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_language_id": op10_language_id,
    "op11_sharding": op11_sharding,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": LINE_SQL,
    "op12_phrase_collocations": COLLOCATION_SQL,
    "op13_hard_negatives": NEGATIVE_SQL,
}
