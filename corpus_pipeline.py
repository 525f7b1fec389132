"""From raw documents to packed sequences: five stages, each one table in, one table out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of documents, with the text cut and n_chars counted anew where there is such a column. A
text that a stage has emptied stays as a document without text. ``run`` writes each stage's
table to the shared folder and reads it again, so that a lost executor costs a stage at most, and removes the table before it.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.bestfit_pack import pack_documents
from tabflow.llm.common import table
from tabflow.llm.golay_simhash import drop_near_copies
from tabflow.llm.line_windows import drop_repeated_lines
from tabflow.llm.quality_mil import learn, score_quality
from tabflow.llm.run_length_index import drop_repeated_bytes
from tabflow.llm.token_count import count_tokens
from tabflow.session import fresh_path, remove_path

VOCABULARY = "byte_bpe_50k.json"
ORACLE_SQL = None  # scores, bit distances and packing are beyond SQL; tests/llm holds the stages against plain versions


def _like(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """The columns of ``docs`` from a stage that has cut its texts."""
    counted = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars")
    return cut.select(*[counted if c == "n_chars" else F.col(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score 0.3 or more)."""
    model = learn(docs, table(spark, sf_dir, "labels"), folds=5, held=0)
    return score_quality(docs, model, threshold=0.3, keep=True).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of repeated three-line windows."""
    return _like(docs, drop_repeated_lines(docs, window=3))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    return drop_near_copies(docs, shingle=3, max_bits=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes that an earlier one has."""
    return _like(docs, drop_repeated_bytes(docs, length=50))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of whole or cut documents, measured in tokens."""
    return pack_documents(count_tokens(docs, Path(public_tokenizers.path(VOCABULARY)).read_bytes()))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the last stage. A stage's table goes as soon as the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    packed = STAGES[-1][1](spark, docs, sf_dir)  # rests on the counted lengths, which are a checkpoint
    remove_path(spark, before)
    return packed
