"""A corpus made ready for training: rejected, repeated and nearly repeated text goes, the rest is packed.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import threading
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import jaccard, packing, passages, quality, substrings
from ledgerlark.llm.common import prepare
from ledgerlark.session import delete_scratch, noted_scratch, written

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, ``n_chars`` counted anew where it is one of them."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*[f"`{c}`" for c in columns])


def shortened(docs: DataFrame, operator, counts: list[str]) -> DataFrame:
    """``docs`` with the texts that the operator leaves; columns named like its counts stay as they are."""
    aside = {c: f"__own_{c}" for c in counts if c in docs.columns}
    out = operator(docs.withColumnsRenamed(aside)).drop(*counts)
    return with_length(out.withColumnsRenamed({v: k for k, v in aside.items()}), docs.columns)


#: Intermediate tables of the stage before, by the input of the pipeline; each thread has its own.
_read_before = threading.local()


def stage(fn):
    """Before a stage starts, delete the intermediate tables of the one before, whose result is written."""

    @wraps(fn)
    def run_alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        mine = _read_before.__dict__.setdefault(sf_dir, [])
        delete_scratch(spark, mine)
        with noted_scratch() as paths:
            out = fn(spark, docs, sf_dir)
        mine.extend(paths)
        return out

    return run_alone


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, holds for good; a null text is scored as an empty one.

    Every row is judged by its text alone, so rows with null or repeated ids and copies are too.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without passages of two or more lines that an earlier document has; null texts stay null."""
    return shortened(docs, passages.dedup_passages, ["n_lines", "n_removed"])


@stage
def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at 0.8; texts without words are linked with none."""
    return jaccard.keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


@stage
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without 35-word windows that start anywhere else too; shorter and null texts stay."""
    return shortened(docs, substrings.dedup_substrings, ["n_words", "n_removed"])


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document in sequences of 2,048 tokens; a null text is a closing 0."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages in between returned is deleted once it has been read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, function in STAGES:
        with noted_scratch() as paths:
            docs = written(function(spark, docs, sf_dir), f"stage-{name}")
        delete_scratch(spark, before)
        before = paths[-1:]
    return docs
