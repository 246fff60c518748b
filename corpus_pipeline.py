"""The training-data pipeline: quality, near duplicates, mixing, token ids. Each stage is a table for the next one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm import bpe, jaccard, mixing, quality
from textkiln.llm.queries import MIX_DEFAULT, MIX_WEIGHTS, WORD_BPE
from textkiln.operators.storage import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected below this score.
REJECT_BELOW = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the compression classifier, fitted on the labelled rows of ``docs``, doesn't reject.

    Null and empty texts are judged by the score of no text, long ones as a whole; equal rows are judged alike and keep their number, rows of a null
    id too. An empty table gives an empty one; columns besides those of documents are left out.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_column(docs, model, name="_tk_score").where(F.col("_tk_score") >= REJECT_BELOW).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each group linked by 5-word shingles with similarity 0.8 or more.

    Rows of a null id link with nothing and stay, as do null and empty texts; rows that repeat the kept id stay with it. A long text is one set
    of all its shingles. An empty table gives an empty one; columns besides those of documents are left out.
    """
    groups = jaccard.similarity_groups(docs, n=5, percent=80).where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(groups, "doc_id", "left_anti")
    return kept.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the sources' bytes meet the target weights, in shuffled order.

    Null and unlisted sources have a weight too; null ids and repeated rows draw alike; a source whose texts are all null or empty has no size and
    leaves, as has no document of an empty table. Columns besides those of documents are left out.
    """
    return mixing.replicate(docs, MIX_WEIGHTS, default=MIX_DEFAULT, seed=17).select(*COLUMNS)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked by digests of the ids and of the decoded text.

    A row per row, of null and repeated ids too; null and empty texts have no ids; long texts are encoded whole; other columns are not read.
    """
    return bpe.digests(docs, WORD_BPE)


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", ngram_jaccard_join), ("mixing sources to target weights", mix_sources), ("BPE encoding and decoding", bpe_tokens)]

#: The classifier, the grouping and the encoder are no SQL: tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, last = STAGES
    return last[1](spark, reduce(lambda d, stage: materialize(stage[1](spark, d, sf_dir), "stage"), first, docs), sf_dir)
