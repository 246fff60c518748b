"""The projected documents that the queries share, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.operators.storage import spread, text_batches

#: Fixed letter maps of the projection to Bengali, Assamese and Devanagari letters.
LATIN = "abcdefghijklmnopqrstuvwxyzàâäáéèêëíîïìóôöòúùûüñçßœæãõ."
BENGALI = "অবচদএফগহিজকলমনোপখরসতুভধষণঝ" + "আ" * 27 + "।"
ASSAMESE = BENGALI.replace("র", "ৰ")
DEVANAGARI = "अबचदएफगहिजकलमनोपखरसतुभधषणझ" + "आ" * 27 + "।"

#: Bengali-like text of each document; the same SQL for Spark and DuckDB.
BN_TEXT = f"""CASE WHEN lang = 'en' AND doc_id % 3 = 0 THEN replace(replace(replace(lower(text), 'the ', 'ami '), 'and ', 'tumi '), 'of ', 'kemon ')
 WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN translate(lower(text), '{LATIN}', '{BENGALI}')
 WHEN lang = 'de' THEN translate(lower(text), left('{LATIN}', 18), left('{BENGALI}', 18)) WHEN doc_id % 3 = 0 THEN translate(lower(text), '{LATIN}', '{DEVANAGARI}')
 WHEN doc_id % 3 = 1 THEN translate(lower(text), '{LATIN}', '{ASSAMESE}') ELSE translate(lower(text), '{LATIN}', '{BENGALI}') END"""
BN = f"bn AS (SELECT doc_id, source, lang, {BN_TEXT} AS text FROM documents)"

#: Licence, priority and provenance of sources; src18 and src19 are left out so that defaults occur.
SOURCES = [
    ("src0", "ODC-By", 100, "web"), ("src1", "CC0", 95, "library"), ("src2", "CC-BY-4.0", 90, "wiki"), ("src3", "CC-BY-SA 3.0", 85, "wiki"), ("src4", "MIT", 80, "code"),
    ("src5", "PD", 75, "library"), ("src6", "CC-BY-NC", 70, "web"), ("src7", "PD-subset", 65, "library"), ("src8", "ToU", 60, "news"), ("src9", "see-card", 55, "web"),
    ("src10", "train-only", 50, "news"), ("src11", "verify per-item", 45, "library"), ("src12", "CC-BY", 40, "web"), ("src13", "public domain", 35, "library"), ("src14", "unknown", 30, "web"),
    ("src15", "CC-BY 2.0", 25, "forum"), ("src16", "proprietary", 20, "news"), ("src17", "cc0", 10, "forum"),
]
SOURCES_SQL = "sources(source, license, priority, provenance) AS (VALUES " + ", ".join(f"('{a}', '{b}', {c}, '{d}')" for a, b, c, d in SOURCES) + ")"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its DuckDB SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(text_batches(df)) if name in ("documents", "pages") else df


def bn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.expr(BN_TEXT).alias("text"))


def sources(spark: SparkSession) -> DataFrame:
    """The source dimension: 18 literal rows."""
    return spark.createDataFrame(SOURCES, "source string, license string, priority int, provenance string")


def md5(c: Column | str) -> Column:
    """Digest of a long text, for results."""
    return F.md5(c)


def n_of(pattern: str, text: str = "text") -> str:
    """DuckDB: matches of a pattern."""
    return f"len(regexp_extract_all({text}, '{pattern}'))::INTEGER"


def text() -> Column:
    return F.col("text")
