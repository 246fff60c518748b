"""Readers: JSON lines, shards, Parquet, plain text, MediaWiki XML, CSV pairs, token files, seeds, and a source registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.functions.normalize import strip_wikitext
from textkiln.functions.text import strip

#: A document of profile A; fields that a line lacks are null.
DOCUMENT = T.StructType([T.StructField(n, t) for n, t in (("id", T.StringType()), ("text", T.StringType()), ("source", T.StringType()), ("url", T.StringType()), ("title", T.StringType()), ("timestamp", T.StringType()), ("lang", T.StringType()), ("lang_score", T.DoubleType()), ("char_count", T.LongType()), ("metadata", T.MapType(T.StringType(), T.StringType())))])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT, tolerant: bool = False) -> DataFrame:
    """Lines of JSON (also gzip); a line that isn't JSON comes as ``_corrupt``. tolerant: keep what a torn file still holds."""
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return (reader.option("ignoreCorruptFiles", "true") if tolerant else reader).json(path)


def with_shard(df: DataFrame) -> DataFrame:
    """Adds shard (file name) and shard_source, the name up to the first '-'."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.select("*", name.alias("shard")).withColumn("shard_source", F.split_part("shard", F.lit("-"), F.lit(1)))


def read_parquet_text(spark: SparkSession, path: str, field: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text and kept columns of a folder of Parquet; the text column is found among text, content, sentence."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    found = field or next((c for c in ("text", "content", "sentence") if c in df.columns), None)
    if found is None:
        raise ValueError(f"no text column among {df.columns}")
    return df.select(F.col(found).alias("text"), *[c for c in keep if c in df.columns])


def read_blank_separated(spark: SparkSession, path: str) -> DataFrame:
    """Documents parted by blank lines."""
    return spark.read.option("lineSep", "\n\n").text(path).select(strip(F.col("value")).alias("text")).where("text <> ''")


def read_mediawiki(spark: SparkSession, path: str, shortest: int = 200, namespaces: tuple[int, ...] = (0,)) -> DataFrame:
    """Pages of a dump: given namespaces, no redirects, wiki markup stripped, of some length."""
    schema = "title string, ns int, id long, redirect string, revision struct<text:string>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    out = pages.where(F.col("ns").isin(*namespaces) & F.col("redirect").isNull() & ~F.col("revision.text").rlike("(?i)^#redirect"))
    return out.select("id", "title", "ns", strip_wikitext(F.col("revision.text")).alias("text")).where(F.length("text") >= shortest)


def read_csv_pairs(spark: SparkSession, path: str, user: str, answer: str) -> DataFrame:
    return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path).select(F.col(user).alias("user"), F.col(answer).alias("assistant")).where("user <> '' and assistant <> ''")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    return spark.read.text(path).select(F.trim("value").alias("seed")).where("seed <> '' and not startswith(seed, '#')")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Little-endian uint16 token files: path, tokens."""
    import numpy as np

    parse = F.pandas_udf(lambda raw: raw.map(lambda b: np.frombuffer(b, "<u2").astype("int32").tolist()), "array<int>")
    return spark.read.format("binaryFile").load(path).select("path", parse("content").alias("tokens"))


#: Our own documents, one for each route, in both scripts and with contamination.
DEMO = (
    ("native", "নদীর ধারে ছোট একটি গ্রাম আছে। সেখানে সকালে পাখির ডাক শোনা যায় এবং মানুষ মাঠে কাজ করে। " * 4),
    ("short", "নদীর জল শান্ত।"),
    ("banglish", "ami ajke bari jabo na, tumi kemon acho bolo, onek kotha ache"),
    ("romanized", "report ta kal submit korbo, meeting ta khub boring hoise bhai, tui koi"),
    ("codeswitch", "আমি আজ office যাব কারণ client এর meeting আছে, তারপর বাসায় ফিরব dinner করতে।"),
    ("dialect", "মুই বাজারত যাম বাহে, তোই মোর সাথে আইসেক, হামরা একসাথে ফিরমো।" * 5),
    ("blocked", "यह वाक्य हिन्दी में है और इसे यहाँ नहीं होना चाहिए।"),
    ("assamese", "মই আজি ঘৰলৈ যাম আৰু তাৰ পাছত কিতাপ পঢ়িম, তোমাৰ লগত কথা পাতিম।"),
    ("english", "the river is quiet this morning and the boats are not yet on their way"),
)


def demo_documents(spark: SparkSession, n: int = len(DEMO)) -> DataFrame:
    """``n`` documents (i, kind, text): the literal ones, over and over."""
    bank = spark.createDataFrame([(i, *row) for i, row in enumerate(DEMO)], "k int, kind string, text string")
    return spark.range(n).select(F.col("id").alias("i")).join(F.broadcast(bank), F.col("i") % len(DEMO) == F.col("k")).select("i", "kind", "text")


def discover_links(pages: DataFrame, html: Column) -> DataFrame:
    """Absolute links of pages, one row each."""
    return pages.select("*", F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(r'href="(https?://[^"#?]+)'), 1))).alias("link"))


def sitemap_links(xml: Column) -> Column:
    return F.array_union(F.xpath(xml, F.lit("//url/loc/text()")), F.xpath(xml, F.lit("//sitemap/loc/text()")))


REGISTRY: dict[str, Callable[..., DataFrame]] = {"jsonl": read_jsonl, "parquet": read_parquet_text, "blank_separated": read_blank_separated, "mediawiki": read_mediawiki, "csv_pairs": read_csv_pairs, "seeds": read_seeds, "tokens": read_tokens}


def read_source(spark: SparkSession, kind: str, path: str, **options) -> DataFrame:
    """A registered source by name."""
    if kind not in REGISTRY:
        raise KeyError(f"unknown source {kind}; known: {sorted(REGISTRY)}")
    return REGISTRY[kind](spark, path, **options)


def merge_sources(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union by name, with source_order from the order of the list."""
    parts = [df.withColumns({"source": F.lit(name), "source_order": F.lit(i)}) for i, (name, df) in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
