"""Collectors: ordered shard scans with a global index, file discovery, resumable JSON sources, and the gates of each kind of source."""

from __future__ import annotations

import io
import json
from abc import ABC, abstractmethod
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from textkiln.functions.script import is_banglish
from textkiln.functions.text import strip
from textkiln.operators.order import numbered
from textkiln.sources.readers import DOCUMENT, read_jsonl, with_shard

#: Marks of disambiguation pages and of redirects.
DISAMBIGUATION = ("দ্ব্যর্থতা নিরসন", "দ্ব্যর্থতা", "বহুবিকল্প")
REDIRECT = r"(?i)^#(পুনর্নির্দেশ|REDIRECT)"
#: Least characters of an article, a wiki page, a book and a post.
LEAST = {"article": 100, "wiki": 200, "literature": 200, "post": 50}
#: Marks of answers that list steps or headings.
BANNED = ("ধাপে ধাপে", "ধাপ ১", "### ")


def ordered_shards(spark: SparkSession, path: str, priorities: DataFrame, *, most: int | None = None, tolerant: bool = True) -> DataFrame:
    """Documents of JSON shards in (priority descending, source, shard, line) order, with doc_index from 0; ``most``: only the first ones.

    ``priorities`` (source, priority) is a dimension of known sources; the source of a shard is its name up to the first '-', and unknown
    ones have priority 0. Blank lines and lines that aren't JSON are left out and count for nothing; what a torn file still holds is kept.
    """
    lines = spark.read.option("ignoreCorruptFiles", str(tolerant).lower()).text(path).select(F.trim("value").alias("_line"), "_metadata").withColumn("_at", F.monotonically_increasing_id())
    parsed = lines.withColumn("_r", F.from_json("_line", DOCUMENT, {"mode": "PERMISSIVE"})).where("_line <> '' and try_parse_json(_line) is not null and _r is not null")
    docs = with_shard(parsed.select("_r.*", "_at", "_metadata")).withColumn("_block", F.col("_metadata.file_block_start")).drop("_metadata")
    known = priorities.select(F.col("source").alias("shard_source"), F.col("priority").cast("int").alias("priority"))
    ranked = docs.join(F.broadcast(known), "shard_source", "left").withColumn("priority", F.coalesce("priority", F.lit(0))).withColumn("_rank", -F.col("priority"))
    out = numbered(ranked, "_rank", "shard_source", "shard", "_block", "_at").withColumnRenamed("pos", "doc_index").drop("_rank", "_block", "_at")
    return out if most is None else out.where(F.col("doc_index") < most)


def discover_files(spark: SparkSession, pattern: str, *, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), min_age_s: int | None = None) -> DataFrame:
    """(path, name, source, length, modified) of files, by any file system that Spark reads; contents are not.

    ``include`` and ``exclude`` name sources (the name up to the first '-' or '.'); files younger than ``min_age_s`` may still be written to and are left out.
    """
    found = spark.read.format("binaryFile").load(pattern).select("path", "length", F.col("modificationTime").alias("modified"))
    out = found.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("source", F.regexp_extract("name", r"^([^-.]*)", 1))
    if include:
        out = out.where(F.col("source").isin(*include))
    if exclude:
        out = out.where(~F.col("source").isin(*exclude))
    if min_age_s is not None:
        out = out.where(F.col("modified") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(min_age_s)))
    return out.select("path", "name", "source", "length", "modified")


def unfinished(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files (name) that have no output of that name yet."""
    return files.join(done.select("name").distinct(), "name", "left_anti")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report written as one JSON object, over several lines or one."""
    return spark.read.option("multiLine", True).json(path)


def read_many(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """All JSON-lines files of several paths as one table."""
    return read_jsonl(spark, paths, **options)


def seen_union(known: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """State update without effect if it is repeated: rows of ``fresh`` whose key is not known, once each."""
    return fresh.dropDuplicates([key]).join(known.select(key), key, "left_anti")


# gates


def wiki_articles(pages: DataFrame, shortest: int = LEAST["wiki"]) -> DataFrame:
    """Extracted wiki pages (title, text): no stubs, disambiguation pages or redirects; texts stripped."""
    text = strip(F.coalesce("text", F.lit("")))
    head = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.left(text, F.lit(500)))
    listed = F.exists(F.array(*[F.lit(p) for p in DISAMBIGUATION]), lambda p: F.contains(head, p))
    return pages.where((F.length(text) >= shortest) & ~listed & ~text.rlike(REDIRECT)).withColumn("text", text)


def long_enough(kind: Column, text: Column, content_type: Column | None = None) -> Column:
    """Length gate of each kind of collector; posts must be Banglish too, and pages of another type than text/html don't pass."""
    least = F.lit(0)
    for name, n in LEAST.items():
        least = F.when(kind == name, n).otherwise(least)
    ok = (F.length(text) >= least) & ((kind != "post") | is_banglish(text))
    return ok if content_type is None else ok & (F.lower(content_type).startswith("text/html"))


def record_gate(messages: Column, text: Column, n_tokens: Column) -> Column:
    """Two messages at least, more than 50 characters, more than 10 tokens."""
    return (F.size(messages) >= 2) & (F.length(text) > 50) & (n_tokens > 10)


def generated_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Lines of a generator that are JSON records of two messages and more whose answer has no banned mark: adds user and assistant."""
    bare = strip(F.col(line))
    record = F.from_json(F.when(bare.startswith("{"), bare), "messages array<struct<role: string, content: string>>")
    out = df.withColumn("_m", record["messages"]).where("size(_m) >= 2")
    answer = F.coalesce(F.col("_m")[1]["content"], F.lit(""))
    clean = ~F.exists(F.array(*[F.lit(p) for p in BANNED]), lambda p: F.contains(answer, p))
    return out.where(clean).withColumns({"user": F.col("_m")[0]["content"], "assistant": answer}).drop("_m")


def fresh_questions(questions: DataFrame, asked: DataFrame, key: str = "question", order: str = "id") -> DataFrame:
    """Questions that were not generated before, the first of each."""
    first = questions.join(asked.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min(order).alias(order))
    return first.select(*[c for c in questions.columns if c in (key, order)])


def chat_pairs(records: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """Distinct pairs of non-empty user and assistant turns of records (category, messages) of the given categories."""
    turn = lambda role: F.element_at(F.filter("messages", lambda m: (m["role"] == role) & (F.trim(F.coalesce(m["content"], F.lit(""))) != "")), 1)["content"]
    some = records.where(F.col("category").isin(*categories) & (F.size("messages") > 0))
    has = lambda role: F.exists("messages", lambda m: (m["role"] == role) & (F.trim(F.coalesce(m["content"], F.lit(""))) != ""))
    return some.where(has("user") & has("assistant")).select(turn("user").alias("user"), turn("assistant").alias("assistant")).distinct()


def flatten_posts(posts: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Posts (listing, id, title, body, comments array<struct<id, body>>) of several listings: each post and each comment once, as (id, text), if it passes the gate for posts."""
    once = posts.groupBy("id").agg(F.min_by(F.struct("title", "body", "comments"), "listing").alias("p"))
    own = once.select("id", F.concat_ws("\n", "p.title", "p.body").alias("text"))
    said = once.select(F.explode("p.comments").alias("c")).select(F.col("c")["id"].alias("id"), F.col("c")["body"].alias("text"))
    out = own.unionByName(said).where(long_enough(F.lit("post"), F.col("text"))).groupBy("id").agg(F.min("text").alias("text"))
    return out if seen is None else out.join(seen.select("id"), "id", "left_anti")


def text_file_of(files: Column) -> Column:
    """Of an item's files array<struct<name, format>> the first scanned text, else the first plain one, else null."""
    pick = lambda test: F.get(F.filter(files, test), F.lit(0))["name"]
    return F.coalesce(pick(lambda f: f["name"].endswith("_djvu.txt")), pick(lambda f: f["name"].endswith(".txt") & (f["format"] == "Text")))


def crawl(seeds: DataFrame, links: DataFrame, depth: int = 3, per_host: int = 5000) -> DataFrame:
    """(url, host, depth) of a breadth-first walk from ``seeds`` (url) along ``links`` (a, b, both URLs) that stays on each seed's host.

    At most ``per_host`` pages of a host, by depth and then by URL: the politeness limit of a crawler. Each round joins the frontier to the links and
    drops what was seen.
    """
    host = lambda c: F.lower(F.regexp_extract(c, r"://([^/?#]*)", 1))
    seen = frontier = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    inside = links.where(host(F.col("a")) == host(F.col("b"))).select("a", "b").distinct()
    for d in range(1, depth + 1):
        step = frontier.join(inside, F.col("url") == F.col("a")).select(F.col("b").alias("url")).distinct()
        frontier = step.join(seen, "url", "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(frontier)
    hosted = seen.withColumn("host", host(F.col("url")))
    placed = numbered(hosted, "host", "depth", "url")
    first = placed.groupBy("host").agg(F.min("pos").alias("_first"))
    return placed.join(first, "host").where(F.col("pos") - F.col("_first") < per_host).select("url", "host", "depth")


# resumable sources


class FilePart(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _records(path: str, fields: tuple[str, ...]) -> Iterator[tuple]:
    """(file, line, text, metadata) of the JSON objects of a file that have a text under one of ``fields``; other lines are skipped but counted."""
    system, name = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    with io.TextIOWrapper(system.open_input_stream(name), encoding="utf-8", errors="replace") as f:  # unpacked by its suffix
        for n, line in enumerate(f):
            try:
                record = json.loads(line)
            except ValueError:
                continue
            field = next((k for k in fields if isinstance(record, dict) and isinstance(record.get(k), str)), None)
            if field is not None:
                yield path, n, record[field], {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in record.items() if k != field and v is not None}


class JsonDatasetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.fields = options["paths"].split(","), tuple(options.get("fields", "text,content,sentence").split(","))

    def partitions(self) -> list[FilePart]:
        return [FilePart(p) for p in self.paths]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        yield from _records(partition.path, self.fields)


class JsonDatasetStream(SimpleDataSourceStreamReader):
    """Batches of ``batch`` lines; the offset is the file and the line to go on from, so a restart skips what was consumed."""

    def __init__(self, options: dict):
        self.paths, self.fields = options["paths"].split(","), tuple(options.get("fields", "text,content,sentence").split(","))
        self.batch = int(options.get("batch", "1000"))

    def initialOffset(self) -> dict:
        return {"file": 0, "line": 0}

    def _between(self, start: dict, end: dict | None) -> tuple[list[tuple], dict]:
        rows, file, line = [], start["file"], start["line"]
        while file < len(self.paths):
            for row in _records(self.paths[file], self.fields):
                if row[1] < line:
                    continue
                if (end is not None and (file, row[1]) >= (end["file"], end["line"])) or (end is None and len(rows) >= self.batch):
                    return rows, {"file": file, "line": row[1]}
                rows.append(row)
            file, line = file + 1, 0
        return rows, {"file": file, "line": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._between(start, None)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._between(start, end)[0])


class JsonDataset(DataSource):
    """format("json_dataset"): files named in the option paths, one task a file, or a stream that goes on where it stopped."""

    @classmethod
    def name(cls) -> str:
        return "json_dataset"

    def schema(self) -> str:
        return "file string, line long, text string, metadata map<string, string>"

    def reader(self, schema) -> DataSourceReader:
        return JsonDatasetReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return JsonDatasetStream(self.options)


class Collector(ABC):
    """A source of documents: subclasses give raw rows, ``documents`` makes them rows of the common schema."""

    name = "unnamed"

    @abstractmethod
    def collect(self, spark: SparkSession) -> DataFrame:
        """Rows with text at least, and what else of the schema they have."""

    def documents(self, spark: SparkSession) -> DataFrame:
        raw = self.collect(spark)
        made = {"id": F.sha2(F.left("text", F.lit(128)), 256), "source": F.lit(self.name), "char_count": F.length("text").cast("long")}
        column = lambda f: (F.col(f.name) if f.name in raw.columns else made.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        return raw.select(*[column(f) for f in DOCUMENT.fields])
