"""Writers: rotated and named JSON shards, release buckets, chat files, samples, token files, size-bounded chunks, manifests, shipping."""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.functions.workers import cuts, trim
from textkiln.operators.order import numbered, size_chunks
from textkiln.operators.storage import materialize, text_batches


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def put(folder: str, name: str, data: bytes) -> None:
    """A file that appears whole or not at all."""
    system, path = _system(folder)
    system.create_dir(path, recursive=True)
    made = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(made, compression=None) as out:
        out.write(data)
    system.move(made, f"{path}/{name}")


def next_index(spark: SparkSession, folder: str) -> DataFrame:
    """(source, track, next): the index above the largest of the shards source-track-00000.jsonl.gz in the folder."""
    system, path = _system(folder)
    system.create_dir(path, recursive=True)
    named = F.regexp_extract_all(F.element_at(F.split("path", "/"), -1), F.lit(r"^(.*)-([^-]*)-(\d+)\.jsonl\.gz$"), F.lit(0))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl.gz").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    part = lambda i: F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^(.*)-([^-]*)-(\d+)\.jsonl\.gz$", i)
    return files.where(F.size(named) > 0).groupBy(part(1).alias("source"), part(2).alias("track")).agg((F.max(part(3).cast("int")) + 1).alias("next"))


def write_named_shards(df: DataFrame, folder: str, order: str, rows: int = 50_000) -> DataFrame:
    """Gzip JSON shards named source-track-00000.jsonl.gz of at most ``rows`` rows of ``df`` (source, track, ...) in order.

    Indexes go on above those in the folder, so nothing is replaced. Gives a row per shard: source, track, shard (index), name, docs.
    A shard is one task; a source of many rows is many shards.
    """
    spark = df.sparkSession
    above = materialize(next_index(spark, folder), "shard-index")
    placed = numbered(df, "source", "track", order)
    first = placed.groupBy("source", "track").agg(F.min("pos").alias("_first"))
    known = first.join(above, ["source", "track"], "left").withColumn("_next", F.coalesce("next", F.lit(0))).drop("next")
    sharded = placed.join(known, ["source", "track"]).withColumn("_shard", F.floor((F.col("pos") - F.col("_first")) / rows) + F.col("_next")).drop("pos", "_first", "_next")
    fields = [c for c in df.columns]
    lines = sharded.select("source", "track", F.col("_shard").cast("long").alias("shard"), order, F.to_json(F.struct(*fields)).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, made = None, 0, []

        def begin() -> None:
            nonlocal data, shard_file
            data = io.BytesIO()
            shard_file = gzip.GzipFile(filename="", mode="wb", compresslevel=4, fileobj=data, mtime=0)

        def flush() -> None:
            name = f"{key[0]}-{key[1]}-{key[2]:05d}.jsonl.gz"
            shard_file.close()
            put(folder, name, data.getvalue())
            made.append((*key, name, docs))

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in made], schema)
            made.clear()
            return out

        data = shard_file = None  # only compressed bytes of the open shard are held
        try:
            for batch in batches:
                for at, n in cuts(batch.column("line")):
                    part = batch.slice(at, n)
                    for source, track, shard, line in zip(*[part.column(c).to_pylist() for c in ("source", "track", "shard", "line")], strict=True):
                        if (source, track, shard) != key:
                            if key:
                                flush()
                            key, docs = (source, track, shard), 0
                            begin()
                        shard_file.write(line.encode() + b"\n")
                        docs += 1
                yield told()
            if key:
                flush()
            yield told()
        finally:
            trim()

    schema = pa.schema([("source", pa.string()), ("track", pa.string()), ("shard", pa.int64()), ("name", pa.string()), ("docs", pa.int64())])
    keys = ["source", "track", "shard"]
    dealt = lines.repartition(*keys).sortWithinPartitions(*keys, order).drop(order)
    return materialize(text_batches(dealt).mapInArrow(write, "source string, track string, shard long, name string, docs long"), "named-shards")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of the files of a folder, of what they hold on disk."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def ship(files: DataFrame, target: str, delete: bool = True) -> DataFrame:
    """Copy files (path) to another file system and then delete them: a row per file, done when its copy has the same size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                source, at = _system(path)
                name = at.rpartition("/")[2]
                with source.open_input_stream(at, compression=None) as stream:
                    put(target, name, stream.read())
                there, folder = _system(target)
                same = there.get_file_info(f"{folder}/{name}").size == source.get_file_info(at).size
                if same and delete:
                    source.delete_file(at)
                out.append((path, f"{target}/{name}", same))
            yield pd.DataFrame(out, columns=["path", "shipped", "done"])

    return materialize(files.select("path").mapInPandas(run, "path string, shipped string, done boolean"), "shipped")


def rewrite_shards(files: DataFrame, target: str, change) -> DataFrame:
    """Every JSON shard of ``files`` (path, name) that ``target`` lacks, with ``change`` (a function from record to record, or None to drop it) applied.

    A shard appears under its name when it is whole, so a run that is repeated goes on with what is missing. Gives name, n_in, n_out.
    """
    system, folder = _system(target)
    system.create_dir(folder, recursive=True)
    done = files.sparkSession.createDataFrame([(f.base_name,) for f in system.get_file_info(fs.FileSelector(folder)) if not f.base_name.startswith(".")], "name string")
    open_ = files.join(done, "name", "left_anti").select("path", "name")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name in zip(pdf["path"], pdf["name"], strict=True):
                source, at = _system(path)
                with source.open_input_stream(at, compression=None) as stream:
                    raw = stream.read()
                text = (gzip.decompress(raw) if name.endswith(".gz") else raw).decode("utf-8", "replace")
                records = [json.loads(x) for x in text.splitlines() if x.strip()]
                made = [json.dumps(r, ensure_ascii=False) for r in map(change, records) if r is not None]
                data = ("\n".join(made) + "\n" * bool(made)).encode()
                put(target, name, gzip.compress(data, 4, mtime=0) if name.endswith(".gz") else data)
                yield pd.DataFrame({"name": [name], "n_in": [len(records)], "n_out": [len(made)]})

    return materialize(open_.mapInPandas(run, "name string, n_in long, n_out long"), "rewritten")


def write_review(df: DataFrame, path: str, n: int, key: str, seed: int = 0) -> None:
    """A text file of ``n`` rows (task, score, source, user, assistant) drawn without replacement, numbered from 1."""
    from textkiln.operators.order import sample_rows

    drawn = numbered(sample_rows(df, n, key, seed), key, buckets=1)  # n rows
    entry = F.format_string("[%d] task=%s score=%.2f source=%s\n    Q: %s\n    A: %s\n", F.col("pos") + 1, "task", "score", "source", "user", "assistant")
    drawn.orderBy("pos").select(entry.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_shards(df: DataFrame, path: str, by: list[str], rows: int = 50_000, mode: str = "append") -> None:
    """Gzip JSON lines, a folder per value of ``by``, at most ``rows`` a file."""
    df.write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", rows).option("compression", "gzip").json(path)


def write_chat(df: DataFrame, path: str) -> None:
    """Only the messages column: inner fields of the build stay behind."""
    df.select("messages").write.mode("overwrite").json(path)


def write_text_sample(df: DataFrame, path: str, text: str = "text") -> None:
    """One document a line."""
    df.select(F.replace(text, F.lit("\n"), F.lit(" ")).alias("value")).write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_chunks(df: DataFrame, path: str, order: str, text: str, target: int) -> DataFrame:
    """Chunks of about ``target`` bytes in order, one folder each; gives the manifest (chunk, docs, bytes, sha256 of the texts' digests)."""
    sized = df.withColumn("_size", F.octet_length(text) + 1)
    chunks = size_chunks(sized.select(order, "_size"), order, "_size", target)
    joined = sized.join(chunks, order)
    joined.drop("_size").repartition("chunk").write.mode("overwrite").partitionBy("chunk").option("compression", "gzip").json(path)
    digests = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.sha2(text, 256).alias("d")))), lambda r: r["d"]), "")
    return joined.groupBy("chunk").agg(F.count("*").alias("docs"), F.sum("_size").alias("bytes"), F.sha2(digests, 256).alias("sha256"))


def write_uint16(df: DataFrame, path: str, order: str, tokens: str) -> DataFrame:
    """Token arrays in order as little-endian uint16 files: a row per file, path, start (tokens before it) and n. The files in order of start are
    one array, ready to be mapped or concatenated. Ids of 65536 and more are an error.
    """
    import numpy as np

    placed = numbered(df.select(order, tokens), order, value=F.size(tokens)).select("before", F.col(tokens).alias("t"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, parts = None, []
        for pdf in batches:
            if start is None and len(pdf):
                start = int(pdf["before"].iloc[0])
            for t in pdf["t"]:
                ids = np.asarray(t, np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() > 65535):
                    raise ValueError("an id doesn't fit 16 bits")
                parts.append(ids.astype("<u2").tobytes())
        if start is not None:
            context, data = TaskContext.get(), b"".join(parts)
            name = f"tokens-{context.partitionId():05d}-{context.taskAttemptId()}.bin"
            put(path, name, data)
            yield pd.DataFrame({"path": [f"{path}/{name}"], "start": [start], "n": [len(data) // 2]})

    dealt = placed.repartitionByRange("before").sortWithinPartitions("before")
    return materialize(dealt.mapInPandas(pack, "path string, start long, n long"), "uint16")
