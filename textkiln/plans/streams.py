"""Sources, sinks and streams as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.operators.storage import fresh_path
from textkiln.plans.base import query, table
from textkiln.sources import readers, sinks
from textkiln.streaming import streams


@query("SELECT doc_id::VARCHAR AS id, md5(text) AS text_md5, source FROM documents")
def jsonl_round_trip(spark, d):
    """Documents written as gzip JSON shards by source and read again."""
    path = fresh_path(spark, "jsonl")
    sinks.write_shards(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "source", "lang"), path, ["lang"], 200)
    back = readers.with_shard(readers.read_jsonl(spark, path))
    return back.where("_corrupt is null").select("id", F.md5("text").alias("text_md5"), "source")


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents")
def parquet_text_scan(spark, d):
    return readers.read_parquet_text(spark, f"{d}/documents.parquet", keep=("doc_id",)).select("doc_id", F.md5("text").alias("text_md5"))


@query("SELECT count(*) AS n, sum(length(replace(text, chr(10), ' ')))::BIGINT AS chars FROM documents")
def text_sample_sink(spark, d):
    path = fresh_path(spark, "sample")
    sinks.write_text_sample(table(spark, d, "documents"), path)
    return spark.read.text(path).agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("chars"))


@query("""WITH RECURSIVE n AS (SELECT doc_id, strlen(text) + 1 AS s, row_number() OVER (ORDER BY doc_id) AS i FROM documents), f(i, chunk, held, s) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
 UNION ALL SELECT n.i, CASE WHEN f.held >= 200000 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.held >= 200000 THEN n.s ELSE f.held + n.s END, n.s FROM f JOIN n ON n.i = f.i + 1) SELECT chunk, count(*) AS docs, sum(s)::BIGINT AS bytes FROM f WHERE i > 0 GROUP BY chunk""")
def chunk_manifest(spark, d):
    return sinks.write_chunks(table(spark, d, "documents").select("doc_id", "text"), fresh_path(spark, "chunks"), "doc_id", "text", 200_000).select("chunk", "docs", "bytes")


@query("SELECT doc_id % 5 AS bucket, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1")
def bucket_tallies(spark, d):
    path = fresh_path(spark, "buckets")
    sinks.write_shards(table(spark, d, "documents").withColumn("bucket", F.col("doc_id") % 5), path, ["bucket"])
    return spark.read.schema("doc_id long, text string, bucket long").json(path).groupBy("bucket").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))


def _stream(spark, d, name) -> DataFrame:
    """The table as a stream; a folder of the table, or the file's own name in its folder."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/{name}.parquet*")


@query("SELECT sha256(text) AS sha, count(*) > 0 AS seen FROM documents GROUP BY 1")
def stream_dedup(spark, d):
    """Documents as a stream, first arrivals only, written to files and read back."""
    out, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "offsets")
    streams.run_available(streams.dedup_stream(_stream(spark, d, "documents")).select("sha", F.lit(True).alias("seen")), out, checkpoint)
    return spark.read.schema("sha string, seen boolean").parquet(out)


@query("SELECT DISTINCT source FROM documents")
def stream_seen_table(spark, d):
    """foreachBatch against a table of keys seen before."""
    seen = fresh_path(spark, "seen")
    q = _stream(spark, d, "documents").select("source").writeStream.foreachBatch(streams.seen_table_batch(seen, "source")).option("checkpointLocation", fresh_path(spark, "offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    return streams.kept_in(spark, seen, "source string")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def window_tumbling(spark, d):
    return streams.tumbling(table(spark, d, "events"), "1 hour", "event_type")


@query("SELECT b + k * INTERVAL '30 minutes' AS start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes' AS b, event_type FROM events), range(2) t(k) GROUP BY 1, 2")
def window_sliding(spark, d):
    return streams.sliding(table(spark, d, "events"), "1 hour", "30 minutes", "event_type")


@query("""WITH s AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL '2 hours' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM s)
SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, g""")
def window_session(spark, d):
    return streams.sessions(table(spark, d, "events"), "2 hours")


#: What the literal documents are routed to.
DEMO_ROUTES = (("native", "native", "ok"), ("short", "reject", "too_short"), ("banglish", "banglish", "romanized"), ("romanized", "banglish", "romanized"), ("codeswitch", "codeswitch", "codeswitch"), ("dialect", "native", "ok"), ("blocked", "reject", "blocked_script"), ("assamese", "reject", "assamese"), ("english", "reject", "english_or_other"))


@query("WITH k(k, kind, track, reason) AS (VALUES " + ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(DEMO_ROUTES)) + ") SELECT i, kind, track, reason FROM range(21) r(i) JOIN k ON i % 9 = k")
def demo_routes(spark, d):
    """The literal documents, over and over, with their routes."""
    from textkiln.functions.script import route

    return readers.demo_documents(spark, 21).select("i", "kind", route(F.col("text")).alias("v")).select("i", "kind", "v.track", "v.reason")
