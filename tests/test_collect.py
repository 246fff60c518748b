"""Collectors, sinks, tokenizers, taggers and streams on small inputs."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textkiln.functions import language as L
from textkiln.functions import normalize as N
from textkiln.functions import tokens as K
from textkiln.operators import bloom, order
from textkiln.sources import collect, readers, sinks
from textkiln.sources.chat import pair_in
from textkiln.streaming import streams


def test_named_shards_go_on_above_existing_ones(spark, tmp_path):
    folder = f"file://{tmp_path}/shards"
    rows = spark.createDataFrame([(i, f"s{i % 2}", "t", "x" * i) for i in range(25)], "k long, source string, track string, text string")
    first = sorted(tuple(r) for r in sinks.write_named_shards(rows, folder, "k", 5).collect())
    again = sorted(tuple(r) for r in sinks.write_named_shards(rows.where("source = 's1'"), folder, "k", 100).collect())
    assert [r[2] for r in first] == [0, 1, 2, 0, 1, 2] and [r[4] for r in first] == [5, 5, 3, 5, 5, 2]
    assert again == [("s1", "t", 3, "s1-t-00003.jsonl.gz", 12)]
    lines = [json.loads(x) for x in gzip.open(tmp_path / "shards" / "s0-t-00001.jsonl.gz", "rt")]
    assert [r["k"] for r in lines] == [10, 12, 14, 16, 18]


def test_ordered_shards_survive_torn_and_bad_lines(spark, tmp_path):
    whole = "".join(json.dumps({"id": str(i), "text": "t" * 50}) + "\n" for i in range(2000)).encode()
    (tmp_path / "b-0.jsonl.gz").write_bytes(gzip.compress(whole)[:-2000])
    (tmp_path / "a-0.jsonl.gz").write_bytes(gzip.compress(b'{"id": "a0", "text": "x"}\n\nnot json\n{"id": "a1", "text": "y"}\n'))
    (tmp_path / "c-0.jsonl").write_text('{"id": "c0", "text": "z"}\n')
    ranks = spark.createDataFrame([("b", 5), ("c", 9)], "source string, priority int")
    got = collect.ordered_shards(spark, str(tmp_path), ranks).orderBy("doc_index").collect()
    assert [r["doc_index"] for r in got] == list(range(len(got))) and 500 < len(got) < 2003
    assert got[0]["id"] == "c0" and [r["id"] for r in got[1:-2]] == [str(i) for i in range(len(got) - 3)] and [r["id"] for r in got[-2:]] == ["a0", "a1"]
    assert collect.ordered_shards(spark, str(tmp_path), ranks, most=2).count() == 2


def test_files_are_discovered_by_source_and_age(spark, tmp_path):
    for name in ("a-1.txt", "a-2.txt", "b-1.txt", "c.txt"):
        (tmp_path / name).write_text("x")
    found = lambda **k: sorted(r["name"] for r in collect.discover_files(spark, str(tmp_path), **k).collect())
    assert found() == ["a-1.txt", "a-2.txt", "b-1.txt", "c.txt"] and found(include=("a", "c")) == ["a-1.txt", "a-2.txt", "c.txt"]
    assert found(exclude=("a",)) == ["b-1.txt", "c.txt"] and found(min_age_s=3600) == [] and len(found(min_age_s=-5)) == 4


def test_shards_are_rewritten_once_and_shipped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.jsonl", "b.jsonl.gz"):
        data = b'{"n": 1}\n{"n": 2}\n'
        (tmp_path / "in" / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    files, target = collect.discover_files(spark, str(tmp_path / "in")), str(tmp_path / "out")
    change = lambda r: {**r, "m": r["n"] * 10} if r["n"] > 1 else None
    assert sorted(tuple(r) for r in sinks.rewrite_shards(files.where("name = 'a.jsonl'"), target, change).collect()) == [("a.jsonl", 2, 1)]
    assert [tuple(r) for r in sinks.rewrite_shards(files, target, change).collect()] == [("b.jsonl.gz", 2, 1)]
    assert sinks.rewrite_shards(files, target, change).count() == 0
    assert (tmp_path / "out" / "a.jsonl").read_text() == '{"n": 2, "m": 20}\n'
    moved = sinks.ship(collect.discover_files(spark, target), str(tmp_path / "far")).collect()
    assert all(r["done"] for r in moved) and sorted(p.name for p in (tmp_path / "far").iterdir()) == ["a.jsonl", "b.jsonl.gz"] and not any(p.suffix in (".jsonl", ".gz") for p in (tmp_path / "out").iterdir())
    import hashlib

    names = {r["name"]: (r["bytes"], r["sha256"]) for r in sinks.file_manifest(spark, str(tmp_path / "far")).collect()}
    raw = (tmp_path / "far" / "b.jsonl.gz").read_bytes()
    assert names["b.jsonl.gz"] == (len(raw), hashlib.sha256(raw).hexdigest())


def test_uint16_files_are_one_array_in_order(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(65536) for _ in range(rng.randint(0, 30))]) for i in range(200)]
    files = sinks.write_uint16(spark.createDataFrame(rows[::-1], "k long, t array<int>"), str(tmp_path / "tok"), "k", "t").orderBy("start").collect()
    whole = np.concatenate([np.fromfile(f["path"], "<u2") for f in files])
    assert whole.tolist() == [x for _, t in rows for x in t]
    assert [f["start"] for f in files] == np.cumsum([0] + [f["n"] for f in files])[:-1].tolist()
    back = readers.read_tokens(spark, str(tmp_path / "tok"))
    assert back.agg(F.sum(F.size("tokens"))).first()[0] == len(whole)
    with pytest.raises(Exception, match="16 bits"):
        sinks.write_uint16(spark.createDataFrame([(1, [70000])], "k long, t array<int>"), str(tmp_path / "bad"), "k", "t")


def test_reports_and_review(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.0)], "n int, s string, x double")
    sinks.write_report(df, str(tmp_path / "r"))
    assert collect.read_report(spark, str(tmp_path / "r")).first().asDict() == {"n": 1, "s": "a", "x": 2.0}
    rows = spark.createDataFrame([(i, "factual", 1.25, f"s{i}", f"q{i}", f"a{i}") for i in range(9)], "k int, task string, score double, source string, user string, assistant string")
    sinks.write_review(rows, str(tmp_path / "v"), 4, "k", seed=2)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "v")).collect() if r["value"]]
    assert len(lines) == 12 and lines[0].startswith("[1] task=factual score=1.25 source=s") and lines[9].startswith("[4]") and lines[1].startswith("    Q: q")
    assert {r["k"] for r in order.sample_rows(rows, 4, "k", 2).collect()} == {r["k"] for r in order.sample_rows(rows.repartition(3), 4, "k", 2).collect()}


def test_json_dataset_reads_and_goes_on(spark, tmp_path):
    spark.dataSource.register(collect.JsonDataset)
    for f in range(3):
        data = "".join(json.dumps({"content": f"{f}/{i}", "n": i}) + "\n" for i in range(25)) + "torn {\n"
        (tmp_path / f"f{f}.jsonl").write_text(data) if f else (tmp_path / f"f{f}.jsonl.gz").write_bytes(gzip.compress(data.encode()))
    paths = ",".join(str(tmp_path / n) for n in ("f0.jsonl.gz", "f1.jsonl", "f2.jsonl"))
    batch = spark.read.format("json_dataset").option("paths", paths).load().collect()
    assert {r["text"] for r in batch} == {f"{f}/{i}" for f in range(3) for i in range(25)} and batch[0]["metadata"] == {"n": "0"}
    reader = collect.JsonDatasetStream({"paths": paths, "batch": "10"})
    at, got = reader.initialOffset(), []
    for n in range(8):  # a new reader each time: only the offset is kept
        rows, to = collect.JsonDatasetStream({"paths": paths, "batch": "10"}).read(at)
        rows = list(rows)
        assert rows == list(reader.readBetweenOffsets(at, to))
        got, at = got + [r[2] for r in rows], to
    assert got == [f"{f}/{i}" for f in range(3) for i in range(25)]


def test_collector_fills_the_schema(spark):
    class Two(collect.Collector):
        name = "two"

        def collect(self, spark):
            return spark.createDataFrame([("one text", "u"), ("another", None)], "text string, url string")

    got = Two().documents(spark).collect()
    assert got[0].asDict().keys() == {f.name for f in readers.DOCUMENT} and (got[0]["source"], got[0]["url"], got[0]["char_count"], got[0]["lang"]) == ("two", "u", 8, None)
    with pytest.raises(TypeError):
        collect.Collector()


def test_bloom_filter_by_bits(spark):
    small = bloom.Bloom(1 << 12)
    keys = [f"k{i}".encode() for i in range(300)]
    assert sum(small.add(k) for k in keys) > 280 and not any(small.add(k) for k in keys)
    df = spark.createDataFrame([(i, f"t{i % 40}" if i % 41 else None) for i in range(200)], "k long, text string").repartition(5)
    want = sorted(r["k"] for r in bloom.dedup(df, "text", "k").collect())
    assert sorted(r["k"] for r in bloom.dedup(df, "text", "k", strategy="bloom").collect()) == want and len(want) == 41
    assert bloom.dedup(df, "text", "k", strategy="none").count() == 200 and bloom.bloom_dedup(df, "text", "k", bits=64, parts=4).count() < 41
    with pytest.raises(ValueError):
        bloom.dedup(df, "text", "k", strategy="other")


def test_language_models_and_taggers_are_pluggable(spark):
    df = spark.createDataFrame([("hello\nworld",), (None,), ("ß" * 6000,)], "text string")
    factory = lambda: lambda texts: [("bn", float(len(t)), 0.3 if "\n" in t else 0.0, 0.0) for t in texts]
    got = [r["v"] for r in df.select(L.model_language(F.col("text"), factory).alias("v")).collect()]
    assert [(r["score"], r["hindi"]) for r in got] == [(11.0, 0.0), (0.0, 0.0), (5000.0, 0.0)]
    reason = df.select(L.language_reason(F.struct(F.lit("bn").alias("lang"), F.lit(0.7).alias("score"), F.lit(0.3).alias("hindi"), F.lit(0.1).alias("assamese")), F.lit("ৰ"), F.lit(False)).alias("r")).first()["r"]
    assert reason == "contamination: hindi, assamese_chars"
    rows = spark.createDataFrame([(1, "native", "a"), (2, "banglish", "b"), (3, "native", None)], "i int, register string, text string").coalesce(1)
    made = lambda name: lambda: lambda texts: [(name, 1.0) for _ in texts]
    assert [(r["i"], r["label"]) for r in L.tag_by_register(rows, "text", "register", made("n"), made("o")).orderBy("i").collect()] == [(1, "n"), (2, "o"), (3, "n")]
    assert [r["label"] for r in L.tag_by_register(rows, "text", "register", made("n")).orderBy("i").collect()] == ["n", "unknown", "n"]


def test_tokens_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["The river is wide.", "", None, "été à la plage", "  two  spaces "]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    path, other = public.path("piece_bpe_32k.model"), public.path("byte_bpe_50k.json")
    model, hugging = sentencepiece.SentencePieceProcessor(model_file=path), Tokenizer.from_file(other)
    got = df.select("text", K.token_ids(F.col("text"), path, 1, 2).alias("a"), K.token_ids(F.col("text"), other).alias("b")).collect()
    for r in got:
        assert r["a"] == [1, *model.encode(r["text"] or ""), 2] and r["b"] == hugging.encode(r["text"] or "", add_special_tokens=False).ids
    back = df.where("text is not null").select("text", K.decoded(K.token_ids(F.col("text"), path), path).alias("d")).collect()
    assert all(r["d"] == model.decode(model.encode(r["text"])) for r in back)
    v = {r["id"]: r["piece"] for r in K.vocabulary(spark, path).collect()}
    assert len(v) == model.get_piece_size() and v[1] == "<s>"
    words = spark.createDataFrame([("the river the sea",)], "text string")
    f = K.fertility(words, "text", path).first()
    assert (f["n_tokens"], f["n_words"], f["round_trips"]) == (len(model.encode("the river the sea")), 4, 1)


def test_keys_of_composed_texts(spark):
    import xxhash

    r = spark.createDataFrame([("éa",)], "t string").select(F.xxhash64(N.nfc(F.col("t"))).alias("h"), N.xxh64_nfc(F.col("t")).alias("g")).first()
    assert (r["h"] & (1 << 64) - 1, r["g"] & (1 << 64) - 1) == (xxhash.xxh64_intdigest("éa".encode(), seed=42), xxhash.xxh64_intdigest("éa".encode(), seed=0))


def test_joiners_are_kept_where_they_are_valid(spark):
    one = lambda t: spark.createDataFrame([(t,)], "t string").select(N.clean_joiners(F.col("t"), keep_valid=True)).first()[0]
    h, c, zwj, zwnj = "্", "য", "‍", "‌"
    assert one(c + h + zwnj + c) == c + h + zwnj + c and one(c + zwj + h + c) == c + zwj + h + c
    assert one(c + zwnj + h) == c + h and one("a" + zwj + "b" + zwnj) == "ab" and one(h + zwj) == h and one(c + zwj + h + zwj + c) == c + zwj + h + zwj + c


def test_articles_by_marker_density_or_page(spark):
    one = lambda html, **k: spark.createDataFrame([(html,)], "t string").select(N.article_of_html(F.col("t"), **k)).first()[0]
    assert one('<div class="main story"><p>a<p>b</div><article><p>c</article>', marker="story") == "a\n\nb" and one('<article><p>c</article>', marker="story") == "c"
    assert one("<div><p>x</div><div><p>a<p>b<p>c</div>") == "a\n\nb\n\nc" and one("<p>x<div><p>y</div>") == "x\n\ny" and one("") == ""
    assert len(one("<p>" + "<p>".join(f"w{i}" for i in range(100_500))).split("\n\n")) == 100_500
    long, nav = "word " * 40, "<li><a href='x'>go to it</a></li>" * 20
    read = spark.createDataFrame([(f"<nav>{long}</nav><div>{nav}</div><section>{long}<b>end</b></section><p>short</p>",)], "t string").select(N.readable_of_html(F.col("t"))).first()[0]
    assert read == (long + "end").strip()


def test_links_are_resolved_on_their_host(spark):
    html = '<a href="/a?q"><a href="b/c#d"><a href="//X.org/e"><a href="http://y.org/f"><a href="mailto:z"><a href="#g"><a href="HTTPS://x.org/h">'
    got = spark.createDataFrame([(html, "https://X.org/p/q?r=/s")], "h string, u string").select(N.resolve_links(F.col("h"), F.col("u"))).first()[0]
    assert got == ["https://x.org/a", "https://x.org/p/b/c", "https://X.org/e"]


def test_pairs_of_any_record(spark):
    one = lambda r: spark.createDataFrame([(json.dumps(r),)], "t string").select(pair_in(F.col("t")).alias("p")).first()["p"]
    m = [{"role": "user", "content": " "}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]
    assert tuple(one({"messages": m, "prompt": "x", "response": "y"})) == ("u", "a") and tuple(one({"messages": m[:2], "prompt": "x", "response": "y"})) == ("x", "y") and one({"prompt": "x"}) is None


def test_numbers_are_gapless_where_ranges_are_sampled(spark):
    # more rows in a partition than the range partitioner samples: ranges drawn twice would differ
    df = spark.range(0, 60_000, 1, 2).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("x").alias("text"))
    got = order.numbered(df, "k", value=F.col("v"), buckets=7).orderBy("k").select("pos", "before", "v").collect()
    assert [r["pos"] for r in got] == list(range(60_000))
    assert [r["before"] for r in got] == (np.cumsum([r["v"] for r in got]) - [r["v"] for r in got]).tolist()
    groups = order.placed_in_group(df.withColumn("g", F.when(F.col("v") > 0, F.col("v"))), "g", "k").groupBy("g").agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.count_distinct("pos").alias("d")).collect()
    assert len(groups) == 7 and all(r["last"] + 1 == r["n"] == r["d"] for r in groups)


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    from textkiln.operators import storage

    with storage.scratch(spark) as folder:
        with storage.scratch(spark) as inner:
            assert inner.startswith(folder) and storage.materialize(spark.range(3), "t").count() == 3
        kept = storage.materialize(spark.range(4), "t")
        kept.write.parquet(str(tmp_path / "out"))
    import os

    assert not os.path.exists(folder.removeprefix("file://")) and spark.read.parquet(str(tmp_path / "out")).count() == 4
    with pytest.raises(ZeroDivisionError), storage.scratch(spark) as folder:
        storage.materialize(spark.range(3), "t")
        1 / 0  # noqa: B018
    assert not os.path.exists(folder.removeprefix("file://"))


# streams


def _put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def test_streams_go_on_after_a_restart(spark, tmp_path):
    schema, folder, out, offsets = "k long, text string", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        rows = streams.file_stream(spark, f"{folder}/*", spark.createDataFrame([], schema).schema)
        streams.run_available(streams.dedup_stream(rows).select("text"), out, offsets)
        return sorted(r["text"] for r in spark.read.parquet(out).collect())

    _put(spark, folder, "a", [(1, "x"), (2, "y"), (3, "x")], schema)
    assert run() == ["x", "y"] and run() == ["x", "y"]
    _put(spark, folder, "b", [(4, "y"), (5, "z")], schema)
    assert run() == ["x", "y", "z"]


def test_late_events_are_dropped_beyond_the_watermark(spark, tmp_path):
    from datetime import datetime

    schema, folder, out, offsets = "event_id long, ts timestamp, value double", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    at = lambda h: datetime(2024, 1, 1, h, 10)

    def run():
        rows = streams.file_stream(spark, f"{folder}/*", spark.createDataFrame([], schema).schema)
        streams.run_available(streams.tumbling(rows, "1 hour", late="1 hour"), out, offsets)
        return {r["start"].hour: r["n"] for r in spark.read.parquet(out).collect()}

    _put(spark, folder, "a", [(1, at(1), 1.0), (2, at(1), 1.0), (3, at(5), 1.0)], schema)
    run()
    _put(spark, folder, "b", [(4, at(1), 1.0), (5, at(5), 1.0), (6, at(9), 1.0)], schema)  # the first is too late
    got = run()
    assert got[1] == 2 and got[5] == 2 and 9 not in got


def test_replayed_batches_change_nothing(spark, tmp_path):
    seen = str(tmp_path / "seen")
    handle = streams.seen_table_batch(seen, "k")
    batch = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    handle(batch("a", "b", "a"), 0)
    handle(batch("b", "c"), 1)
    handle(batch("b", "c"), 1)  # again, after a failure
    assert sorted(r["k"] for r in streams.kept_in(spark, seen, "k string").collect()) == ["a", "b", "c"]
    near = str(tmp_path / "near")
    members = lambda *rows: spark.createDataFrame(rows, "node long, bucket string")
    handle = streams.near_seen_batch(near)
    handle(members((1, "x"), (2, "x"), (3, "y")), 0)
    for _ in range(2):
        handle(members((4, "y"), (4, "z"), (5, "z"), (6, "w")), 1)
    assert sorted({r["node"] for r in streams.kept_in(spark, near, "node long, bucket string").collect()}) == [1, 3, 5, 6]


def test_a_stream_stops_at_its_time(spark, tmp_path):
    rows = spark.readStream.format("rate").option("rowsPerSecond", 10).load().select(F.col("value").cast("string").alias("text"))
    streams.run_available(rows, str(tmp_path / "out"), str(tmp_path / "ck"), timeout=3)
    assert not spark.streams.active
