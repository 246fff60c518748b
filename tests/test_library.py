"""Goldens and properties of functions, operators, readers, writers and streams."""

import gzip
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from textkiln.functions import normalize as N
from textkiln.functions import script as S
from textkiln.functions import sft as P
from textkiln.functions import tags as G
from textkiln.operators import dedup as D
from textkiln.operators import graph, order
from textkiln.sources import chat, readers, sinks


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("out")).first()["out"]


T = lambda: F.col("text")


@pytest.mark.parametrize("fn,text,want", [
    (N.clean_whitespace, " a  b  c \r\n\n\n\n d ", "a b c\n\nd"), (N.pipe_to_danda, "a|b 3|4 3|b", "a।b 3|4 3।b"), (N.squeeze_punctuation, "a!?.b..", "a.b.."), (N.squeeze_hasanta, "ক্্্ষ", "ক্ষ"),
    (N.drop_orphan_marks, "া ক া্খ", " ক খ"), (N.remove_symbols, "a─b中c😀☀", "abc😀☀"), (N.cleanup_lite, "see http://x.y/z me@a.bc ok", "see ok"), (N.strip_wikitext, "{{t}}[[a]] '''b'''<i>c</i>", "a bc"),
    (N.unescape, "&eacute;&amp;", "é&"), (N.nfkc, "ﬁ①", "fi1"), (N.nfc, "é", "é"), (N.collapse, " a \n b ", "a b"), (N.clean_joiners, "ক‍খ‌", "কখ"), (lambda t: N.clean_joiners(t, True), "ত্‍য ক‌", "ত্‍য ক"),
    (lambda t: N.truncate_at_sentence(t, 10), "abcdefg. hijkl", "abcdefg."), (N.clean_boilerplate, "a\nবিজ্ঞাপন x\nb", "a\nb"), (N.clean_whitespace, None, None), (N.cleanup, "", ""),
])
def test_normalization(spark, fn, text, want):
    assert one(spark, fn(T()), text) == want


def test_whitespace_cleanup_settles(spark):
    """Lines of spaces become blank lines after blank lines were squeezed, so the second pass can still change a text."""
    rng = random.Random(1)
    rows = [("".join(rng.choice(" \n\r ab।") for _ in range(40)),) for _ in range(200)]
    df = spark.createDataFrame(rows, "text string").select(N.clean_whitespace(N.clean_whitespace(T())).alias("text"))
    assert df.where(N.clean_whitespace(T()) != T()).count() == 0


@pytest.mark.parametrize("text,track,reason", [
    ("আমার দেশ " * 60, "native", "ok"), ("আমার", "reject", "too_short"), ("ami tomar kotha bhalo", "banglish", "romanized"), ("the cat is on the mat", "reject", "english_or_other"),
    ("यह हिन्दी है यह", "reject", "blocked_script"), ("অসমৰ ভাষাৰ কথা", "reject", "assamese"), ("Привет мир", "reject", "foreign_script"), ("আমার দেশের মানুষ office meeting", "codeswitch", "codeswitch"), ("12 34", "reject", "low_signal"), ("", "reject", "low_signal"),
])
def test_router(spark, text, track, reason):
    assert tuple(one(spark, S.route(T()), text)) == (track, reason)


def test_tags(spark):
    assert tuple(one(spark, G.dialect(T()), "মুই বাহে যাই")) == ("rangpur", 4) and tuple(one(spark, G.dialect(T()), "x " * 100 + "mui")) == ("standard", 0)
    s = one(spark, G.sadhu(T()), "তাহার সহিত করিয়া হইল, বলিলেন।")
    assert s["hits"] == 4 and s["cats"] == "efhi" and s["is_sadhu"]
    p = one(spark, G.profanity(T()), "damn Damn stupid")
    assert (p["hits"], p["severity"], p["count"]) == (["damn", "stupid"], "medium", 3)
    assert one(spark, G.profanity(T()), "fine")["severity"] is None
    q = one(spark, G.quality_tags(T()), "a, b, c, d, e, f, g")
    assert q["spam"] and q["short"] and one(spark, G.repetition(T()), "a\na\nb\n\n a ") == 0.5
    assert one(spark, P.repeated_ngrams(T()), "a b c " * 4) == 1.0 and one(spark, P.repeated_ngrams(T()), "a b c a b c") == 0.0
    assert [r[0] for r in spark.createDataFrame([(x,) for x in ("ODC-By", "PD-subset", "mit", "CC-BY-NC", "train-only", "x")], "l string").select(G.license_bucket(F.col("l"))).collect()] == ["releasable", "conditional", "releasable", "conditional", "train_only", "train_only"]


def test_greedy_and_components_differ(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")
    nodes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "node long")
    assert sorted(r[0] for r in graph.first_independent(nodes, edges).collect()) == [1, 3, 4]
    assert {(r["node"], r["component"]) for r in graph.components(edges).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert graph.components(edges.limit(0)).count() == 0


def test_components_of_random_graphs_and_paths(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}


def test_order_operators(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(100)], "k long, s long")
    rows = sorted((r["k"], r["pos"], r["before"]) for r in order.numbered(df, "k", value=F.col("s"), buckets=9).collect())
    total = 0
    for i, (k, pos, before) in enumerate(rows):
        assert (k, pos, before) == (i, i, total)
        total += i % 7
    split = order.split_by_position(df, "k", 1, [("a", 0.5), ("b", 0.25), ("c", 0.25)]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"a": 50, "b": 25, "c": 25}
    over = order.oversample(df.withColumn("g", F.lit("x")), "g", {"x": 250}, F.col("k"))
    assert over.count() == 250 and over.where("oversampled").count() == 150
    packed = order.pack_sequences(spark.createDataFrame([(1, [1, 2, 3]), (2, [4]), (3, [5, 6, 7])], "k long, t array<int>"), "k", "t", 3, 1).orderBy("seq").collect()
    assert [(r["start"], r["tokens"]) for r in packed] == [(1, [2, 3, 4]), (4, [5, 6, 7])]


def test_readers_and_writers(spark, tmp_path):
    with gzip.open(tmp_path / "web-0001.jsonl.gz", "wt") as f:
        f.write('{"id": "1", "text": "a"}\n\nnot json\n{"id": "2", "text": "b", "lang_score": 0.5}\n')
    rows = readers.with_shard(readers.read_jsonl(spark, str(tmp_path / "web-0001.jsonl.gz"))).collect()
    assert [(r["id"], r["_corrupt"] is None, r["shard_source"]) for r in rows if r["id"] or r["_corrupt"]] == [("1", True, "web"), (None, False, "web"), ("2", True, "web")]
    (tmp_path / "cc.txt").write_text("a\nb\n\nc\n\n\n\nd\n")
    assert sorted(r["text"] for r in readers.read_blank_separated(spark, str(tmp_path / "cc.txt")).collect()) == ["a\nb", "c", "d"]
    (tmp_path / "w.xml").write_text("<mediawiki><page><title>A</title><ns>0</ns><id>1</id><revision><text>[[x]] '''y'''</text></revision></page><page><title>B</title><ns>1</ns><id>2</id><revision><text>n</text></revision></page><page><title>C</title><ns>0</ns><id>3</id><revision><text>#REDIRECT [[A]]</text></revision></page></mediawiki>")
    assert [(r["id"], r["text"]) for r in readers.read_mediawiki(spark, str(tmp_path / "w.xml"), shortest=1).collect()] == [(1, "x y")]
    (tmp_path / "p.csv").write_text('q,a\n"x, ""y""\nz",b\n,c\n')
    assert [tuple(r) for r in readers.read_csv_pairs(spark, str(tmp_path / "p.csv"), "q", "a").collect()] == [('x, "y"\nz', "b")]
    (tmp_path / "seeds.txt").write_text("# no\n\n http://a \nhttp://b\n")
    assert [r["seed"] for r in readers.read_source(spark, "seeds", str(tmp_path / "seeds.txt")).collect()] == ["http://a", "http://b"]
    (tmp_path / "t.bin").write_bytes(struct.pack("<4H", 1, 500, 65535, 2))
    assert readers.read_tokens(spark, str(tmp_path / "t.bin")).first()["tokens"] == [1, 500, 65535, 2]
    with pytest.raises(KeyError):
        readers.read_source(spark, "nothing", "x")
    merged = readers.merge_sources([("a", spark.range(2).select(F.col("id"))), ("b", spark.createDataFrame([(5, "x")], "id long, extra string"))])
    assert sorted((r["id"], r["source_order"], r["extra"]) for r in merged.collect() if r["extra"]) == [(5, 1, "x")]
    sinks.write_chat(spark.createDataFrame([([("user", "hi")], 1)], "messages array<struct<role:string,content:string>>, meta int"), str(tmp_path / "chat"))
    assert spark.read.json(str(tmp_path / "chat")).columns == ["messages"]


def test_chat_shapes(spark):
    content = lambda j: one(spark, chat.content_of(T()), j)
    assert content('{"content": "a"}') == "a" and content('{"parts": ["a", {"text": "b"}, {"x": 1}]}') == "a\nb" and content("{}") == ""
    assert tuple(one(spark, chat.pair_of(T()), '{"input": "u", "output": "v", "prompt": "p"}')) == ("p", "v") and one(spark, chat.pair_of(T()), '{"input": "u"}') is None


def test_entry_imports_without_a_session():
    import subprocess
    import sys

    from tests.conftest import ROOT

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 0"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_full_size_near_duplicates_equal_brute_force(spark, tmp_path):
    from textkiln import plans

    rng, pool = random.Random(12), [f"w{i}" for i in range(300)]
    texts = [None, "", "a b", "a b", "abc"]
    for _ in range(12):
        base = [rng.choice(pool) for _ in range(rng.randint(20, 120))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 12)):  # also pairs that 4 bands of 4 would merge
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            texts.append(" ".join(copy))
    rows = [(i, t, "en", f"src{rng.randrange(20)}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    perms = D.permutations(128, seed=11)
    least = lambda hashes: [min((a * x + b) % D.P61 % (1 << 32) for x in hashes) for a, b in perms]

    sigs = [least([int(x) for x in h]) for h in D.gram_hashes([t or "" for t in texts])]
    run = lambda name: plans.QUERIES[name](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["sig"] for r in run("minhash_signatures_128")} == {i: ",".join(map(str, s)) for i, s in enumerate(sigs)}
    meet = lambda x, y: any(x[k : k + 8] == y[k : k + 8] for k in range(0, 128, 8))
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if meet(sigs[a], sigs[b])]
    root = {i: i for i in range(len(texts))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {i: find(i) for i in root}
    assert {r["doc_id"]: r["component"] for r in run("near_dup_components_128")} == want and 10 < len(set(want.values())) < len(want)
    assert {(r["a"], r["b"]) for r in run("lsh_band_edges_128")} <= set(pairs)
    assert sorted(r["component"] for r in run("near_dup_survivors_128") if r["kept"]) == sorted(set(want.values()))
    assert run("cluster_stats_128")[0]["kept"] == len(set(want.values()))
    chars = [least([int(x) for x in D.char_hashes([t or ""])[0]]) for t in texts]
    kept = []
    for i in range(len(texts)):
        if not any(meet(chars[i], chars[k]) for k in kept):
            kept.append(i)
    assert sorted(r["doc_id"] for r in run("greedy_near_dup_128")) == kept


def test_shingle_hashes_and_signature_limbs():
    texts = ["", "ab", "abcde", "aaaaaaaaa", "straße 日本語 😀 straße 日本語", "".join(random.Random(1).choice("abc") for _ in range(5000))]
    assert [len(h) for h in D.char_hashes(texts)] == [len({t[i : i + 5] for i in range(max(1, len(t) - 4))}) for t in texts]
    rng = random.Random(4)
    texts += ["a b", "a  b\n", "b a", "x" * 100 + " y", "x" * 101 + " y", *[" ".join(rng.choice(["a", "b", "cc", "d" * 60]) for _ in range(rng.randint(0, 40))) for _ in range(50)]]

    def grams(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    hashed = D.gram_hashes(texts)
    assert [len(h) for h in hashed] == [len(grams(t)) for t in texts]
    known = {}
    for t, h in zip(texts, hashed, strict=True):
        assert known.setdefault(frozenset(grams(t)), h.tolist()) == h.tolist() and int(h.max()) < 1 << 60
    assert len({tuple(h) for h in known.values()}) == len(known)
    edge = [((1 << 31) - 1, D.P61 - 1), (1, 0), (5, 5), (1 << 30, D.P61 - 1), *D.permutations(8)]
    for x in [0, 1, (1 << 60) - 1, (1 << 31) - 1, 1 << 31, *(rng.randrange(1 << 60) for _ in range(500))]:
        assert D.signatures_of([np.array([x], np.int64)], edge)[0].tolist() == [(a * x + b) % D.P61 % (1 << 32) for a, b in edge]
    sets = [np.array([rng.randrange(1 << 60) for _ in range(n)]) for n in (3, 1, 40, 7)]
    assert (D.signatures_of(sets, edge, block=8) == np.concatenate([D.signatures_of([x], edge) for x in sets])).all()
