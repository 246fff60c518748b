"""Each operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textkiln.llm import bpe, jaccard, lattice, mih, mixing, quality, sharding, tokenbin, urlfilter, warc
from textkiln.llm.queries import BYTE_BPE, WORD_BPE
from textkiln.operators.storage import fresh_path

RNG = random.Random(5)
WORDS = ["alpha", "beta", "Gamma", "delta,", "été", "straße", "don't", "x|y", "日本", "7", "!!", "omega."]
LONG = " ".join(RNG.choice(WORDS) for _ in range(30_000))
TEXTS = [None, "", "a", "one two three", "One  two\tthree", LONG, LONG + " end", "<|endoftext|> a", "a\n\n b ", " lead", "e\u0301 x", "  ", "Σας ΟΔΟΣ"] + [" ".join(RNG.choice(WORDS) for _ in range(RNG.randint(1, 60))) for _ in range(60)]
ROWS = [(i, t, "en", "src1" if i % 3 else None, 0) for i, t in enumerate(TEXTS)] + [(3, "one two three", "en", "src1", 0)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)


# op1


def test_sharding_law_slots_and_fields(spark, docs):
    got = sharding.shard(docs.withColumn("shard", F.lit("clash")), "doc_id", 16).collect()
    assert len(got) == len(ROWS)
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 16)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert sharding.shard(empty(spark), "doc_id", 16).count() == 0
    assert sharding.shard(spark.createDataFrame([(None, "x")] * 3, "doc_id long, text string"), "doc_id", 16).count() == 3


def _drawn(key, leaves, seed=0):
    """The shard of an integer key: the least -ln(u) / weight of the children at each level."""
    import xxhash

    path, among = "", leaves
    for level in range(3):
        groups = {}
        for x in among:
            groups.setdefault((x.region, x.rack, x.shard)[level], []).append(x)
        best = []
        for g in sorted(groups):
            h = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed=xxhash.xxh64_intdigest(f"{seed}/{path}/{g}".encode(), seed=42))
            best.append((-math.log(((h >> 11) + 0.5) / 2**53) / sum(x.weight for x in groups[g]), g))
        g = min(best)[1] if len(best) > 1 else best[0][1]
        path, among = f"{path}/{g}", groups[g]
    return among[0].shard


def test_shards_equal_plain_draws(spark):
    got = sharding.shard(spark.range(600).select((F.col("id") * 7919 - 1000).alias("doc_id"), F.lit("x").alias("text")), "doc_id", 16).collect()
    for r in got:
        assert r["shard"] == _drawn(r["doc_id"], sharding.tree(16)) and r["grown_shard"] == _drawn(r["doc_id"], sharding.tree(17))
    heavy = sharding.tree(20, weights={3: 2.5, 18: 0.5})
    placed = spark.range(300).select("id", sharding.assign(F.col("id"), heavy, 9).alias("s")).collect()
    assert all(r["s"] == _drawn(r["id"], heavy, 9) for r in placed)


def test_sharding_growth_weights_and_subtrees(spark):
    keys = spark.range(40_000)
    place = lambda leaves: [r[0] for r in keys.select(sharding.assign(F.col("id"), leaves)).collect()]
    base = place(sharding.tree(16))
    assert max(Counter(base).values()) < 1.15 * 2500
    for n in (16, 17, 20):
        a, b = place(sharding.tree(n)), place(sharding.tree(n + 1))
        moved = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
        assert all(y == n for _, y in moved) and 0.7 < len(moved) / (40_000 / (n + 1)) < 1.3
    heavy = place(sharding.tree(16, weights={5: 3.0}))  # region 0, rack 1
    assert not any(x >= 8 and y >= 8 and x != y for x, y in zip(base, heavy, strict=True))
    assert not any(x < 4 and y < 4 and x != y for x, y in zip(base, heavy, strict=True))
    assert heavy.count(5) > 2 * base.count(5)
    with pytest.raises(ValueError):
        sharding.tree(2, weights={0: 0.0})


# op2


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(-(1 << 63), 1 << 63, 700)
    codes[100:140] = codes[100]  # a hot code
    for i in range(200, 300):
        codes[i] = int(np.int64(codes[200]) ^ np.int64(1 << int(rng.integers(0, 63))))
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(700, None), (None, 5), (0, int(codes[0]))]
    df = spark.createDataFrame(rows, "id long, code long").withColumn("rank", F.lit(1))
    want = {}
    for q in range(0, 700, 20):
        d = sorted(((int(codes[q]) ^ int(codes[i])) & (1 << 64) - 1).bit_count() * 1000 + i for i in range(700) if i != q)[:7]
        want |= {(q, k + 1): (x % 1000, x // 1000) for k, x in enumerate(d)}
    for segments in (8, 4):
        got = [(r["query_id"], r["rank"], r["neighbor_id"], r["distance"]) for r in mih.top_k(df, df.where("id % 20 = 0"), 7, segments=segments).collect()]
        assert len(got) == len(want) and {x[:2]: x[2:] for x in got} == want
    assert mih.top_k(df.limit(0), df, 3).count() == 0 and mih.top_k(df, df.limit(0), 3).count() == 0
    few = spark.createDataFrame([(1, 5), (2, 4), (3, -1), (3, -1)], "id long, code long")
    assert sorted(tuple(r) for r in mih.top_k(few, few, 7).collect()) == [(1, 1, 2, 1), (1, 2, 3, 62), (2, 1, 1, 1), (2, 2, 3, 63), (3, 1, 1, 62), (3, 2, 2, 63)]


def test_probes_are_all_values_at_a_radius(spark):
    q = 0x123456789ABCDEF0
    df = spark.createDataFrame([(q, None)], "q long, bound int")
    for segments, radius in ((8, 0), (8, 3), (4, 2), (2, 1)):
        width = 64 // segments
        got = [(r["s"], r["value"]) for r in mih._probes(df, segments, radius).collect()]
        assert len(got) == segments * math.comb(width, radius) == len(set(got))
        assert all(((q >> width * s) & (1 << width) - 1 ^ v).bit_count() == radius and v >> width == 0 for s, v in got)


def test_sign_code(spark):
    v = [1.0 if i % 3 == 0 else -1.0 for i in range(64)]
    r = spark.createDataFrame([(v,), (v[:10],), (None,), ([None] * 64,), (v + v,)], "v array<float>").select(mih.sign_code(F.col("v")).alias("c")).collect()
    assert (r[0]["c"] & (1 << 64) - 1) == sum(1 << i for i in range(0, 64, 3)) and r[1]["c"] is None and r[2]["c"] is None and r[3]["c"] == 0 and r[4]["c"] is None


# op3


def _links(rows, threshold):
    ok = [(i, np.array(v, float), x) for i, v, x in rows if i is not None and v and x is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    pairs = [(a[0], b[0]) for n, a in enumerate(ok) for b in ok[n + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= threshold]
    root, links = {i: i for i, _, _ in rows}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        links[a] += 1
        links[b] += 1
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in root}


def test_lattice_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = []
    for c in range(30):
        center = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((center + 0.08 * rng.standard_normal(64)).tolist())
    hot = rng.standard_normal(64)
    rows += [(hot + 0.07 * rng.standard_normal(64)).tolist() for _ in range(150)] + [rows[0]] * 3
    table = [(i, v, i % 2 if i < 60 else 1) for i, v in enumerate(rows)]
    n = len(table)
    table += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [float("nan")] + [1.0] * 63, 1), (n + 3, [None] * 64, 1), (n + 4, rows[0], None), (n + 5, [], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [1.0, 2.0], 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit(1))
    stored = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    monkeypatch.setattr(lattice, "PART_ROWS", 40)  # splits the hot cells
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(df).collect()}
    want = _links(stored, 0.98)
    assert got == want and sum(a for a, _ in want.values()) > 1000
    assert lattice.near_duplicates(df.limit(0)).count() == 0
    monkeypatch.setattr(lattice, "BROADCAST_CELLS", 0)
    named = df.withColumn("label", F.concat(F.lit("kind "), F.col("label").cast("string")))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(named).collect()} == want
    halves = df.where("vec_id < 60").withColumn("label", F.col("label") + F.col("vec_id") % 4 / 4.0)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(halves).collect()}
    assert got == _links([(i, v, x + i % 4 / 4.0) for i, v, x in stored if i < 60], 0.98)


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8)) * 2
    p = lattice.decode_e8(x)
    assert ((p * 2) % 1 == 0).all() and len(lattice.roots()) == 240
    best = ((x - p) ** 2).sum(1)
    for r in lattice.roots():
        assert (((x - p - r) ** 2).sum(1) >= best - 1e-9).all()


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((3000, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    label = np.zeros(3000, np.int64)
    a, b = (lattice.cells(v, label, lattice.TABLES, lattice.PROBES, lattice.SCALE, 7) for v in (x, y))
    hit = [(b[:, t] == a[:, t, :1]).any(1) | (a[:, t] == b[:, t, :1]).any(1) for t in range(lattice.TABLES)]
    assert np.any(hit, 0).mean() > 0.995


# op4


def test_mixing_inverts_poisson(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, F.lit("big")).otherwise(F.lit("small")).alias("source"), F.lit("abcd").alias("text"))
    got = mixing.replicate(df, {"big": 1.0, "small": 1.0}, seed=1).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).collect()
    n = {r["source"]: r["n"] for r in got}
    assert abs(n["big"] - 10_000) < 500 and abs(n["small"] - 10_000) < 500
    distinct = {r["source"]: r["d"] for r in got}
    assert abs(distinct["big"] / 15_000 - (1 - math.exp(-2 / 3))) < 0.02 and abs(distinct["small"] / 5000 - (1 - math.exp(-2))) < 0.02


def _plain_copies(rows, weights, default, seed):
    """Copies of each row (doc_id, source, text) by inversion of the Poisson distribution."""
    size = Counter()
    for _, source, text in rows:
        size[source] += len((text or "").encode())
    weight = {s: weights.get(s, default) if size[s] else 0.0 for s in size}
    out = []
    for i, source, _ in rows:
        rate = weight[source] * sum(size.values()) / sum(weight.values()) / size[source] if size[source] and weight[source] else 0.0
        draws = max(1, math.ceil(rate / 16))
        n = 0
        for k in range(draws):
            u = int(hashlib.md5(f"{seed}:{'null' if i is None else i}:{k}".encode()).hexdigest()[:13], 16) / 2**52
            p = below = math.exp(-rate / draws)
            j = 0
            while below <= u and j < 84:
                j += 1
                p *= rate / draws / j
                below += p
                n += 1
        out.append(n)
    return out


def test_mixing_equals_plain_inversion(spark):
    rng = random.Random(8)
    rows = [(i if i % 17 else None, rng.choice(["a", "b", "c", None, "empty"]), None) for i in range(400)]
    rows = [(i, s, None if s == "empty" else "x" * rng.randint(0, 40)) for i, s, _ in rows] + [(9, "a", "again")] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    got = mixing.replicate(df, {"a": 3.0, "b": 0.0}, default=1.5, seed=5).collect()
    want = Counter()
    for row, n in zip(rows, _plain_copies(rows, {"a": 3.0, "b": 0.0}, 1.5, 5), strict=True):
        want.update({(*row, k): 1 for k in range(n)})
    assert Counter((r["doc_id"], r["source"], r["text"], r["copy_no"]) for r in got) == want and len(want) > 200
    name = lambda r: f"order5:{'null' if r['doc_id'] is None else r['doc_id']}:{r['copy_no']}"
    assert all(r["shuffle_key"] == hashlib.md5(name(r).encode()).hexdigest()[:16] for r in got)
    assert [r["shuffle_key"] for r in got] == sorted(r["shuffle_key"] for r in got)


def test_mixing_large_rates_and_edges(spark, docs):
    one = spark.createDataFrame([(i, "s", "x") for i in range(50)], "doc_id long, source string, text string")
    counts = [r["c"] for r in mixing.replicate(one, {"s": 1.0}, total=50 * 300.0, seed=2).groupBy("doc_id").agg(F.count("*").alias("c")).collect()]
    assert abs(np.mean(counts) - 300) < 8 and 10 < np.std(counts) < 25
    out = mixing.replicate(docs.withColumn("rate", F.lit("clash")), {"src1": 1.0}, default=1.0, seed=3)
    assert {r["source"] for r in out.collect()} == {"src1", None}
    keys = [r["shuffle_key"] for r in out.collect()]
    assert keys == sorted(keys)
    assert mixing.replicate(empty(spark), {"src1": 1.0}).count() == 0 and mixing.replicate(docs, {}).count() == 0


# op5


def test_warc_round_trip(spark):
    html = ["<p>a</p>", None, "", "x\r\n\r\ny" * 5, "<p>a</p>", "ü" * 100_000, "<p>a</p>"]
    rows = [(i, None if i == 2 else f"http://h{i}.org/p?q=1\n{i}", h, "extra") for i, h in enumerate(html)] + [(6, "http://h6.org/p?q=1\n6", "<p>a</p>", "extra"), (None, "u", "<p>a</p>", "e"), (None, "u", "solo", "e")]
    files = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, record_type string"), fresh_path(spark, "warc"))
    got = warc.captures(files, payload=True).collect()
    assert len(got) == len(rows) and all(r["digest_holds"] == (True if r["record_type"] == "response" else None) and r["n_records"] == 3 for r in got)
    thin = lambda rows: sorted(((r["page_id"] is None, r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)
    assert thin(warc.captures(files).collect()) == thin(got)
    top = {}
    for i, _, h, _ in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h, _ in rows:
        raw, t = (h or "").encode(), top[h or ""]
        first = t == -1 or i == t
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else t] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert all(bytes(r["payload"]).decode() == (rows[r["page_id"]][2] or "") for r in got if r["payload"] is not None and r["page_id"] is not None)
    assert all(r["request"] and r["metadata"] for r in got)
    assert warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), fresh_path(spark, "warc")).count() == 0


def test_warc_keeps_captures_that_share_page_id_and_url(spark):
    rows = [(None, "u", "one"), (None, "u", "two"), (None, None, "three"), (None, None, "three"), (None, "u", "one"), (None, "None", "n"), (None, None, "n")]
    rows += [(1, "v", "old"), (1, "v", "new"), (1, "v", "shared"), (0, "w", "shared"), (2, "x", "twice"), (2, "x", "twice"), (2, "x", "once"), (1, "w", "twice")]
    files = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), fresh_path(spark, "warc"))
    got = warc.captures(files).collect()
    sha = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    assert Counter((r["page_id"], r["url"], r["payload_digest"]) for r in got) == Counter((i, u or "", sha(h)) for i, u, h in rows)
    assert {(r["page_id"], r["refers_to"], r["payload_digest"]) for r in got if r["record_type"] == "revisit"} == {(0, 1, sha("shared")), (1, 2, sha("twice"))}
    ids = {r["response"]["record_id"]: r for r in got}
    named = [ids[r["response"]["refers_to"]] for r in got if r["record_type"] == "revisit" and r["response"]["refers_to"]]
    assert len(ids) == len(rows) and [(r["page_id"], r["record_type"], r["payload_digest"]) for r in named] == [(1, "response", sha("shared"))]


@pytest.mark.parametrize("least", [0, 4])
def test_warc_by_shuffle_equals_broadcast(spark, monkeypatch, least):
    rows = [(i, f"http://h/{i % 3}", "same" if i % 2 else "x" * (i % 5)) for i in range(60)]
    df, got = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), []
    for bound in (100_000, 0):
        monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", bound)
        files = warc.write_archives(df, fresh_path(spark, "warc"), least=least, file_bytes=2000)
        assert files.count() > 4
        got.append(sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"] or -1) for r in warc.captures(files).collect()))
    top = {h: max(i for i, _, x in rows if x == h) for _, _, h in rows}
    want = sorted((i, len(h), "response" if top[h] == i or len(h) < least else "revisit", -1 if top[h] == i or len(h) < least else top[h]) for i, _, h in rows)
    assert got == [want, want]


def test_assembly_keeps_lonely_records(spark):
    made = lambda capture, own, kind, position: ("f", position, capture, own, kind, "u", "d", None, None, None, 1, "s")
    rows = [made("a", "a", "response", 0), made("b", "r1", "request", 1), made("a", "r2", "request", 2), made("a", "r3", "request", 3), made("a", None, "request", 4), made("a", "r2", "request", 5)]
    got = {r["capture"]: r for r in warc.assemble(spark.createDataFrame(rows, warc.RECORDS_DDL)).collect()}
    assert got["b"]["response"] is None and (got["a"]["request"]["record_id"], got["a"]["request"]["position"]) == ("r2", 2) and got["a"]["n_records"] == 5
    assert warc.assemble(spark.createDataFrame([], warc.RECORDS_DDL)).count() == 0


def test_http_headers_of_any_length_are_split():
    http = {"content-type": "application/http; msgtype=response"}
    long = b"HTTP/1.1 200 OK\r\nX: " + b"y" * 10_000 + b"\r\n\r\nbody\r\n\r\nrest"
    assert warc.payload_of(http, long) == b"body\r\n\r\nrest" and warc.payload_of(http, b"HTTP/1.1 200 OK") == b"" and warc.payload_of({}, b"a\r\n\r\nb") == b"a\r\n\r\nb"


# op6, op9


def test_bpe_equals_the_library(spark, docs):
    t = Tokenizer.from_file(WORD_BPE)
    whole = bpe.decode_documents(bpe.encode_documents(docs.withColumn("ids", F.lit(1)), WORD_BPE), WORD_BPE).collect()
    digests = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, WORD_BPE).collect()}
    for r in whole:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == t.decode(ids, skip_special_tokens=False)
        assert (r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest()) in digests
    assert bpe.digests(empty(spark), WORD_BPE).count() == 0


def test_chunks_are_reused_and_joins_repaired():
    import pyarrow as pa

    text = " ".join("".join(RNG.choice(["pre", "anti", "dis", "est", "ing", "ment", "a", "o"]) for _ in range(RNG.randint(1, 12))) for _ in range(4000))
    shared = text[5000:9000]
    docs = [text, "start " + shared + " end", shared, "x" * 50_000, "ab " * 5000 + "c", "y" + shared.replace(" ", "")]
    t = Tokenizer.from_file(WORD_BPE)
    got = [x.tolist() for _, ids in bpe.encoded(iter([pa.record_batch([pa.array(docs)], names=["text"])]), WORD_BPE) for x in ids]
    assert got == [t.encode(d, add_special_tokens=False).ids for d in docs]
    data = np.frombuffer(docs[0].encode() + docs[1].encode(), np.uint8)
    off = np.array([0, len(docs[0]), len(data)])
    at = bpe.cuts(data, off)
    pieces = lambda a, b: {data[x:y].tobytes() for x, y in zip([a, *at[(at > a) & (at < b)]], [*at[(at > a) & (at < b)], b], strict=True)}
    assert len(pieces(off[0], off[1]) & pieces(off[1], off[2])) > 5


def test_words_fuzz():
    from textkiln.llm.words import encoder

    word, byte = Tokenizer.from_file(WORD_BPE), Tokenizer.from_file(BYTE_BPE)
    marks = ["a", "B", "'s", " ", "  ", "\n", "\t", "é", "e\u0301", "İ", "ß", "<|endoftext|>", "1", "٣", ",", "!!", "\u00a0", "\u200b", "日", "😀", "²", "_", "x.y", "\x1c", "\r", "\u3000", "\u2003", "\ufeff", "’", "longwordlongwordlongword", "Σ", "\u0301", "\x85", "<", "|", "\x00", "a" * 16, "b" * 17]
    for _ in range(1500):
        s = "".join(RNG.choice(marks) for _ in range(RNG.randint(0, 25)))
        for t, e in ((word, encoder(WORD_BPE, False)), (byte, encoder(BYTE_BPE, True))):
            assert e.encode(s).tolist() == t.encode(s, add_special_tokens=False).ids, repr(s)


def test_pieces_are_looked_up_together(monkeypatch):
    from textkiln.llm import words

    monkeypatch.setattr(words, "MAX_PIECES", 300)  # the table is emptied again and again
    monkeypatch.setattr(words, "BLOCK", 700)
    texts = ["".join(RNG.choice(["ab", "c ", " d", "\n", "é,", "f!?", "<|endoftext|>", "g" * 20, "1"]) for _ in range(RNG.randint(0, 60))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    for path, spaced in ((WORD_BPE, False), (BYTE_BPE, True)):
        t, (ids, at) = Tokenizer.from_file(path), words.Encoder(path, spaced).encode_texts(data, off)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_chunks_of_texts_with_paragraphs():
    t, chunks = Tokenizer.from_file(WORD_BPE), bpe.ChunkEncoder(bpe.encoder(WORD_BPE, False))
    parts = ["alpha beta ", "gam", "ma ", "é", "\n\n", "\t", "  ", "İ", "\u0301", "x" * 30, "!! ", "\u3000", "\u00a0", "Σας "]
    texts = ["".join(RNG.choice(parts) for _ in range(RNG.randint(0, 300))) for _ in range(200)] + ["<|endoftext|> a  b " * 40, "", "  \n "]
    raw = [x.encode() for x in texts]
    for _ in range(2):
        got = chunks.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
        assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert chunks.reused > chunks.encoded > 200 and len(chunks.joins) > 100 and chunks.unrepaired == 0


def test_token_files(spark, docs):
    t = Tokenizer.from_file(BYTE_BPE)
    got = tokenbin.read_token_files(tokenbin.write_token_files(docs, BYTE_BPE, fresh_path(spark, "ids"))).orderBy("start").collect()
    rows = sorted(((r[0], r[1] or "") for r in ROWS), key=lambda r: r[0])
    start = 0
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"], r["ids_crc32"]) == (doc_id, start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    none = spark.createDataFrame([(None, "x"), (None, None), (1, "y"), (-(1 << 63), "z"), (1, "y")], "doc_id long, text string").withColumn("h", F.lit("clash"))
    back = tokenbin.read_token_files(tokenbin.write_token_files(none, BYTE_BPE, fresh_path(spark, "ids"))).collect()
    assert sorted((r["doc_id"] or 0, r["doc_id"] is None, r["n_tokens"]) for r in back) == [(-(1 << 63), False, 2), (0, True, 1), (0, True, 2), (1, False, 2), (1, False, 2)]
    assert tokenbin.read_token_files(tokenbin.write_token_files(empty(spark), BYTE_BPE, fresh_path(spark, "ids"))).count() == 0


def test_repair_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 40, int(n)).astype(np.uint32) for n in rng.integers(0, 900, 200)] + [np.full(5000, 7, np.uint32), np.zeros(0, np.uint32)]
    sizes = np.array([len(x) for x in ids])
    f = tokenbin.TokenFile(tokenbin.pack(np.concatenate(ids), sizes, np.arange(len(ids)), 50257))
    order = rng.permutation(len(ids))
    assert all((f.ids(i) == ids[i]).all() and len(f.ids(i)) == len(ids[i]) == f.sizes[i] for i in order) and (f.ids(3, 90) == np.concatenate(ids[3:90])).all()
    assert len(f.rules) > 50 and len(f.symbols) < 0.6 * sum(map(len, ids)) and int(f.lengths.max()) >= 4
    with pytest.raises(ValueError):
        tokenbin.TokenFile(b"12345678")


@pytest.mark.parametrize("seed", range(6))
def test_repair_goes_on_until_no_pair_is_frequent(seed):
    rng = np.random.default_rng(seed)
    phrase = rng.integers(0, 60, 40).astype(np.uint32)
    ids = [np.concatenate([phrase[rng.integers(0, 20) : rng.integers(20, 40)], rng.integers(0, 6 + seed, int(n)).astype(np.uint32), np.full(int(n) % 9, 3, np.uint32)]) for n in rng.integers(0, 60, 300)]
    x, last = np.concatenate(ids), np.zeros(sum(map(len, ids)), bool)
    last[np.cumsum([len(i) for i in ids]) - 1] = True
    symbols, ends, rules = tokenbin.build_grammar(x, last, 100, least=5)
    assert (tokenbin.Grammar(rules, 100).expand(symbols) == x).all() and ends.sum() == len(ids)
    left, at = Counter(), 0
    while at < len(symbols) - 1:  # occurrences that don't overlap, from the left
        pair = int(symbols[at]), int(symbols[at + 1])
        left[pair] += not ends[at]
        at += 2 if pair[0] == pair[1] and not ends[at] else 1
    assert max(left.values()) < 5
    made = Counter(s for pair in rules.tolist() for s in pair) + Counter(symbols.tolist())
    assert all(made[100 + i] > 0 for i in range(len(rules)))  # every rule is used


def test_packed_symbols_of_all_widths():
    rng = np.random.default_rng(0)
    for top in (300, 1 << 16, (1 << 16) + 1, 1 << 17, 1 << 18, 1 << 20, 1 << 24, (1 << 24) + 5):
        for n in (0, 1, 7, 8, 1001):
            x = rng.integers(0, top, n).astype(np.uint32)
            bits, raw = tokenbin.pack_symbols(x, top)
            assert (tokenbin.unpack_symbols(b"abc" + raw, 3, n, bits) == x).all()


# op7


def _groups(rows, n, percent):
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_groups_equal_brute_force(spark, n, percent, monkeypatch):
    rng = random.Random(n)
    rows, words = [], [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [" ".join([rng.choice(words) for _ in range(40)] + passage) for _ in range(20)] + [None, "", "  \t ", "A b", "a B", "ab", "x" * 100_000, rows[0], rows[0].upper()]
    table = list(enumerate(rows))
    monkeypatch.setattr(jaccard, "PART_SETS", 3)  # splits groups
    df = spark.createDataFrame(table, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_groups(df, n=n, percent=percent).collect()}
    assert got == _groups(table, n, percent)


def test_jaccard_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "A B C D E")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in jaccard.similarity_groups(df, n=4, percent=85).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1)]
    assert jaccard.similarity_groups(empty(spark)).count() == 0


def test_common_passages_dont_tie_all_documents_into_one_group(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    common, rows = [word() for _ in range(66)], []
    for _ in range(40):
        family = [word() for _ in range(32)]
        rows += [" ".join(common + family + [word() for _ in range(own)]) for own in (3, 6, 10)]  # of a family the first two link
    made, whole = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: made.setdefault(name, whole(df, name)))
    table = list(enumerate(rows))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_groups(spark.createDataFrame(table, "doc_id long, text string"), n=4, percent=85).collect()}
    assert got == _groups(table, 4, 85) and len({c for _, c in got.values()}) < len(rows)
    sizes = [r["count"] for r in made["members"].groupBy("grp").count().collect()]
    assert max(sizes) <= 30 and len(sizes) >= 20  # each text goes to a block for every 512 sets of its group


@pytest.mark.parametrize("seed", range(3))
def test_sets_that_share_enough_signatures_share_a_rare_one(spark, seed):
    rng = random.Random(seed)
    sets = {i: {rng.choice((rng.randrange(12), rng.randrange(400))) for _ in range(30)} for i in range(60)}
    holders = {s: sum(s in x for x in sets.values()) for s in range(400)}
    need = {i: rng.randint(1, 14) for i in sets}
    rows = [(i, 0, s, need[i], holders[s]) for i, x in sets.items() for s in x if holders[s] > 1]
    left = {i: set() for i in sets}
    for r in jaccard.rarest(spark.createDataFrame(rows, "node long, class int, sig long, need int, holders int")).collect():
        left[r["node"]].add(r["sig"])
    assert all(left[a] & left[b] for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= max(need[a], need[b]))
    assert all(len(left[i]) == max(0, sum(r[0] == i for r in rows) - need[i] + 1) for i in sets)


def test_only_texts_of_candidates_are_dealt(spark):
    docs = spark.range(-500, 4000).selectExpr("id as doc_id", "'x' as text")
    ids = spark.createDataFrame([(i,) for i in (-500, -1, 0, 63, 64, 3999)], "rep long")
    got = [r["doc_id"] for r in jaccard.among(docs, ids).collect()]
    assert {-500, -1, 0, 63, 64, 3999} <= set(got) and len(got) == len(set(got)) < 20
    assert jaccard.among(docs, ids.limit(0)).count() == 0


@pytest.mark.parametrize("sets,each", [(1, 1), (1, 40), (300, 1), (50, 7)])
def test_blobs_of_signatures_round_trip_and_are_small(sets, each):
    rng = np.random.default_rng(sets)
    node, kind, need = rng.integers(-(1 << 63), 1 << 63, sets), rng.integers(0, 120, sets), rng.integers(1, 1 << 31, sets)
    own, sigs = np.repeat(np.arange(sets), each), rng.integers(0, 1 << 63, sets * each, np.uint64)
    blob = jaccard.packed(node, kind, need, own * 3 + 5, sigs)  # places may be those of a larger table
    got = jaccard.unpacked(blob)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, (node, kind, need, own, sigs & np.uint64((1 << 48) - 1)), strict=True))
    assert len(blob) <= 9 + 13 * sets + 6.125 * sets * each  # 16 and 10 bytes before


def test_sets_that_share_a_node_are_told_apart(spark, monkeypatch):
    whole = jaccard.node_of

    def narrow(grams, salted=frozenset()):  # four identities for all sets
        node, check = whole(grams)
        return (check, node % 4) if node % 4 in salted else (node % 4, check)

    monkeypatch.setattr(jaccard, "node_of", narrow)
    table = [(i, " ".join(f"w{(i // 3) * 7 + k}" for k in range(30)) + (" x" if i % 3 == 2 else "")) for i in range(45)]
    df = spark.createDataFrame(table, "doc_id long, text string").coalesce(1)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(jaccard)
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_groups(df).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(jaccard)
    assert got == _groups(table, 5, 80)


def test_prefix_tree_finds_all_pairs():
    rng = np.random.default_rng(8)
    sets = []
    for _ in range(20):
        base = np.unique(rng.integers(0, 500, int(rng.integers(3, 80)), np.uint64))
        sets += [np.unique(np.concatenate((rng.permutation(base)[int(rng.integers(0, 4)) :], rng.integers(0, 500, 2, np.uint64)))) for _ in range(4)]
    i, j = jaccard.tree_join(sets, None, 80)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert {(int(a), int(b)) for a, b in zip(i, j, strict=True)} == want and want


# op8


def test_url_parts_and_rules(spark):
    urls = [None, "", "nothing", "http://A.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://x.org", "http://x.org/", "https://b.com/fr/", "https://com/de/x", "http://notorg/", "http://h?q=://z/", "a://b#c", "http://cheappills.example.net/\nen/"]
    want = {None: ("", ""), "": ("", ""), "nothing": ("", ""), "http://A.Example.ORG/es/1": ("a.example.org", "/es/1"), "http://x.org": ("x.org", ""), "http://h?q=://z/": ("h", ""), "a://b#c": ("b", "")}
    rules = {"http://A.Example.ORG/es/1": ("example.org/es/", "block"), "http://example.org/en/12?x#y": ("example.org/en/1", "block"), "http://x.org": (None, None), "http://x.org/": ("org/", "allow"), "https://b.com/fr/": ("com/fr/", "allow"), "https://com/de/x": ("com/de/", "block"), "http://notorg/": (None, None)}
    df = spark.createDataFrame([(i, u, "<p>cheap words and pills and words</p>" * (1 + i % 3)) for i, u in enumerate(urls)], "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {urls[r["page_id"]]: r for r in urlfilter.judge(df).collect()}
    for u, parts in want.items():
        assert (got[u]["host"], got[u]["path"]) == parts
    for u, (rule, verdict) in rules.items():
        assert got[u]["rule"] == rule and (verdict is None or got[u]["verdict"] == verdict)
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    assert got[urls[-1]]["verdict"] == "block" and got[urls[-1]]["path"] == "/\nen/"
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_segmentation_is_the_cheapest_split():
    s = urlfilter.Segmenter({"cheap": 50, "pills": 40, "che": 3, "ap": 3, "online": 10})
    assert s.split("cheappillsonline") == ["cheap", "pills", "online"]
    assert s.split("zzcheap") == ["zz", "cheap"] and s.split("") == [] and "".join(s.split("q" * 500)) == "q" * 500


def _judged(rows):
    """Verdicts of rows (page_id, url, html) by plain Python."""
    import re

    counts, pages = Counter(), []
    for i, url, html in rows:
        bare = re.sub(r"<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", " ", html or "", flags=re.S)
        counts.update(re.findall("[a-z]+", bare.lower()))
        w = bare.split()
        junk = len(w) < 5 or 1 - len(set(w)) / len(w) >= 0.8 or sum(bool(re.search(r"([^\w\s])\1\1", x)) for x in w) / len(w) >= 0.3
        _, found, rest = (url or "").partition("://")
        host = re.split("[/?#]", rest)[0] if found else ""
        path = re.split("[?#]", rest[len(host) :])[0] if found else ""
        pages.append((i, "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path, junk))
    total = sum(counts.values())
    for w in (*urlfilter.BLOCK_SEEDS, *urlfilter.ALLOW_SEEDS):
        counts[w] = max(counts[w], 1, int(total * 1e-4))

    def split(name):  # all splits by recursion over the last piece
        best = [(0.0, [])]
        for end in range(1, len(name) + 1):
            tries = []
            for start in range(max(0, end - 32), end):
                w = name[start:end]
                cost = math.log((total + 1) / counts[w]) if len(w) > 1 and counts.get(w) else math.log(total + 1) + 2 + 3 * len(w)
                tries.append((best[start][0] + cost, best[start][1] + [w]))
            best.append(min(tries, key=lambda t: t[0]))
        return best[-1][1]

    def tokens(host, path):
        names, out = host.split("."), []
        for mark, text in (("h", ".".join(names[:-1])), ("p", path.lower())):
            for run in re.findall("[a-z]{1,256}|[0-9]+|[^\x00-\x7f]{1,256}", text):
                out += [f"{mark}:0"] if run[0] in "0123456789" else [f"{mark}:{w}" for w in (split(run) if "a" <= run[0] <= "z" else [run])]
        return out + ([f"t:{names[-1]}"] if names[-1] else [])

    seeds_seen, seen, urls = Counter({(f"{m}:{w}", side): 5 for side, seeds in enumerate((urlfilter.ALLOW_SEEDS, urlfilter.BLOCK_SEEDS)) for m in "hp" for w in seeds}), Counter(), Counter()
    facts = []
    for i, host, path, junk in pages:
        t = tokens(host, path)
        bare = {x[2:] for x in t if x[0] != "t"}
        side = int(junk or (bool(bare & set(urlfilter.BLOCK_SEEDS)) and not bare & set(urlfilter.ALLOW_SEEDS)))
        urls[side] += 1
        seen.update((x, side) for x in t)
        facts.append((i, host, path, t))
    a, b = (1 + sum(n for (_, x), n in seen.items() if x == side) for side in (0, 1))
    seen += seeds_seen
    prior = math.log((urls[1] + 1) / (urls[0] + 1))
    odds = lambda w: math.log((seen[w, 1] + 5 * b / (a + b)) / b) - math.log((seen[w, 0] + 5 * a / (a + b)) / a)
    return {i: (host, path, prior + sum(odds(w) for w in t)) for i, host, path, t in facts}


@pytest.mark.parametrize("bound", [200_000, 0])
def test_verdicts_equal_a_plain_computation(spark, monkeypatch, bound):
    monkeypatch.setattr(urlfilter, "BROADCAST_WORDS", bound)
    words = ["river", "stone", "market", "green", "paper", "cloud", "train", "glass", "honey", "winter"]
    rng, rows = random.Random(11), []
    junky = ["%%% *** $$$ ### " * 5, "same same same same same same same same", "", None, "tiny text"]
    for i in range(160):
        name = "".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        bad = "river" in name or "stone" in name  # nothing in these names is a seed
        host = rng.choice(["www.", "M.", ""]) + (name if rng.random() < 0.9 else rng.choice(["cheappills", "freebets", "casino-win"])) + rng.choice([".net", ".info", ".Example.NET"])
        html = rng.choice(junky) if bad and rng.random() < 0.8 else "<p>" + " ".join(rng.choice(words) + str(k % 40) + " " + rng.choice(words) for k in range(30)) + "<script>cheap</script> <!-- win --> &amp;"
        rows.append((i, f"http://{host}/{rng.choice(['en', 'Greenpaper', '日本/x', '12-34'])}/{i % 50}?q#z", html))
    rows += [(160, None, "x"), (161, "nothing", "a b c d e f"), (162, "http://" + "q" * 700 + "river.net/", "a b c d e f"), (163, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("word", F.lit("clash")).repartition(3)
    got = urlfilter.judge(df, rules=(("allow", "never.such", "/"), ("block", "nor.this", "/"))).collect()
    want = _judged(rows)
    assert len(got) == len(rows)
    for r in got:
        host, path, odds = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, None) and abs(r["log_odds"] - odds) < 1e-6 and r["verdict"] == ("block" if odds > 0 else "allow")
    unseeded = [r for r in got if not any(w in r["host"] for w in ("cheap", "free", "casino"))]
    assert sum(r["verdict"] == "block" and ("river" in r["host"] or "stone" in r["host"]) for r in unseeded) > 20  # learnt from the pages alone
    assert all(r["verdict"] == "block" for r in got if "cheappills" in r["host"] or "casino" in r["host"])


# op10


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "!!" for x in w)))
        labels.append((i, int(good), 1))
    rows += [(400, None), (401, ""), (402, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    known = spark.createDataFrame([*labels, (5, None, 0), (7, 1, 0), (None, 1, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, known)
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())
    got = {r["doc_id"]: r["score"] for r in quality.score_column(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[400] == got[401]
    test = [i for i in range(400) if held[i]]
    assert np.mean([(got[i] >= 0.3) == (i % 3 > 0) for i in test]) > 0.95
    flipped = known.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, flipped) == model  # held-out labels change nothing
    assert quality.score_column(empty(spark), quality.fit(empty(spark), known)).count() == 0


def test_calibration_is_the_minimum_of_the_penalised_loss():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        y = (np.arange(3000) % 7 > 0).astype(float)
        x = np.where(y > 0, 0.05, -0.05) + 0.012 * rng.standard_normal(3000)
        x[:3] *= -1  # a few on the wrong side
        offset, slope = quality.calibrate(x, y)
        p = 1 / (1 + np.exp(-(offset + slope * x)))
        assert np.mean(p[y == 0] < 0.3) > 0.99 and np.mean(p[y == 1] >= 0.3) > 0.99
        weight = np.where(y == 1, 1500 / y.sum(), 1500 / (3000 - y.sum()))
        s = np.stack([np.ones(3000), (x - x.mean()) / x.std()], 1)
        assert np.abs(s.T @ (weight * (y - p)) - 1e-2 * np.array([offset + slope * x.mean(), slope * x.std()])).max() < 1e-3
    with pytest.raises(ValueError):
        quality.calibrate(x, y, rounds=1)
    assert all(np.isfinite(quality.calibrate(x, np.ones(3000))))


def _plain_scorer(rows, labels):
    """The score of a text after a fit on rows (doc_id, text) and labels (doc_id, quality), by plain Python."""
    import zstandard as zstd

    quality_of, text = {}, {}
    for i, y in labels:
        if i is not None and y in (0, 1) and zlib.crc32(str(i).encode()) % 5:
            quality_of[i] = max(y, quality_of.get(i, 0))
    for i, t in rows:
        if i in quality_of:
            text[i] = max((t or "").encode(), text.get(i, b""))
    order = sorted(text, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    cut = lambda raw: [raw[a : a + 512] for a in range(0, len(raw), 512)]

    def packers(ids):
        made = []
        for label in (1, 0):
            blocks = [b for i in ids if quality_of[i] == label for b in cut(text[i])]
            try:
                raw = zstd.train_dictionary(112 << 10, blocks, k=200, d=8).as_bytes()
            except zstd.ZstdError:
                raw = b"".join(blocks)[-(112 << 10) :]
            options = {"dict_data": zstd.ZstdCompressionDict(raw), "write_checksum": False} if raw else {}
            made.append(zstd.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, **options))
        return made

    def difference(raw, pair):
        good, bad = (sum(len(z.compress(b)) for b in cut(raw)) for z in pair)
        return (bad - good) / (bad + good) if raw else 0.0

    x, y = [], []
    for fold in (0, 1):
        pair = packers(order[1 - fold :: 2])
        x += [difference(text[i], pair) for i in order[fold::2]]
        y += [float(quality_of[i]) for i in order[fold::2]]
    x, y = np.array(x), np.array(y)
    w, pair, n = np.zeros(2), packers(order), len(y)
    s, weight = np.stack([np.ones(n), (x - x.mean()) / x.std()], 1), np.where(y == 1, n / 2 / y.sum(), n / 2 / (n - y.sum()))
    for _ in range(200_000):  # plain gradient descent
        w += 2 / n * (s.T @ (weight * (y - 1 / (1 + np.exp(-(s @ w))))) - 1e-2 * w)
    return lambda t: float(1 / (1 + math.exp(-(w[0] + w[1] * (difference((t or "").encode(), pair) - x.mean()) / x.std()))))


def test_quality_scores_equal_a_plain_computation(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary) + ("!" if i % 3 == 0 and rng.random() < 0.4 else "") for _ in range(rng.randint(1, 400)))) for i in range(300)] + [(300, None), (301, ""), (7, "a lesser text of id 7")]
    labels = [(i, int(i % 3 > 0)) for i in range(300)] + [(7, 0), (None, 0)]
    df, known = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int")
    got = Counter((r["doc_id"], r["text"], round(r["score"], 9)) for r in quality.score_column(df, quality.fit(df, known)).collect())
    score = _plain_scorer(rows, labels)
    want = Counter((i, t, round(score(t), 9)) for i, t in rows)
    pairs = lambda c: sorted(((i if i is not None else -1, t or "", p) for i, t, p in c.elements()))
    assert [a[:2] for a in pairs(got)] == [a[:2] for a in pairs(want)]
    assert np.allclose([a[2] for a in pairs(got)], [a[2] for a in pairs(want)], atol=1e-5)


def test_quality_edges(spark):
    rows = [(1, "good words here", "x"), (1, "good words here", "x"), (2, "bad!!!", "x"), (None, "z", "x"), (3, LONG * 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = quality.fit(df, spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int"))
    got = quality.score_column(df, model).collect()
    assert len(got) == 5 and len({r["score"] for r in got if r["doc_id"] == 1}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    none = quality.fit(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score_column(df, none).collect()} == {0.5}


def test_quality_on_a_real_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))  # 2706 good and 449 bad rows train
    model = quality.fit(docs, labels)
    held = labels.where(quality.held_out(F.col("doc_id"))).select("doc_id", "quality")
    rows = quality.score_column(docs.select("doc_id", "text").join(held, "doc_id"), model).select("quality", "score").collect()
    good, bad = (np.array([r["score"] for r in rows if r["quality"] == label]) for label in (1, 0))
    assert len({round(r["score"], 6) for r in rows}) > 500
    assert (good[:, None] > bad[None, :]).mean() > 0.95  # the area under the curve, ties against it
    assert (good >= 0.3).mean() > 0.97 and (bad < 0.3).mean() > 0.85
    assert np.mean([(r["score"] >= 0.3) == r["quality"] for r in rows]) > max(len(good), len(bad)) / len(rows)
