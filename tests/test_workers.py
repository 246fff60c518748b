"""Work in bounded parts, and costly columns computed once."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textkiln import plans
from textkiln.functions import normalize as N
from textkiln.functions import script as S
from textkiln.functions import tags as G
from textkiln.functions import tokens as K
from textkiln.functions.workers import PART, by_workers, cuts
from textkiln.operators import dedup as D
from textkiln.sources import readers, sinks

SF = "/root/testdata/sf0.001"
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def column(spark, texts, made):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    return [r["x"] for r in rows.select("i", made(F.col("t")).alias("x")).orderBy("i").collect()]


def test_a_part_is_bounded_and_parts_are_the_whole():
    rows = pa.array(["x" * 1000] * 5000 + [None, "y" * (2 * PART)] + ["é"] * 3).slice(7)
    found = list(cuts(rows))
    assert [a for a, _ in found] == list(np.cumsum([0] + [n for _, n in found[:-1]])) and sum(n for _, n in found) == len(rows)
    assert all(n == 1 or sum(len((v or "").encode()) for v in rows.slice(a, n).to_pylist()) <= PART for a, n in found)


def test_a_worker_never_holds_a_batch(spark):
    spark.conf.set(ROWS, "10000")
    held = by_workers(lambda: lambda rows: [sum(map(len, rows))] * len(rows), "long", pa.int64())
    assert PART // 2 < max(column(spark, ["x" * 1000] * 5000, held)) <= PART


@pytest.mark.parametrize("name", ["norm_unescape", "norm_nfc", "token_counts", "char_shingles", "ordered_documents", "merge_statuses"])
def test_texts_go_to_workers_in_small_batches(spark, name):
    spark.conf.set(ROWS, "10000")
    plans.QUERIES[name](spark, SF)
    assert spark.conf.get(ROWS) == "1024"


def test_normalization_of_odd_texts(spark):
    texts = [None, "", "plain", "é", "ﬁ&amp;&lt;", "&", "য়", "é" * 300_000]
    import html
    import unicodedata

    whole = lambda f: [None if t is None else f(t) for t in texts]
    assert column(spark, texts, N.unescape) == whole(html.unescape)
    for fn, form in ((N.nfc, "NFC"), (N.nfkc, "NFKC")):
        assert column(spark, texts, fn) == whole(lambda t, form=form: unicodedata.normalize(form, t))


def test_token_ids_of_odd_texts(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [None, "", "a b", "word " * 60_000]
    model = K.tokenizer_of(path)
    ids = [[] if t is None else list(model.encode(t)) for t in texts]
    assert column(spark, texts, lambda t: K.token_ids(t, path, 1, 2)) == [[1, *x, 2] for x in ids]
    assert column(spark, texts, lambda t: K.decoded(K.token_ids(t, path), path)) == [model.decode(x) for x in ids]


def test_character_shingles_of_odd_texts(spark):
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 6000)))
    texts = [None, "", "ab", "abcde", "abcdef" * 3, "aé😀অ" * 5, wide + wide, "word " * 40_000]
    grams = lambda t: {t[i : i + 5] for i in range(max(1, len(t) - 4))}
    assert column(spark, texts, D.count_char_shingles) == [0 if t is None else len(grams(t)) for t in texts]
    assert [set(x) for x in column(spark, texts, D.char_shingles)] == [set() if t is None else grams(t) for t in texts]


def test_trigrams_are_counted_without_a_shuffle(spark):
    assert "hashpartitioning" not in plans.QUERIES["repeated_trigrams"](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_costly_columns_are_computed_once(spark):
    counts = {"char_ratios": ("regexp_replace", 4), "profanity": ("regexp_extract_all", 3), "news_gate": ("translate(", 5), "profile_b_collect": ("translate(", 5)}
    for name, (part, n) in counts.items():
        assert plan_of(plans.QUERIES[name](spark, SF)).count(part) == n, name
    assert "&&" not in plan_of(plans.QUERIES["script_route"](spark, SF))


def test_script_counts_and_tags_of_odd_texts(spark):
    texts = [None, "", "abc ÀɎ", "অআ১ৰ", "кирил अब ا 中文 12", "।॥", "damn Damn idiots"]
    assert column(spark, texts, S.script_facts)[0]["letters"] is None
    rows = column(spark, texts, S.script_facts)[1:]
    assert [tuple(r) for r in rows] == [(0, 0, 0, 0, 0, 0), (0, 5, 0, 0, 0, 5), (2, 0, 1, 0, 0, 3), (0, 0, 0, 3, 7, 7), (0, 0, 0, 0, 0, 0), (0, 14, 0, 0, 0, 14)]
    assert [r["per_visible"] for r in column(spark, ["অ a", None], S.bengali_ratios)] == [0.5, None]
    assert [r["count"] for r in column(spark, texts, G.profanity)] == [None, 0, 0, 0, 0, 0, 2]


def test_shared_hashes_give_the_same_signatures():
    rng = random.Random(5)
    perms = D.permutations(16, 3)
    pool = [rng.getrandbits(60) for _ in range(300)]
    sets = [np.array(rng.sample(pool, rng.randint(1, 200)), np.uint64) for _ in range(60)]
    want = [[min((a * x + b) % D.P61 % (1 << 32) for x in map(int, s)) for a, b in perms] for s in sets]
    assert D.signatures_of(sets, perms).tolist() == D.signatures_of(sets, perms, most=1).tolist() == want


def test_permutation_of_the_rare_hashes():
    found = 0
    for a, b in D.permutations(200, 7):
        x = [y for r in range(3) if (y := (r - b) * pow(a, -1, D.P61) % D.P61) < 1 << 60] + [0, (1 << 60) - 1]
        found += len(x) - 2
        assert next(D.permuted(np.array(x, np.uint64), [(a, b)])).tolist() == [(a * y + b) % D.P61 % (1 << 32) for y in x]
    assert found > 100


def test_shards_are_whole_over_batches(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("id"), F.concat(F.lit("লেখা "), F.repeat(F.lit("x"), 900)).alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("web").alias("track"))
    made = sorted(tuple(r) for r in sinks.write_named_shards(rows, str(tmp_path / "named"), "doc_id", 1500).collect())
    assert made == [("a", "web", 0, "a-web-00000.jsonl.gz", 1000), ("b", "web", 0, "b-web-00000.jsonl.gz", 1500), ("b", "web", 1, "b-web-00001.jsonl.gz", 500)]
    back = readers.read_jsonl(spark, str(tmp_path / "named"))
    assert sorted(int(r["id"]) for r in back.where("length(text) = 905").select("id", "_corrupt").collect()) == list(range(3000))
