"""The pipeline's stages against brute force, and all llm queries against their SQL."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textkiln.llm.queries import MIX_DEFAULT, MIX_WEIGHTS, ORACLE_SQL, QUERIES, WORD_BPE
from tests.llm.test_operators import _groups, _plain_copies, _plain_scorer
from tests.test_queries import against_duckdb

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4 and corpus_pipeline.ORACLE_SQL is None
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert kept.columns == docs.columns
    whole, labels = docs.collect(), spark.read.parquet(f"{SF}/labels.parquet").collect()
    score = _plain_scorer([(r["doc_id"], r["text"]) for r in whole], [(r["doc_id"], r["quality"]) for r in labels])
    rows = [r.asDict() for r in kept.collect()]
    assert sorted(map(repr, rows)) == sorted(repr(r.asDict()) for r in whole if score(r["text"]) >= 0.3) and 0 < len(rows) < len(whole)
    kept = spark.createDataFrame([tuple(r.values()) for r in rows], docs.schema)
    unique = corpus_pipeline.ngram_jaccard_join(spark, kept, SF)
    want = {i for i, (_, c) in _groups([(r["doc_id"], r["text"]) for r in rows], 5, 80).items() if i == c}
    left = [r.asDict() for r in unique.collect()]
    assert unique.columns == docs.columns and sorted(map(repr, left)) == sorted(repr(r) for r in rows if r["doc_id"] in want)
    mixed = corpus_pipeline.mix_sources(spark, unique, SF)
    copies = _plain_copies([(r["doc_id"], r["source"], r["text"]) for r in left], MIX_WEIGHTS, MIX_DEFAULT, 17)
    found = [r.asDict() for r in mixed.collect()]
    assert mixed.columns == docs.columns and sorted(map(repr, found)) == sorted(repr(r) for r, n in zip(left, copies, strict=True) for _ in range(n))
    t, last = Tokenizer.from_file(WORD_BPE), corpus_pipeline.bpe_tokens(spark, mixed, SF).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def encoded(r):
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        return r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))

    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in last) == sorted(map(encoded, found))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    against_duckdb(spark, QUERIES[name], ORACLE_SQL[name], SF)


def test_repeated_ids_nulls_long_texts_and_clashing_columns_pass_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    long = docs.limit(1).withColumns({"doc_id": F.lit(10**9), "text": F.repeat(F.concat("text", F.lit(" ")), 40)})
    odd = docs.unionByName(docs.limit(5)).unionByName(docs.limit(1).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes})).unionByName(long)
    odd = odd.withColumns({c: F.lit(1) for c in ("score", "component_id", "n_copies", "copy_no", "rate", "ids", "node", "_tk_score")})
    sizes = [odd.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        rows = out.collect()
        assert out.columns == (docs.columns if name != corpus_pipeline.STAGES[-1][0] else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        ids = [r["doc_id"] for r in rows]
        if name == "quality classifier":
            assert all(ids.count(i) == sum(r["doc_id"] == i for r in odd.collect()) for i in set(ids))  # equal rows are judged alike
        if name == "n-gram Jaccard join":
            assert len(rows) <= sizes[-1] and set(ids) >= {i for i in ids if i is None}
        sizes.append(len(rows))
        odd = spark.createDataFrame(rows, out.schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            odd = odd.withColumn("shuffle_key", F.lit(2)).withColumn("n_tokens", F.lit(3))
    assert sizes[-1] == sizes[-2] > 0


def test_unlisted_and_null_sources_are_mixed(spark, tmp_path):
    names = ["src0", "elsewhere", None]
    rows = [(i, "some text here", "en", names[i % 3], 14) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for out in (QUERIES["op4_mixing"](spark, str(tmp_path)), corpus_pipeline.mix_sources(spark, docs, SF)):
        n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
        assert set(n) == set(names) and all(abs(c - 200) < 60 for c in n.values())  # equal weights of 1
    other = docs.where("source is null or source <> 'src0'")
    assert abs(corpus_pipeline.mix_sources(spark, other, SF).count() - 400) < 80
