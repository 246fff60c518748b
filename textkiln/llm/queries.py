"""Queries op1 to op10 over the documents, embeddings and pages tables, with DuckDB SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm import bpe, jaccard, lattice, mih, mixing, quality, sharding, tokenbin, urlfilter, warc
from textkiln.operators.storage import fresh_path

#: Target weights of the sources: five tiers.
MIX_WEIGHTS = {f"src{i}": float(i % 5 + 1) for i in range(20)}
#: The weight of every other source, the null source included.
MIX_DEFAULT = 1.0

#: Files of the public tokenizers that the queries use; the operators take any path.
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 16)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), mih.sign_code(F.col("embedding")).alias("code"))
    return mih.top_k(rows, rows.where("id % 20 = 0"), 10)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.replicate(docs, MIX_WEIGHTS, default=MIX_DEFAULT, seed=17)
    return out.select("doc_id", "source", "n_copies", "copy_no", "shuffle_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return warc.captures(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), WORD_BPE)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenbin.write_token_files(_table(spark, sf_dir, "documents"), BYTE_BPE, fresh_path(spark, "ids"))
    return tokenbin.read_token_files(files, with_ids=False)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score_column(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_exact_topk, op3_embedding_near_dedup, op4_mixing, op5_warc, op6_bpe, op7_ngram_jaccard_join, op8_url_filter, op9_token_files, op10_quality_classifier)}

_CODES = """codes AS (SELECT vec_id AS id, list_sum(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << i ELSE 0::HUGEINT END))::UBIGINT AS code
  FROM embeddings WHERE len(embedding) = 64)"""

_MIX = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS.items()) + " ELSE 0 END"

ORACLE_SQL = {
    "op2_exact_topk": f"""WITH {_CODES}, d AS (
  SELECT q.id AS query_id, x.id AS neighbor_id, bit_count(xor(q.code, x.code))::INTEGER AS distance FROM codes q JOIN codes x ON q.id <> x.id WHERE q.id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INTEGER AS rank, neighbor_id, distance FROM d
QUALIFY rank <= 10""",
    "op3_embedding_near_dedup": """WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT DISTINCT a AS s, a AS t FROM links UNION SELECT r.s, l.b FROM reach r JOIN links l ON r.t = l.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a), c AS (SELECT s, min(t) AS component_id FROM reach GROUP BY s)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.s = vec_id""",
    "op4_mixing": f"""WITH RECURSIVE sized AS (SELECT source, sum(strlen(coalesce(text, '')))::DOUBLE AS size, ({_MIX})::DOUBLE AS w0 FROM documents GROUP BY source),
s AS (SELECT *, CASE WHEN size > 0 THEN w0 ELSE 0 END AS w FROM sized),
rate AS (SELECT source, CASE WHEN w > 0 AND size > 0 THEN w * (SELECT sum(size) FROM s) / (SELECT sum(w) FROM s) / size ELSE 0 END AS r FROM s),
drawn AS (SELECT source, r, greatest(1, ceil(r / 16.0))::INTEGER AS draws FROM rate),
cdf AS (SELECT source, draws, r / draws AS m, 0 AS j, exp(-(r / draws)) AS p, exp(-(r / draws)) AS c FROM drawn
  UNION ALL SELECT source, draws, m, j + 1, p * m / (j + 1), c + p * m / (j + 1) FROM cdf WHERE j < 84),
u AS (SELECT doc_id, source, text, i, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || i), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents JOIN drawn USING (source), range(draws) t(i)),
cnt AS (SELECT u.doc_id, u.source, any_value(u.text) AS text, count(c.j)::INTEGER AS n FROM u LEFT JOIN cdf c ON c.source = u.source AND c.c <= u.u GROUP BY u.doc_id, u.source)
SELECT doc_id, source, n AS n_copies, k::INTEGER AS copy_no, substr(md5('order17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || k), 1, 16) AS shuffle_key, md5(coalesce(text, '')) AS text_md5
FROM cnt, range(n) t(k)""",
    "op7_ngram_jaccard_join": """WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS gram FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (SELECT DISTINCT a AS s, a AS t FROM links UNION SELECT r.s, l.b FROM reach r JOIN links l ON r.t = l.a),
c AS (SELECT s, min(t) AS component_id FROM reach GROUP BY s)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.s = d.doc_id""",
}
