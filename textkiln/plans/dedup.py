"""Duplicates, aggregates and order-dependent reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textkiln.functions import sft as P
from textkiln.functions.text import let, ngrams, words
from textkiln.operators import dedup as D
from textkiln.operators import graph, order
from textkiln.operators.storage import materialize
from textkiln.plans.base import SOURCES_SQL, query, sources, table
from textkiln.plans.base import text as T
from textkiln.plans.scalars import WS

PERMS = D.permutations(16, seed=11)
BANDS, ROWS = 4, 4
#: The full size, as in the reference: 128 permutations (the first 16 are PERMS) in 16 bands of 8, for the queries named ..._128.
PERMS_128 = D.permutations(128, seed=11)
BANDS_128, ROWS_128 = 16, 8


def _docs(spark, d):
    return table(spark, d, "documents")


def _ranked(spark, d):
    return _docs(spark, d).join(F.broadcast(sources(spark).select("source", "priority")), "source", "left").withColumn("priority", F.coalesce("priority", F.lit(0)))


@query(f"WITH {SOURCES_SQL} SELECT doc_id, source FROM documents LEFT JOIN sources USING (source) QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY coalesce(priority, 0) DESC, source, doc_id) = 1")
def exact_dedup_priority(spark, d):
    rows = _ranked(spark, d).select("doc_id", "source", "priority", F.sha2("text", 256).alias("sha"))
    return D.exact_dedup(rows, "sha", -F.col("priority"), F.col("source"), F.col("doc_id")).select("doc_id", "source")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1")
def exact_dedup_first(spark, d):
    return D.exact_dedup(_docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha")), "sha", F.col("doc_id")).select("doc_id")


@query("""WITH k AS (SELECT doc_id, lang || source AS key, n_chars % 97 AS score FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, doc_id) AS rn, score > max(score) OVER (PARTITION BY key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rep FROM k)
SELECT key, max(doc_id) FILTER (rn = 1) AS doc_id, count(*) - 1 AS dropped, count(*) FILTER (rep) AS replaced FROM r GROUP BY key""")
def best_per_key(spark, d):
    """Best of each key by score, and how often the best changed in order of arrival."""
    rows = _docs(spark, d).select("doc_id", F.concat("lang", "source").alias("key"), (F.col("n_chars") % 97).alias("score"))
    before = Window.partitionBy("key").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("rep", F.col("score") > F.max("score").over(before))
    return rows.groupBy("key").agg(F.min_by("doc_id", F.struct(-F.col("score"), F.col("doc_id"))).alias("doc_id"), (F.count("*") - 1).alias("dropped"), F.count_if("rep").alias("replaced"))


@query("SELECT DISTINCT role, md5(text) AS text_md5 FROM conversations")
def distinct_pairs(spark, d):
    return table(spark, d, "conversations").select("role", F.md5("text").alias("text_md5")).dropDuplicates(["role", "text_md5"])


_WD = f"wd AS (SELECT doc_id, {WS} AS w FROM documents)"
_SH5 = "CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END"


@query(f"WITH {_WD}, s AS (SELECT doc_id, {_SH5} AS s FROM wd) SELECT doc_id, len(s)::INTEGER AS n, md5(array_to_string(list_sort(s), '|')) AS shingles_md5 FROM s")
def word_shingles(spark, d):
    s = D.word_shingles(T())
    return _docs(spark, d).select("doc_id", F.size(s).alias("n"), F.md5(F.array_join(F.array_sort(s), "|")).alias("shingles_md5"))


@query("SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(length(t) - 4, 1) + 1), lambda i: substr(t, i, 5))))::INTEGER AS n FROM (SELECT doc_id, text AS t FROM documents)")
def char_shingles(spark, d):
    return _docs(spark, d).select("doc_id", D.count_char_shingles(T()).alias("n"))


_PERMS_SQL = "perms(k, a, b) AS (VALUES " + ", ".join(f"({i}, {a}::HUGEINT, {b}::HUGEINT)" for i, (a, b) in enumerate(PERMS)) + ")"
_SIG = f"""{_WD}, sh AS (SELECT doc_id, unnest({_SH5}) AS s FROM wd), x AS (SELECT doc_id, ('0x' || substr(md5(s), 1, 15))::HUGEINT AS x FROM sh), {_PERMS_SQL},
sig AS (SELECT doc_id, k, min(((a * x + b) % {D.P61}::HUGEINT) % 4294967296)::BIGINT AS v FROM x, perms GROUP BY doc_id, k)"""
_SLICES = f"slices AS (SELECT doc_id, k // {ROWS} AS band, string_agg(v::VARCHAR, '-' ORDER BY k) AS slice FROM sig GROUP BY doc_id, k // {ROWS})"
_EDGES = "edges AS (SELECT DISTINCT s.doc_id AS a, m.b FROM slices s JOIN (SELECT band, slice, min(doc_id) AS b FROM slices GROUP BY band, slice) m USING (band, slice) WHERE s.doc_id <> m.b)"
_COMP = "bi AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT a AS s, a AS t FROM bi UNION SELECT r.s, l.b FROM reach r JOIN bi l ON r.t = l.a), comp AS (SELECT s AS node, min(t) AS component FROM reach GROUP BY s)"


def _signatures(spark, d):
    """By hashes of shingles that every engine has, so that DuckDB can follow."""
    rows = _docs(spark, d).select("doc_id", "source", "n_chars", F.transform(D.word_shingles(T()), D.hash60).alias("x"))
    return materialize(D.signatures(rows, "x", PERMS), "signatures")


@query(f"WITH {_SIG} SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY k) AS sig FROM sig GROUP BY doc_id")
def minhash_signatures(spark, d):
    return _signatures(spark, d).select("doc_id", F.array_join("sig", ",").alias("sig"))


@query(f"WITH {_SIG}, {_SLICES}, {_EDGES} SELECT a, b FROM edges")
def lsh_band_edges(spark, d):
    return D.band_edges(_signatures(spark, d), BANDS, ROWS)


def _components(spark, d):
    sig = _signatures(spark, d)
    comp = graph.components(D.band_edges(sig, BANDS, ROWS))
    return sig.drop("sig").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


_LABELLED = f"WITH RECURSIVE {_SIG}, {_SLICES}, {_EDGES}, {_COMP}, {SOURCES_SQL}, lab AS (SELECT doc_id, d.source, n_chars, coalesce(priority, 0) AS priority, coalesce(component, doc_id) AS component FROM documents d LEFT JOIN comp ON comp.node = doc_id LEFT JOIN sources s ON s.source = d.source)"


@query(_LABELLED + " SELECT doc_id, component FROM lab")
def near_dup_components(spark, d):
    return _components(spark, d).select("doc_id", "component")


@query(_LABELLED + " SELECT doc_id, component, row_number() OVER (PARTITION BY component ORDER BY priority DESC, n_chars DESC, doc_id) = 1 AS kept FROM lab")
def near_dup_survivors(spark, d):
    labelled = _components(spark, d).join(F.broadcast(sources(spark).select("source", "priority")), "source", "left")
    return D.select_survivors(labelled, "component", F.desc(F.coalesce("priority", F.lit(0))), F.desc("n_chars"), F.col("doc_id")).select("doc_id", "component", "kept")


@query(_LABELLED + ", s AS (SELECT component, count(*) AS n FROM lab GROUP BY component) SELECT sum(n)::BIGINT AS n_in, count(*) AS kept, (sum(n) - count(*))::BIGINT AS removed, count(*) FILTER (n > 1) AS clusters, count(*) FILTER (n = 1) AS singletons FROM s")
def cluster_stats(spark, d):
    sizes = _components(spark, d).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n_in"), F.count("*").alias("kept"), (F.sum("n") - F.count("*")).alias("removed"), F.count_if(F.col("n") > 1).alias("clusters"), F.count_if(F.col("n") == 1).alias("singletons"))


@query(f"""WITH RECURSIVE {_SIG}, {_SLICES}, pairs AS (SELECT DISTINCT x.doc_id AS later, y.doc_id AS earlier FROM slices x JOIN slices y ON x.band = y.band AND x.slice = y.slice AND y.doc_id < x.doc_id),
n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents), nb AS (SELECT n.i, n.doc_id, coalesce(list(p.earlier) FILTER (p.earlier IS NOT NULL), []) AS e FROM n LEFT JOIN pairs p ON p.later = n.doc_id GROUP BY n.i, n.doc_id),
f(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT nb.i, CASE WHEN list_has_any(f.kept, nb.e) THEN f.kept ELSE list_append(f.kept, nb.doc_id) END FROM f JOIN nb ON nb.i = f.i + 1)
SELECT unnest(kept) AS doc_id FROM (SELECT kept FROM f ORDER BY i DESC LIMIT 1)""")
def greedy_near_dup(spark, d):
    """A document stays unless it shares a band with an earlier one that stays."""
    sig = _signatures(spark, d)
    return graph.first_in_buckets(sig.select(F.col("doc_id").alias("node")), D.band_members(sig, BANDS, ROWS)).select(F.col("node").alias("doc_id"))


def _signatures_128(spark, d):
    return materialize(D.signatures(_docs(spark, d).select("doc_id", "source", "n_chars", "text"), "text", PERMS_128), "signatures")


def _components_128(spark, d):
    sig = _signatures_128(spark, d)
    comp = graph.components(D.band_edges(sig, BANDS_128, ROWS_128))
    return sig.drop("sig").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


# DuckDB doesn't finish 128 permutations, so these have no SQL: tests/test_library.py holds them against brute force.


@query()
def minhash_signatures_128(spark, d):
    return _signatures_128(spark, d).select("doc_id", F.array_join("sig", ",").alias("sig"))


@query()
def lsh_band_edges_128(spark, d):
    return D.band_edges(_signatures_128(spark, d), BANDS_128, ROWS_128)


@query()
def near_dup_components_128(spark, d):
    return _components_128(spark, d).select("doc_id", "component")


@query()
def near_dup_survivors_128(spark, d):
    labelled = _components_128(spark, d).join(F.broadcast(sources(spark).select("source", "priority")), "source", "left")
    return D.select_survivors(labelled, "component", F.desc(F.coalesce("priority", F.lit(0))), F.desc("n_chars"), F.col("doc_id")).select("doc_id", "component", "kept")


@query()
def cluster_stats_128(spark, d):
    sizes = _components_128(spark, d).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n_in"), F.count("*").alias("kept"), (F.sum("n") - F.count("*")).alias("removed"), F.count_if(F.col("n") > 1).alias("clusters"), F.count_if(F.col("n") == 1).alias("singletons"))


@query()
def greedy_near_dup_128(spark, d):
    """A document stays unless it shares a band of its character 5-grams with an earlier one that stays."""
    sig = materialize(D.signatures(_docs(spark, d).select("doc_id", "text"), "text", PERMS_128, shingles="chars"), "signatures")
    return graph.first_in_buckets(sig.select(F.col("doc_id").alias("node")), D.band_members(sig, BANDS_128, ROWS_128)).select(F.col("node").alias("doc_id"))


@query("SELECT source, reason, count(*) AS n FROM (SELECT source, CASE WHEN n_chars < 300 THEN 'short' WHEN lang <> 'en' THEN 'lang:' || lang ELSE 'ok' END AS reason FROM documents) GROUP BY source, reason")
def reject_histogram(spark, d):
    reason = F.when(F.col("n_chars") < 300, "short").when(F.col("lang") != "en", F.concat(F.lit("lang:"), "lang")).otherwise("ok")
    return _docs(spark, d).groupBy("source", reason.alias("reason")).agg(F.count("*").alias("n"))


@query("""WITH u AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS uniq FROM documents)
SELECT source, count(*) AS n_read, count(*) FILTER (uniq) AS n_unique, 100.0::DOUBLE * (count(*) - count(*) FILTER (uniq)) / count(*) AS dup_pct, sum(floor(length(text) / 4.45)) FILTER (uniq)::BIGINT AS tokens FROM u GROUP BY ROLLUP (source)""")
def process_report(spark, d):
    """Counts per source with their total."""
    facts = _docs(spark, d).select("doc_id", "source", F.sha2("text", 256).alias("sha"), F.floor(F.length("text") / 4.45).alias("t"))
    first = facts.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("uniq"))
    u = facts.drop("sha").join(first, "doc_id", "left").withColumn("uniq", F.coalesce("uniq", F.lit(False)))
    return u.rollup("source").agg(F.count("*").alias("n_read"), F.count_if("uniq").alias("n_unique"), (100.0 * (F.count("*") - F.count_if("uniq")) / F.count("*")).alias("dup_pct"), F.sum(F.when(F.col("uniq"), F.col("t"))).alias("tokens"))


@query("SELECT lang, count(*) AS kept, avg(n_chars) AS mean_chars, min(n_chars) AS least, max(n_chars) AS most, (sum(n_chars) // greatest(count(*), 1))::BIGINT AS floor_mean FROM documents GROUP BY lang")
def length_stats(spark, d):
    return _docs(spark, d).groupBy("lang").agg(F.count("*").alias("kept"), F.avg("n_chars").alias("mean_chars"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.expr("sum(n_chars) div greatest(count(*), 1)").alias("floor_mean"))


@query("""WITH s AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, max(n_chars) FILTER (i = least(n - 1, floor(0.5 * n))) AS p50, max(n_chars) FILTER (i = least(n - 1, floor(0.9 * n))) AS p90, max(n_chars) FILTER (i = least(n - 1, floor(0.99 * n))) AS p99, max(n_chars) AS largest FROM s GROUP BY lang""")
def nearest_rank_percentiles(spark, d):
    """Values at position min(n - 1, floor(q n)) of the sorted lengths: counts per length, then running sums."""
    by = _docs(spark, d).groupBy("lang", "n_chars").agg(F.count("*").alias("c"))
    w = Window.partitionBy("lang")
    by = by.withColumns({"to": F.sum("c").over(w.orderBy("n_chars")), "n": F.sum("c").over(w)})
    at = lambda q: F.min(F.when(F.col("to") > F.least(F.col("n") - 1, F.floor(q * F.col("n"))), F.col("n_chars")))
    return by.groupBy("lang").agg(at(0.5).alias("p50"), at(0.9).alias("p90"), at(0.99).alias("p99"), F.max("n_chars").alias("largest"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def topk_global(spark, d):
    return _docs(spark, d).select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) <= CASE lang WHEN 'en' THEN 30 WHEN 'fr' THEN 20 ELSE 10 END")
def topk_quota(spark, d):
    quota = F.when(F.col("lang") == "en", 30).when(F.col("lang") == "fr", 20).otherwise(10)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id"))
    return _docs(spark, d).withColumn("r", rank).where(F.col("r") <= quota).select("doc_id", "lang")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3")
def first_three(spark, d):
    return _docs(spark, d).withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).where("r <= 3").select("doc_id", "source")


@query("WITH h AS (SELECT doc_id, coalesce(sum(strlen(text)) OVER (ORDER BY md5('5:' || doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) SELECT doc_id FROM h WHERE before < 200000")
def byte_budget_sample(spark, d):
    return order.budget_sample(_docs(spark, d).select("doc_id", "text"), F.octet_length("text"), 200_000, 5, "doc_id").select("doc_id")


@query("SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7)::BIGINT AS shard FROM documents")
def shard_rotation(spark, d):
    return order.rotate(_docs(spark, d).select("doc_id", "source"), "doc_id", "source", 7)


@query("""WITH RECURSIVE n AS (SELECT doc_id, strlen(text) AS s, row_number() OVER (ORDER BY doc_id) AS i FROM documents), f(i, doc_id, chunk, held) AS (SELECT 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT
 UNION ALL SELECT n.i, n.doc_id, CASE WHEN f.held >= 100000 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.held >= 100000 THEN n.s ELSE f.held + n.s END FROM f JOIN n ON n.i = f.i + 1) SELECT doc_id, chunk FROM f WHERE i > 0""")
def size_chunks(spark, d):
    return order.size_chunks(_docs(spark, d).select("doc_id", F.octet_length("text").alias("size")), "doc_id", "size", 100_000)


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY md5('9:' || doc_id)) - 1 AS p, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN p < floor(n * 0.95) THEN 'train' WHEN p < floor(n * 0.95) + floor(n * 0.025) THEN 'val' ELSE 'test' END AS split FROM n")
def position_split(spark, d):
    return order.split_by_position(_docs(spark, d).select("doc_id"), "doc_id", 9, [("train", 0.95), ("val", 0.025), ("test", 0.025)])


_TOK = f"t AS (SELECT doc_id, list_concat(list_concat([1], list_transform({WS}, lambda w: 3 + length(w))), [2]) AS k FROM documents)"


@query(f"""WITH {_TOK}, o AS (SELECT doc_id, k, coalesce(sum(len(k)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM t), c AS (SELECT b + i - 1 - 5 AS p, k[i] AS tok FROM o, unnest(range(1, len(k) + 1)) u(i)),
g AS (SELECT p // 128 AS seq, list(tok ORDER BY p) AS toks FROM c WHERE p >= 0 GROUP BY 1) SELECT seq::BIGINT AS seq, (seq * 128 + 5)::BIGINT AS start, md5(array_to_string(toks, ',')) AS tokens_md5 FROM g WHERE len(toks) = 128""")
def token_packing(spark, d):
    """Fixed-length sequences over the stream of tokens (1, word lengths + 3, 2) of all documents, from offset 5."""
    toks = F.concat(F.array(F.lit(1)), F.transform(words(T()), lambda w: F.length(w) + 3), F.array(F.lit(2)))
    packed = order.pack_sequences(_docs(spark, d).select("doc_id", toks.alias("k")), "doc_id", "k", 128, 5)
    return packed.select("seq", "start", F.md5(F.array_join("tokens", ",")).alias("tokens_md5"))


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS n FROM documents) SELECT doc_id FROM n WHERE floor(n * 0.05) >= 9 AND p >= n - floor(n * 0.05)")
def heldout_tail(spark, d):
    docs = _docs(spark, d).select("doc_id")
    n = docs.count()
    tail = int(n * 0.05)
    return order.numbered(docs, "doc_id").where(F.lit(tail >= 9) & (F.col("pos") >= n - tail)).select("doc_id")


@query(f"WITH w AS (SELECT lang, len({WS}) AS w, floor(length(text) / 4.45) AS t FROM documents) SELECT lang, sum(t)::BIGINT AS tokens, sum(w)::BIGINT AS words, sum(t)::DOUBLE / sum(w) AS per_word, sum(t) / sum(w) BETWEEN 1.3 AND 1.8 AS in_range FROM w GROUP BY lang")
def tokens_per_word(spark, d):
    by = _docs(spark, d).groupBy("lang").agg(F.sum(F.floor(F.length("text") / 4.45)).alias("tokens"), F.sum(F.size(words(T()))).alias("words"))
    return by.withColumn("per_word", F.col("tokens") / F.col("words")).withColumn("in_range", F.col("per_word").between(1.3, 1.8))


@query("""WITH s AS (SELECT count(*) AS n, count(DISTINCT text) AS u, count(*) FILTER (text = '') AS e, count(DISTINCT source) AS src FROM documents)
SELECT unnest(['has_rows', 'few_duplicates', 'no_empty', 'sources']) AS gate, unnest([n > 0, (n - u) / n <= 0.02, e = 0, src >= 10]) AS passed FROM s""")
def release_gates(spark, d):
    s = _docs(spark, d).agg(F.count("*").alias("n"), F.count_distinct("text").alias("u"), F.count_if(F.col("text") == "").alias("e"), F.count_distinct("source").alias("src"))
    gates = {"has_rows": F.col("n") > 0, "few_duplicates": (F.col("n") - F.col("u")) / F.col("n") <= 0.02, "no_empty": F.col("e") == 0, "sources": F.col("src") >= 10}
    return s.select(F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), v.alias("passed")) for k, v in gates.items()])).alias("g")).select("g.gate", "g.passed")


@query("SELECT lang, exp(least(avg(1 + (n_chars % 13) / 4.0), 20))::DOUBLE AS perplexity FROM documents GROUP BY lang")
def heldout_perplexity(spark, d):
    return _docs(spark, d).groupBy("lang").agg(F.exp(F.least(F.avg(1 + (F.col("n_chars") % 13) / 4.0), F.lit(20.0))).alias("perplexity"))


@query(f"""WITH p AS (SELECT doc_id, {WS} AS w FROM documents), g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g, len(w) AS n FROM p WHERE len(w) >= 9), c AS (SELECT doc_id, g, any_value(n) AS n, count(*) AS c FROM g GROUP BY doc_id, g),
r AS (SELECT doc_id, coalesce(sum(c) FILTER (c > 1), 0)::DOUBLE / (any_value(n) - 2) AS r FROM c GROUP BY doc_id) SELECT documents.doc_id, coalesce(r, 0.0)::DOUBLE AS repeated FROM documents LEFT JOIN r USING (doc_id)""")
def repeated_trigrams(spark, d):
    """Share of repeated trigrams: those that have an equal neighbour among the sorted ones of their document; nothing is shuffled."""
    rows = _docs(spark, d).select("doc_id", words(T()).alias("w"))
    again = let(F.sort_array(ngrams(F.col("w"), 3)), lambda s: F.size(F.filter(s, lambda g, i: (g == F.get(s, i - 1)) | (g == F.get(s, i + 1)))))
    return rows.select("doc_id", F.when(F.size("w") >= 9, again / (F.size("w") - 2)).otherwise(0.0).alias("repeated"))
