"""Filters, joins, profiles and release policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.functions import normalize as N
from textkiln.functions import ranges as R
from textkiln.functions import script as S
from textkiln.functions import tags as G
from textkiln.functions.text import only
from textkiln.operators.order import seeded
from textkiln.operators.storage import materialize
from textkiln.plans.base import BN, SOURCES_SQL, bn, md5, n_of, query, sources, table
from textkiln.plans.base import text as T
from textkiln.plans.scalars import _B, _RATIO, COUNTS, LINES, ROUTE, STRIP, SUB

_PER_LETTER = _RATIO(_B, n_of("\\p{L}"))
_PER_VISIBLE = _RATIO(_B, n_of("\\S"))
_REP = f"CASE WHEN len({LINES}) < 2 THEN 0.0::DOUBLE ELSE 1 - len(list_distinct({LINES})) / len({LINES}) END"


def quality_reason(text: Column, banglish: Column, shortest: int = 100, least: float = 0.5, most: float = 0.3) -> Column:
    """First failing check of profile A, null if none."""
    return F.when(F.length(text) < shortest, "too_short").when(~banglish & (S.bengali_per_letter(text) < least), "low_bengali_ratio").when(G.repetition(text) > most, "high_repeat_ratio")


def language_reason(lang: Column, text: Column, banglish: Column) -> Column:
    """not_bengali, or the kinds of contamination found; null for kept and for Banglish."""
    c = S.contamination(text)
    found = F.concat_ws(", ", *[F.when(c[k] > 0, F.lit(name)) for k, name in (("devanagari_chars", "devanagari"), ("assamese_chars", "assamese_chars"), ("other_script_chars", "other_scripts"))])
    return F.when(banglish, None).when(~lang.isin("bn"), "not_bengali").when(found != "", F.concat(F.lit("contamination: "), found))


_REASON = f"CASE WHEN length(text) < 100 THEN 'too_short' WHEN NOT (source = 'src3') AND {_PER_LETTER} < 0.5 THEN 'low_bengali_ratio' WHEN {_REP} > 0.3 THEN 'high_repeat_ratio' END"


_JUNK = "concat(text, chr(10), 'আরও পড়ুন: ', source, chr(10), 'সাবস্ক্রাইব করুন')"


@query(f"""WITH {BN.replace('bn AS', 'raw AS')}, bn AS (SELECT doc_id, source, {STRIP(SUB(f"array_to_string(list_filter(string_split({_JUNK}, chr(10)), lambda l: NOT regexp_matches(l, '{'|'.join(N.BOILERPLATE)}')), chr(10))", "\\n{3,}", "\n\n"))} AS text FROM raw)
SELECT doc_id, {_REASON} AS reason FROM bn""")
def quality_reasons(spark, d):
    """The first failing check after boilerplate lines, put in here, are gone."""
    rows = bn(spark, d).withColumn("text", N.clean_boilerplate(F.concat("text", F.lit("\nআরও পড়ুন: "), "source", F.lit("\nসাবস্ক্রাইব করুন"))))
    return rows.select("doc_id", quality_reason(T(), F.col("source") == "src3").alias("reason"))


@query(f"""WITH {BN}, c AS (SELECT doc_id, source, lang, {n_of(R.one_of(R.DEVANAGARI))} > 0 AS dv, {n_of(R.one_of(R.ASSAMESE))} > 0 AS asm, {n_of(R.one_of(R.BLOCKED[2:]))} > 0 AS oth FROM bn)
SELECT doc_id, CASE WHEN source = 'src3' THEN NULL WHEN lang NOT IN ('fr', 'es') THEN 'not_bengali' WHEN dv OR asm OR oth THEN 'contamination: ' || concat_ws(', ', CASE WHEN dv THEN 'devanagari' END, CASE WHEN asm THEN 'assamese_chars' END, CASE WHEN oth THEN 'other_scripts' END) END AS reason FROM c""")
def language_filter(spark, d):
    rows = bn(spark, d).withColumn("lid", F.when(F.col("lang").isin("fr", "es"), "bn").otherwise(F.col("lang")))
    return rows.select("doc_id", language_reason(F.col("lid"), T(), F.col("source") == "src3").alias("reason"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 50 AND trim(text) <> ''")
def fast_drop(spark, d):
    return table(spark, d, "documents").where((F.length("text") >= 50) & (F.trim("text") != "")).select("doc_id")


_MERGE = f"""WITH {BN}, s AS (SELECT *, CASE WHEN length(text) < 100 THEN 'short' WHEN {_PER_VISIBLE} < 0.3 THEN 'ratio' ELSE 'ok' END AS st FROM bn), r AS (SELECT *, row_number() OVER (PARTITION BY sha256({STRIP('text')}) ORDER BY doc_id) AS rn FROM s WHERE st = 'ok'),
m AS (SELECT source, doc_id, text, CASE WHEN st <> 'ok' THEN st ELSE 'ok' END AS status FROM s WHERE st <> 'ok' UNION ALL SELECT source, doc_id, text, CASE WHEN rn = 1 THEN 'kept' ELSE 'dedup' END FROM r)"""


def merge_status(docs: DataFrame) -> DataFrame:
    """docs, with bytes for their texts, and status: short, ratio, dedup or kept. Texts are compared in NFKC, stripped; only hashes are shuffled."""
    staged = docs.withColumn("st", F.when(F.length("text") < 100, "short").when(S.bengali_per_visible(T()) < 0.3, "ratio").otherwise("ok"))
    staged = staged.withColumns({"sha": F.sha2(N.merge_key(T()), 256), "bytes": F.octet_length("text")}).drop("text")
    rank = F.row_number().over(Window.partitionBy("st", "sha").orderBy("doc_id"))
    status = F.when(F.col("st") != "ok", F.col("st")).when(rank == 1, "kept").otherwise("dedup")
    return staged.withColumn("status", status).drop("st", "sha")


@query(_MERGE + " SELECT doc_id, status FROM m")
def merge_statuses(spark, d):
    return merge_status(bn(spark, d)).select("doc_id", "status")


@query(_MERGE + " SELECT source, count(*) AS n_read, count(*) FILTER (status = 'kept') AS kept, count(*) FILTER (status = 'short') AS short, count(*) FILTER (status = 'ratio') AS ratio, count(*) FILTER (status = 'dedup') AS dedup, coalesce(sum(strlen(text)) FILTER (status = 'kept'), 0)::BIGINT AS bytes FROM m GROUP BY source")
def merge_stats(spark, d):
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("kept", "short", "ratio", "dedup")]
    return merge_status(bn(spark, d)).groupBy("source").agg(F.count("*").alias("n_read"), *counts, F.coalesce(F.sum(F.when(F.col("status") == "kept", F.col("bytes"))), F.lit(0)).alias("bytes"))


@query(f"""WITH {BN}, {COUNTS}, {ROUTE} SELECT r.doc_id, CASE WHEN bn.source = 'src5' THEN CASE WHEN length({STRIP('bn.text')}) >= 20 THEN 'banglish' ELSE 'reject' END ELSE split_part(v, ':', 1) END AS track FROM routed r JOIN bn USING (doc_id)""")
def track_routing(spark, d):
    forced = F.when(F.col("source") == "src5", F.when(F.length(F.regexp_replace("text", r"^\s+|\s+$", "")) >= 20, "banglish").otherwise("reject"))
    return bn(spark, d).select("doc_id", F.coalesce(forced, S.route(T())["track"]).alias("track"))


@query(f"""WITH {BN}, {COUNTS}, {ROUTE} SELECT r.doc_id, v AS verdict, md5(left(c.text, 4000)) AS head_md5 FROM routed r JOIN counts c USING (doc_id)
JOIN documents d ON d.doc_id = r.doc_id WHERE d.source <> 'src5' AND (assamese >= 3 OR v LIKE 'reject:blocked%' OR v LIKE 'reject:foreign%' OR (v LIKE 'reject:%' AND ('0x' || substr(md5('audit:' || r.doc_id), 1, 8))::BIGINT < 0.02 * 4294967296))""")
def audit_stream(spark, d):
    """Rejects worth a look: Assamese letters, other scripts, and two of a hundred others; sources of a forced track are no rejects."""
    rows = bn(spark, d).where("source <> 'src5'").select("doc_id", "text", S.script_counts(T())["assamese"].alias("a"), S.route(T()).alias("v"))
    draw = F.conv(F.substring(seeded("audit", F.col("doc_id")), 1, 8), 16, 10).cast("bigint") < 0.02 * (1 << 32)
    hit = (F.col("a") >= 3) | F.col("v.reason").isin("blocked_script", "foreign_script") | ((F.col("v.track") == "reject") & draw)
    return rows.where(hit).select("doc_id", F.concat_ws(":", "v.track", "v.reason").alias("verdict"), md5(F.left("text", F.lit(4000))).alias("head_md5"))


@query("SELECT event_id FROM events WHERE event_id % 7 = 0 OR ts::DATE >= DATE '2024-01-20'")
def date_filter_keep_null(spark, d):
    dated = table(spark, d, "events").withColumn("date", F.when(F.col("event_id") % 7 != 0, F.to_date("ts")))
    return dated.where("date is null or date >= date'2024-01-20'").select("event_id")


_FUNNEL = f"""WITH {BN}, n AS (SELECT doc_id, source, {STRIP(SUB("regexp_replace(text, '[।!?.]{2,}([।!?.])', '\\1', 'g')", " {2,}", " "))} AS text FROM bn), r AS (SELECT *, {_REASON} AS q FROM n),
x AS (SELECT *, CASE WHEN q IS NULL AND row_number() OVER (PARTITION BY q IS NULL, sha256(text) ORDER BY doc_id) > 1 THEN 'exact_duplicate' ELSE q END AS reason FROM r)
SELECT source, count(*) AS n_in, count(*) FILTER (reason IS NULL) AS kept, sum(length(text))::BIGINT AS chars_in, coalesce(sum(length(text)) FILTER (reason IS NULL), 0)::BIGINT AS chars_kept,
 count(*) FILTER (reason = 'too_short') AS too_short, count(*) FILTER (reason = 'low_bengali_ratio') AS low_ratio, count(*) FILTER (reason = 'high_repeat_ratio') AS repeated, count(*) FILTER (reason = 'exact_duplicate') AS duplicates,
 (count(*) FILTER (reason IS NULL))::DOUBLE / count(*) AS retention FROM x GROUP BY source"""


@query(_FUNNEL)
def profile_a_funnel(spark, d):
    """Profile A from text to the report per source: squeeze, quality reason, exact duplicates, counts."""
    rows = bn(spark, d).withColumn("text", F.regexp_replace(F.regexp_replace(N.squeeze_punctuation(T()), " {2,}", " "), r"^\s+|\s+$", ""))
    facts = rows.select("doc_id", "source", F.length("text").alias("n"), F.sha2("text", 256).alias("sha"), quality_reason(T(), F.col("source") == "src3").alias("q"))
    facts = materialize(facts, "facts")  # thin, and read twice
    first = facts.where("q is null").groupBy("sha").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("first"))
    judged = facts.drop("sha").join(first, "doc_id", "left").withColumn("reason", F.when(F.col("q").isNull() & F.col("first").isNull(), "exact_duplicate").otherwise(F.col("q")))
    kept, n = F.col("reason").isNull(), F.col("n")
    why = lambda name: F.count_if(F.col("reason") == name)
    return judged.groupBy("source").agg(
        F.count("*").alias("n_in"), F.count_if(kept).alias("kept"), F.sum(n).alias("chars_in"), F.coalesce(F.sum(F.when(kept, n)), F.lit(0)).alias("chars_kept"), why("too_short").alias("too_short"),
        why("low_bengali_ratio").alias("low_ratio"), why("high_repeat_ratio").alias("repeated"), why("exact_duplicate").alias("duplicates"), (F.count_if(kept) / F.count("*")).alias("retention"),
    )


@query(f"""WITH {BN}, {COUNTS}, {ROUTE} SELECT c.doc_id, bn.source, split_part(v, ':', 1) AS track, CASE WHEN bengali / greatest(1, letters) >= 0.9 THEN 'bengali' WHEN latin / greatest(1, letters) >= 0.9 THEN 'latin' ELSE 'mixed' END AS script,
 bengali / greatest(1, letters)::DOUBLE AS bengali_ratio, latin / greatest(1, letters)::DOUBLE AS latin_ratio, assamese AS assamese_chars FROM counts c JOIN routed USING (doc_id) JOIN bn USING (doc_id) WHERE v NOT LIKE 'reject:%'""")
def profile_b_collect(spark, d):
    """Profile B: route every document and tag what isn't rejected."""
    c = F.col("r.counts")
    whole = F.greatest(F.lit(1), c["letters"])
    rows = bn(spark, d).select("doc_id", "source", F.explode(only(S.routed(T()), lambda r: r["verdict"]["track"] != "reject")).alias("r"))
    rows = rows.select("doc_id", "source", "r.verdict.track", (c["bengali"] / whole).alias("bengali_ratio"), (c["latin"] / whole).alias("latin_ratio"), c["assamese"].alias("assamese_chars"))
    return rows.select("doc_id", "source", "track", S.script_label(F.col("bengali_ratio"), F.col("latin_ratio")).alias("script"), "bengali_ratio", "latin_ratio", "assamese_chars")


_BUCKET = """CASE WHEN regexp_matches(lower(license), 'train-only|tou|see-card') THEN 'train_only' WHEN regexp_matches(lower(license), 'verify per-item|pd-subset|cc-by-nc') THEN 'conditional'
 WHEN lower(license) LIKE 'pd%' OR regexp_matches(lower(license), 'public domain|cc0|cc-by-sa|cc-by-4|cc-by |odc-by') OR lower(license) IN ('cc-by', 'mit') THEN 'releasable' ELSE 'train_only' END"""


def policy(spark) -> DataFrame:
    """source, bucket; two sources override the rules of their licence."""
    by_rule = sources(spark).select("source", G.license_bucket(F.col("license")).alias("bucket"))
    return by_rule.withColumn("bucket", F.when(F.col("source") == "src3", "conditional").when(F.col("source") == "src6", "train_only").otherwise(F.col("bucket")))


_POLICY = f"{SOURCES_SQL}, policy AS (SELECT source, CASE source WHEN 'src3' THEN 'conditional' WHEN 'src6' THEN 'train_only' ELSE {_BUCKET} END AS bucket FROM sources)"


@query(f"WITH {_POLICY} SELECT doc_id, coalesce(bucket, 'train_only') AS bucket FROM documents LEFT JOIN policy USING (source)")
def release_policy(spark, d):
    return table(spark, d, "documents").join(F.broadcast(policy(spark)), "source", "left").select("doc_id", F.coalesce("bucket", F.lit("train_only")).alias("bucket"))


@query(f"WITH {SOURCES_SQL} SELECT doc_id, coalesce(priority, 0)::INTEGER AS priority, coalesce(provenance, 'unknown') AS provenance FROM documents LEFT JOIN sources USING (source)")
def priority_provenance(spark, d):
    joined = table(spark, d, "documents").join(F.broadcast(sources(spark)), "source", "left")
    return joined.select("doc_id", F.coalesce("priority", F.lit(0)).alias("priority"), F.coalesce("provenance", F.lit("unknown")).alias("provenance"))


_MANIFEST = f"WITH {_POLICY}, p AS (SELECT coalesce(bucket, 'train_only') AS bucket, count(*) AS docs, sum(floor(length(text) / 4.45))::BIGINT AS tokens FROM documents LEFT JOIN policy USING (source) GROUP BY 1)"


@query(_MANIFEST + " SELECT bucket, docs, tokens, docs::DOUBLE / sum(docs) OVER () AS docs_share, tokens::DOUBLE / sum(tokens) OVER () AS tokens_share FROM p")
def release_manifest(spark, d):
    joined = table(spark, d, "documents").join(F.broadcast(policy(spark)), "source", "left")
    by = joined.groupBy(F.coalesce("bucket", F.lit("train_only")).alias("bucket")).agg(F.count("*").alias("docs"), F.sum(F.floor(F.length("text") / 4.45)).alias("tokens"))
    whole = Window.partitionBy()
    return by.withColumns({"docs_share": F.col("docs") / F.sum("docs").over(whole), "tokens_share": F.col("tokens") / F.sum("tokens").over(whole)})


@query(f"WITH {SOURCES_SQL} SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM sources)")
def unknown_sources(spark, d):
    return table(spark, d, "documents").select("source").distinct().join(F.broadcast(sources(spark)), "source", "left_anti")


@query("WITH n AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id FROM n WHERE rn = 1 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))")
def anti_seen_hash(spark, d):
    """Unlabelled documents, the first of each text, whose hash no labelled one has."""
    docs, labels = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha")), table(spark, d, "labels")
    fresh = docs.join(labels, "doc_id", "left_anti").groupBy("sha").agg(F.min("doc_id").alias("doc_id"))
    return fresh.join(docs.join(labels, "doc_id", "left_semi"), "sha", "left_anti").select("doc_id")


@query("SELECT page_id FROM pages WHERE split_part(url, '?', 1) NOT IN (SELECT split_part(url, '?', 1) FROM pages WHERE url LIKE '%/fr/%') AND url NOT LIKE '%/fr/%'")
def anti_seen_url(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url", F.split_part("url", F.lit("?"), F.lit(1)).alias("u"))
    french = F.col("url").contains("/fr/")
    return pages.where(~french).join(pages.where(french).select("u"), "u", "left_anti").select("page_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_keep(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi").select("doc_id", "source")


_RANGES = (("bengali", 0x0980, 0x09FF), ("devanagari", 0x0900, 0x097F), ("latin-ext", 0xC0, 0x24F), ("ascii", 0x20, 0x7E))


@query(f"""WITH {BN}, r(script, lo, hi) AS (VALUES {', '.join(f"('{n}', {a}, {b})" for n, a, b in _RANGES)}), c AS (SELECT DISTINCT ch FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM bn))
SELECT ch, ascii(ch)::INTEGER AS codepoint, script FROM c JOIN r ON ascii(ch) BETWEEN lo AND hi""")
def vocabulary_audit(spark, d):
    """Every character of the corpus with the script range that holds it: the table of ranges has four rows."""
    chars = bn(spark, d).select(F.explode(F.array_distinct(F.split("text", ""))).alias("ch")).distinct().where("ch <> ''").withColumn("codepoint", F.ascii("ch"))
    ranges = spark.createDataFrame([(n, a, b) for n, a, b in _RANGES], "script string, lo int, hi int")
    return chars.join(F.broadcast(ranges), F.col("codepoint").between(F.col("lo"), F.col("hi"))).select("ch", "codepoint", "script")


@query("""WITH a AS (SELECT count(*) AS read, count(DISTINCT text) AS uniq FROM documents), b AS (SELECT count(DISTINCT md5(lower(text))) AS kept FROM documents)
SELECT read, uniq, kept, kept <= uniq AS consistent FROM a, b""")
def report_crosscheck(spark, d):
    """Two one-row reports side by side."""
    docs = table(spark, d, "documents")
    a = docs.agg(F.count("*").alias("read"), F.count_distinct("text").alias("uniq"))
    b = docs.agg(F.count_distinct(F.md5(F.lower("text"))).alias("kept"))
    return a.crossJoin(F.broadcast(b)).withColumn("consistent", F.col("kept") <= F.col("uniq"))


@query("""WITH RECURSIVE links AS (SELECT DISTINCT page_id AS a, (page_id * 7 + k) % (SELECT count(*) FROM pages) AS b FROM pages, range(3) t(k)), f(page_id, depth) AS (SELECT page_id, 0 FROM pages WHERE page_id < 2 UNION SELECT l.b, depth + 1 FROM f JOIN links l ON l.a = f.page_id WHERE depth < 3)
SELECT page_id, min(depth)::INTEGER AS depth FROM f GROUP BY page_id""")
def crawl_frontier(spark, d):
    """Breadth-first frontier to depth 3: each round joins the frontier to the links and drops visited pages."""
    pages = table(spark, d, "pages").select("page_id")
    n = pages.count()
    links = pages.select(F.col("page_id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).select("a", ((F.col("a") * 7 + F.col("k")) % n).alias("b")).distinct()
    seen = frontier = pages.where("page_id < 2").withColumn("depth", F.lit(0))
    for depth in (1, 2, 3):
        step = frontier.join(links, F.col("page_id") == F.col("a")).select(F.col("b").alias("page_id")).distinct()
        frontier = step.join(seen, "page_id", "left_anti").withColumn("depth", F.lit(depth))
        seen = seen.unionByName(frontier)
    return seen
