"""Collectors, gates, named shards, tokenizers, reports over shards, and streams with state."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions import language as L
from textkiln.functions import normalize as N
from textkiln.functions import ranges as R
from textkiln.functions import script as S
from textkiln.functions import tags as G
from textkiln.functions import tokens as K
from textkiln.functions.text import let
from textkiln.operators import bloom, order
from textkiln.operators import dedup as D
from textkiln.operators.storage import fresh_path
from textkiln.plans.base import BN, SOURCES_SQL, SQL, bn, md5, n_of, query, sources, table
from textkiln.plans.base import text as T
from textkiln.plans.dedup import _LABELLED, BANDS, ROWS, _components
from textkiln.plans.pipelines import _POLICY, policy
from textkiln.plans.scalars import STRIP, WORDS, WS, _in
from textkiln.sources import collect, readers, sinks
from textkiln.streaming import streams


def _docs(spark, d):
    return table(spark, d, "documents")


# shards


def _sharded(spark, d, rows=37):
    folder = fresh_path(spark, "named")
    docs = _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("id"), "text", "source", F.lit("web").alias("track"))
    return folder, sinks.write_named_shards(docs, folder, "doc_id", rows)


_SHARDED = "sh AS (SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 37)::BIGINT AS shard FROM documents)"


@query(f"WITH {_SHARDED} SELECT source, 'web' AS track, shard, printf('%s-web-%05d.jsonl.gz', source, shard) AS name, count(*) AS docs FROM sh GROUP BY source, shard")
def named_shards(spark, d):
    """Documents as gzip shards named by source, track and index."""
    return _sharded(spark, d)[1]


@query(f"WITH {_SHARDED}, {SOURCES_SQL} SELECT doc_id::VARCHAR AS id, shard.source AS shard_source, coalesce(priority, 0)::INTEGER AS priority, row_number() OVER (ORDER BY -coalesce(priority, 0), shard.source, shard, doc_id) - 1 AS doc_index FROM sh AS shard LEFT JOIN sources ON sources.source = shard.source")
def ordered_documents(spark, d):
    """Shards read back in order of priority, source, shard and line, with the global index."""
    folder, made = _sharded(spark, d)
    made.count()
    return collect.ordered_shards(spark, folder, sources(spark)).select("id", "shard_source", "priority", "doc_index")


@query("SELECT source, count(*) AS n FROM documents WHERE source IN ('src1', 'src2', 'src3') AND source <> 'src2' GROUP BY source")
def discovered_sources(spark, d):
    """Only the files of some sources are read."""
    folder, made = _sharded(spark, d)
    made.count()
    found = collect.discover_files(spark, folder, include=("src1", "src2", "src3"), exclude=("src2",))
    return found.join(made.select("name", "docs"), "name").groupBy("source").agg(F.sum("docs").alias("n"))


@query("SELECT count(*) FILTER (doc_id % 2 = 0) AS docs, count(DISTINCT source) AS shards FROM documents")
def rewritten_shards(spark, d):
    """Shards rewritten one by one, half of the records dropped; a second run finds nothing to do."""
    folder, target = fresh_path(spark, "raw"), fresh_path(spark, "rewritten")
    sinks.write_named_shards(_docs(spark, d).select("doc_id", "source", F.lit("web").alias("track")), folder, "doc_id", 10**9)
    files = collect.discover_files(spark, folder)
    first = sinks.rewrite_shards(files, target, lambda r: r if r["doc_id"] % 2 == 0 else None)
    again = sinks.rewrite_shards(files, target, lambda r: None)
    return first.unionByName(again).agg(F.sum("n_out").alias("docs"), F.count("*").alias("shards"))


@query("SELECT source, count(*) AS n_in, count(*) AS kept, sum(length(text))::BIGINT AS chars_in, sum(length(text))::DOUBLE / count(*) AS mean_chars, 1.0::DOUBLE AS retention FROM documents GROUP BY source")
def existing_report(spark, d):
    """The report of profile A over documents that are already processed: all of them kept."""
    folder, made = _sharded(spark, d)
    made.count()
    back = readers.with_shard(readers.read_jsonl(spark, folder)).where("_corrupt is null")
    return back.groupBy("source").agg(F.count("*").alias("n_in"), F.count("*").alias("kept"), F.sum(F.length("text")).alias("chars_in"), (F.sum(F.length("text")) / F.count("*")).alias("mean_chars"), F.lit(1.0).alias("retention"))


@query("SELECT reason, n, row_number() OVER (ORDER BY n DESC, reason)::INTEGER AS place FROM (SELECT CASE WHEN n_chars < 300 THEN 'short' WHEN lang <> 'en' THEN 'lang:' || lang ELSE 'ok' END AS reason, count(*) AS n FROM documents GROUP BY 1)")
def ordered_reasons(spark, d):
    """Reasons from the most frequent one down."""
    reason = F.when(F.col("n_chars") < 300, "short").when(F.col("lang") != "en", F.concat(F.lit("lang:"), "lang")).otherwise("ok")
    by = _docs(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).withColumn("down", -F.col("n"))
    return order.numbered(by, "down", "reason").select("reason", "n", (F.col("pos") + 1).cast("int").alias("place"))


@query("SELECT source, so_far, so_far::DOUBLE / (SELECT sum(n_chars) FROM documents) AS share FROM (SELECT source, sum(sum(n_chars)) OVER (ORDER BY source)::BIGINT AS so_far FROM documents GROUP BY source)")
def running_totals(spark, d):
    """Progress over the sources: characters so far and their share."""
    by = _docs(spark, d).groupBy("source").agg(F.sum("n_chars").alias("c"))
    return order.running_share(by, "source", value=F.col("c")).select("source", "so_far", "share")


@query("SELECT doc_id FROM documents ORDER BY md5('13:' || doc_id), doc_id LIMIT 40")
def sample_n(spark, d):
    return order.sample_rows(_docs(spark, d).select("doc_id"), 40, "doc_id", 13)


@query("SELECT 3 * 25 AS n, (SELECT sum(length(source)) FROM (SELECT source FROM documents ORDER BY md5('4:' || doc_id), doc_id LIMIT 25))::BIGINT AS chars")
def review_sample(spark, d):
    """A review file of 25 drawn rows, three lines each."""
    path = fresh_path(spark, "review")
    rows = _docs(spark, d).select("doc_id", F.lit("factual").alias("task"), F.lit(1.5).alias("score"), "source", F.lit("q").alias("user"), F.lit("a").alias("assistant"))
    sinks.write_review(rows, path, 25, "doc_id", 4)
    back = spark.read.text(path).where("trim(value) <> ''")
    return back.agg(F.count("*").alias("n"), F.sum(F.length(F.regexp_extract("value", r"source=(\S+)", 1))).alias("chars"))


# keys and strategies


@query(f"WITH k AS (SELECT doc_id, {STRIP('text')} AS k FROM documents) SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS first_id FROM k")
def merge_nfkc(spark, d):
    """The merge's key: copies that differ in compatibility forms and white space at the ends are one text."""
    odd = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("  "), F.replace(T(), F.lit("fi"), F.lit("ﬁ")), F.lit("\n"))).otherwise(T())
    keyed = _docs(spark, d).select("doc_id", F.sha2(N.merge_key(odd), 256).alias("k"))
    return keyed.join(keyed.groupBy("k").agg(F.min("doc_id").alias("first_id")), "k").select("doc_id", "first_id")


@query("WITH k AS (SELECT doc_id, nfc_normalize(text) AS k FROM documents) SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS first_id FROM k")
def nfc_hash_key(spark, d):
    """64-bit hashes of composed texts: half of the documents come with decomposed letters."""
    apart = T()
    for a, b in (("é", "é"), ("ü", "ü"), ("ñ", "ñ")):
        apart = F.replace(apart, F.lit(a), F.lit(b))
    keyed = _docs(spark, d).select("doc_id", F.xxhash64(N.nfc(F.when(F.col("doc_id") % 2 == 0, apart).otherwise(T()))).alias("k"))
    return keyed.join(keyed.groupBy("k").agg(F.min("doc_id").alias("first_id")), "k").select("doc_id", "first_id")


@query("SELECT strategy, n FROM (SELECT 'none' AS strategy, count(*) AS n FROM documents UNION ALL SELECT 'exact', count(DISTINCT text) FROM documents UNION ALL SELECT 'bloom', count(DISTINCT text) FROM documents)")
def dedup_strategies(spark, d):
    """Rows kept by each strategy; at this size the filter has no false positive."""
    docs = _docs(spark, d).select("doc_id", "text")
    kept = [bloom.dedup(docs, "text", "doc_id", strategy=s).select(F.lit(s).alias("strategy")) for s in ("none", "exact", "bloom")]
    return D.union_all(kept).groupBy("strategy").agg(F.count("*").alias("n"))


# language


_LANG = f"""cnt AS (SELECT doc_id, text, {n_of(R.one_of(R.BENGALI))} AS b, {n_of(R.one_of(R.ASSAMESE))} AS a, {n_of(R.one_of(R.DEVANAGARI))} AS h, {n_of('[A-Za-z\\x{C0}-\\x{24F}]')} AS l, {WORDS} AS w FROM bn),
shares AS (SELECT doc_id, text, greatest(1, b + h + l) AS n, least(1.0::DOUBLE, 10.0::DOUBLE * a / greatest(1, b)) AS lean, b, h, l, CASE WHEN len(w) = 0 THEN 0.0::DOUBLE ELSE len(list_filter(w, lambda x: x IN ({_in(S.ENGLISH_MARKERS)})))::DOUBLE / len(w) END AS e FROM cnt),
scores AS (SELECT doc_id, text, e, b::DOUBLE / n * (1 - lean) AS bs, b::DOUBLE / n * lean AS assamese, h::DOUBLE / n AS hindi, l::DOUBLE / n AS ls FROM shares),
lid AS (SELECT doc_id, text, assamese, hindi, greatest(bs, assamese, hindi, ls) AS score, CASE WHEN greatest(bs, assamese, hindi, ls) = 0 THEN 'und' WHEN bs = greatest(bs, assamese, hindi, ls) THEN 'bn' WHEN assamese = greatest(bs, assamese, hindi, ls) THEN 'as'
 WHEN hindi = greatest(bs, assamese, hindi, ls) THEN 'hi' WHEN e >= 0.05 THEN 'en' ELSE 'und' END AS lang FROM scores)"""


@query(f"WITH {BN}, {_LANG} SELECT doc_id, lang, score, hindi, assamese FROM lid")
def language_scores(spark, d):
    return bn(spark, d).select("doc_id", L.offline_language(T()).alias("v")).select("doc_id", "v.lang", "v.score", "v.hindi", "v.assamese")


@query(f"""WITH {BN}, {_LANG}, c AS (SELECT lid.doc_id, source, lang, score, hindi, assamese, {n_of(R.one_of(R.DEVANAGARI), 'lid.text')} > 0 AS dv, {n_of(R.one_of(R.ASSAMESE), 'lid.text')} > 0 AS asm, {n_of(R.one_of(R.BLOCKED[2:]), 'lid.text')} > 0 AS oth FROM lid JOIN (SELECT doc_id, source FROM documents) USING (doc_id))
SELECT doc_id, CASE WHEN source = 'src3' THEN NULL WHEN lang <> 'bn' OR score < 0.65 THEN 'not_bengali' WHEN hindi > 0.2 OR assamese > 0.2 OR dv OR asm OR oth
 THEN 'contamination: ' || concat_ws(', ', CASE WHEN hindi > 0.2 THEN 'hindi' END, CASE WHEN assamese > 0.2 THEN 'assamese' END, CASE WHEN dv THEN 'devanagari' END, CASE WHEN asm THEN 'assamese_chars' END, CASE WHEN oth THEN 'other_scripts' END) END AS reason FROM c""")
def language_gate(spark, d):
    """Score gate of the language, then the kinds of contamination; Banglish sources pass."""
    return bn(spark, d).select("doc_id", L.language_reason(L.offline_language(T()), T(), F.col("source") == "src3").alias("reason"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'long' WHEN lang = 'fr' THEN 'unknown' ELSE 'other' END AS label, CASE WHEN lang = 'en' THEN round(least(1.0, length(left(text, 1000)) / 1000.0), 4) ELSE CASE WHEN lang = 'fr' THEN 0.0 ELSE 0.5 END END::DOUBLE AS score FROM documents")
def tagged_by_register(spark, d):
    """A tagger per register: native rows by one model, others by another or none."""
    docs = _docs(spark, d).select("doc_id", "text", F.when(F.col("lang") == "en", "native").otherwise(F.col("lang")).alias("register"))
    native = lambda: lambda texts: [("long", min(1.0, len(t) / 1000.0)) for t in texts]
    other = lambda: lambda texts: [("other", 0.5) for _ in texts]
    one = L.tag_by_register(docs.where("register <> 'fr'"), "text", "register", native, other)
    return one.unionByName(L.tag_by_register(docs.where("register = 'fr'"), "text", "register", native)).select("doc_id", "label", "score")


# gates


@query(f"""WITH w AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'x বহুবিকল্প' ELSE 'x' END AS title, CASE doc_id % 5 WHEN 0 THEN '#REDIRECT ' || text ELSE '  ' || text END AS text FROM documents)
SELECT doc_id, length({STRIP('text')})::INTEGER AS n FROM w WHERE length({STRIP('text')}) >= 200 AND NOT contains(title || ' ' || left({STRIP('text')}, 500), 'বহুবিকল্প') AND NOT regexp_matches({STRIP('text')}, '(?i)^#(পুনর্নির্দেশ|REDIRECT)')""")
def wiki_articles(spark, d):
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("#REDIRECT "), T())).otherwise(F.concat(F.lit("  "), T()))
    pages = _docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 7 == 0, "x বহুবিকল্প").otherwise("x").alias("title"), text.alias("text"))
    return collect.wiki_articles(pages).select("doc_id", F.length("text").alias("n"))


_KIND = "CASE doc_id % 4 WHEN 0 THEN 'article' WHEN 1 THEN 'wiki' WHEN 2 THEN 'literature' ELSE 'post' END"


@query(f"""WITH {BN}, k AS (SELECT doc_id, text, {_KIND} AS kind, CASE WHEN doc_id % 9 = 0 THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END AS type FROM bn),
b AS ({SQL['banglish_heuristic']}) SELECT doc_id, length(text) >= CASE kind WHEN 'article' THEN 100 WHEN 'post' THEN 50 ELSE 200 END AND (kind <> 'post' OR banglish) AND lower(type) LIKE 'text/html%' AS passed FROM k JOIN b USING (doc_id)""")
def length_gates(spark, d):
    """Length gates of the collectors, with the Banglish test for posts and the page's type."""
    kind = F.when(F.col("doc_id") % 4 == 0, "article").when(F.col("doc_id") % 4 == 1, "wiki").when(F.col("doc_id") % 4 == 2, "literature").otherwise("post")
    kinds = F.when(F.col("doc_id") % 9 == 0, "application/pdf").otherwise("Text/HTML; charset=utf-8")
    return bn(spark, d).select("doc_id", collect.long_enough(kind, T(), kinds).alias("passed"))


@query(f"WITH g AS (SELECT conv_id, count(*) AS n, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id) SELECT conv_id FROM g WHERE n >= 2 AND length(text) > 50 AND len({WS}) > 10")
def record_gate(spark, d):
    chat = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("content")))).alias("m"))
    text = F.array_join(F.col("m.content"), " ")
    return chat.where(collect.record_gate(F.col("m"), text, F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")))).select("conv_id")


@query("""WITH p AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations)
SELECT conv_id, turn, md5(text) AS user_md5, md5(next) AS assistant_md5 FROM p WHERE next IS NOT NULL AND turn % 3 = 0 AND (conv_id + turn) % 5 <> 0""")
def generated_lines(spark, d):
    """A generator's lines: records, records of one message, torn ones, prose, and answers with a banned mark."""
    from pyspark.sql import Window

    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, d, "conversations").withColumn("next", after).where("next is not null")
    answer = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.concat(F.lit("### "), "next")).otherwise(F.col("next"))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    both = F.to_json(F.struct(F.array(message("user", F.col("text")), message("assistant", answer)).alias("messages")))
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  "), both)).when(F.col("turn") % 3 == 1, F.concat(F.lit("Here: "), both)).otherwise(F.substring(both, F.lit(1), F.length(both) - 3))
    return collect.generated_lines(rows.withColumn("line", line)).select("conv_id", "turn", F.md5("user").alias("user_md5"), F.md5("assistant").alias("assistant_md5"))


@query("SELECT min(conv_id) AS id, md5(text) AS question_md5 FROM conversations WHERE role = 'user' AND text NOT IN (SELECT text FROM conversations WHERE role = 'user' AND conv_id % 3 = 0) GROUP BY text")
def fresh_questions(spark, d):
    asked = table(spark, d, "conversations").where("role = 'user'").select(F.col("conv_id").alias("id"), F.col("text").alias("question"))
    return collect.fresh_questions(asked, asked.where("id % 3 = 0")).select("id", F.md5("question").alias("question_md5"))


@query("""WITH f AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user' AND trim(text) <> '') AS u, arg_min(text, turn) FILTER (role = 'assistant' AND trim(text) <> '') AS a FROM conversations GROUP BY conv_id)
SELECT DISTINCT md5(u) AS user_md5, md5(a) AS assistant_md5 FROM f WHERE u IS NOT NULL AND a IS NOT NULL AND conv_id % 4 IN (0, 1)""")
def category_pairs(spark, d):
    """Pairs of two of the four categories, non-empty and distinct."""
    chat = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    named = chat.withColumn("category", F.element_at(F.array(*[F.lit(c) for c in ("Chat", "Rewrite", "Code", "Other")]), (F.col("conv_id") % 4 + 1).cast("int")))
    return collect.chat_pairs(named, ("Chat", "Rewrite")).select(F.md5("user").alias("user_md5"), F.md5("assistant").alias("assistant_md5"))


@query(f"""WITH {BN} SELECT doc_id FROM bn WHERE (doc_id % 7 = 0 OR DATE '2024-01-01' + (doc_id % 30)::INTEGER >= DATE '2024-01-10') AND length(text) >= 300
 AND CASE WHEN {n_of(chr(92) + 'p{L}')} = 0 THEN 0.0 ELSE {n_of(R.one_of(R.BENGALI))} / {n_of(chr(92) + 'p{L}')} END >= 0.5""")
def news_gate(spark, d):
    """News since a date, undated ones too, long and Bengali enough."""
    dated = bn(spark, d).withColumn("date", F.when(F.col("doc_id") % 7 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))))
    enough = let(T(), lambda t: F.when(F.length(t) >= 300, S.bengali_per_letter(t) >= 0.5))  # the text is made once, though the filter goes below its projection
    return dated.where("date is null or date >= date'2024-01-10'").where(enough).select("doc_id")


@query(f"""WITH {BN}, p AS (SELECT 'p' || doc_id AS id, text FROM bn UNION ALL SELECT 'c' || doc_id, left(text, 400) FROM bn), b AS (SELECT id, text, CASE WHEN {n_of(chr(92) + 'p{L}')} = 0 THEN 0.0 ELSE {n_of('[A-Za-z]')} / {n_of(chr(92) + 'p{L}')} END >= 0.8
 AND len(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]+')), lambda w: w IN ({_in(S.BANGLISH_KEYWORDS)}))) >= 3 AS ok FROM p)
SELECT id, length(text)::INTEGER AS n FROM b WHERE ok AND length(text) >= 50 AND id <> 'p3'""")
def flattened_posts(spark, d):
    """Posts of two listings with a comment each, each once, by the gate for posts, without those seen before."""
    docs = bn(spark, d)
    comment = F.expr("array(named_struct('id', concat('c', doc_id), 'body', left(text, 400)))")
    posts = docs.select(F.explode(F.array(F.lit("hot"), F.lit("new"))).alias("listing"), F.concat(F.lit("p"), "doc_id").alias("id"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"), comment.alias("comments"))
    return collect.flatten_posts(posts, spark.createDataFrame([("p3",)], "id string")).select("id", F.length("text").alias("n"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'b_djvu.txt' WHEN 1 THEN 'a.txt' WHEN 2 THEN 'c.txt' END AS name FROM documents")
def archive_text_file(spark, d):
    file = lambda name, kind: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("format"))
    lists = [F.array(file("a.txt", "Text"), file("b_djvu.txt", "DjVuTXT")), F.array(file("x.pdf", "PDF"), file("a.txt", "Text")), F.array(file("a.txt", "Log"), file("c.txt", "Text")), F.array(file("x.pdf", "Text"), file("y.txt", "Log"))]
    files = F.when(F.col("doc_id") % 4 == 0, lists[0]).when(F.col("doc_id") % 4 == 1, lists[1]).when(F.col("doc_id") % 4 == 2, lists[2]).otherwise(lists[3])
    return _docs(spark, d).select("doc_id", collect.text_file_of(files).alias("name"))


# pages

_HOST, _BARE = "lower(regexp_extract({0}, '://([^/?#]*)', 1))", "regexp_extract({0}, '^([^?#]*)', 1)"
_ROOT = "concat(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1), '://', " + _HOST.format("url") + ")"
_FOLDER = "CASE WHEN regexp_extract(" + _BARE.format("url") + ", '^[^/]*//[^/]*(/.*/|/)', 1) = '' THEN '/' ELSE regexp_extract(" + _BARE.format("url") + ", '^[^/]*//[^/]*(/.*/|/)', 1) END"
_LINKS = f"""hrefs AS (SELECT page_id, url, unnest(list_concat(regexp_extract_all(html, 'href="([^"]*)"', 1), ['x/y', '//other.org/z', 'mailto:a'])) AS u FROM pages),
whole AS (SELECT page_id, url, CASE WHEN regexp_matches({_BARE.format('u')}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {_BARE.format('u')} WHEN starts_with({_BARE.format('u')}, '//') THEN concat(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1), ':', {_BARE.format('u')})
 WHEN starts_with({_BARE.format('u')}, '/') THEN concat({_ROOT}, {_BARE.format('u')}) WHEN {_BARE.format('u')} <> '' THEN concat({_ROOT}, {_FOLDER}, {_BARE.format('u')}) END AS link FROM hrefs),
links AS (SELECT DISTINCT page_id, url, link FROM whole WHERE regexp_matches(link, '^https?://') AND {_HOST.format('link')} = {_HOST.format('url')})"""


def _page_links(spark, d):
    pages = table(spark, d, "pages").withColumn("html", F.concat("html", F.lit('<a href="x/y"><a href="//other.org/z"><a href="mailto:a">')))
    return pages.select("page_id", "url", F.explode(N.resolve_links(F.col("html"), F.col("url"))).alias("link"))


@query(f"WITH {_LINKS} SELECT page_id, link FROM links")
def page_links(spark, d):
    """Links of each page to its own host, resolved."""
    return _page_links(spark, d).select("page_id", "link")


@query(f"""WITH RECURSIVE {_LINKS}, nexts AS (SELECT {_BARE.format('url')} AS a, lead({_BARE.format('url')}) OVER (PARTITION BY {_HOST.format('url')} ORDER BY page_id) AS b FROM pages), l AS (SELECT DISTINCT {_BARE.format('url')} AS a, link AS b FROM links UNION SELECT a, b FROM nexts WHERE b IS NOT NULL),
f(url, depth) AS (SELECT DISTINCT {_BARE.format('url')}, 0 FROM pages WHERE page_id < 20 UNION SELECT l.b, depth + 1 FROM f JOIN l ON l.a = f.url WHERE depth < 3), g AS (SELECT url, min(depth)::INTEGER AS depth, {_HOST.format('url')} AS host FROM f GROUP BY url)
SELECT url, host, depth FROM g QUALIFY row_number() OVER (PARTITION BY host ORDER BY depth, url) <= 25""")
def crawl_walk(spark, d):
    """A walk of depth 3 along the links of the pages' html and to the next page of the host, 25 pages of a host at most."""
    from pyspark.sql import Window

    bare = F.regexp_extract("url", r"^([^?#]*)", 1)
    pages = table(spark, d, "pages").select("page_id", bare.alias("a"), F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)).alias("host"))
    nexts = pages.withColumn("b", F.lead("a").over(Window.partitionBy("host").orderBy("page_id"))).where("b is not null").select("a", "b")
    links = _page_links(spark, d).select(bare.alias("a"), F.col("link").alias("b")).unionByName(nexts)
    return collect.crawl(pages.where("page_id < 20").select(F.col("a").alias("url")), links, 3, 25)


@query()
def readable_text(spark, d):
    """Main text of pages without selectors."""
    return table(spark, d, "pages").select("page_id", md5(N.readable_of_html(F.col("html"))).alias("text_md5"))


# tokenizers


def _model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def token_counts(spark, d):
    """Ids of a SentencePiece model between begin and end: count, digest, and whether they decode to the text."""
    path = _model_path()
    rows = _docs(spark, d).select("doc_id", "text", K.token_ids(T(), path, 1, 2).alias("ids"))
    inner = F.slice("ids", F.lit(2), F.size("ids") - 2)
    return rows.select("doc_id", F.size("ids").alias("n"), F.md5(F.array_join("ids", " ")).alias("ids_md5"), (K.decoded(inner, path) == F.col("text")).alias("same"))


@query()
def token_fertility(spark, d):
    return K.fertility(_docs(spark, d), "text", _model_path())


@query("SELECT (doc_id // 100) AS batch, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1")
def mapped_batches(spark, d):
    """A function over tables of bounded size."""
    import pandas as pd

    change = lambda t: pd.DataFrame({"batch": t["doc_id"] // 100, "c": t["text"].str.len()})
    return order.map_batches(_docs(spark, d).select("doc_id", "text"), change, "batch long, c long", 64).groupBy("batch").agg(F.count("*").alias("n"), F.sum("c").alias("chars"))


# reports

_POLICY_ONLY = _POLICY[_POLICY.index("policy AS (") :]
_SADHU = f"sadhu AS (SELECT doc_id, is_sadhu FROM ({SQL['sadhu_score']}))"


def _sadhu(spark, d):
    rows = bn(spark, d).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat(T(), F.lit(" করিয়া হইল, তাহার সহিত বলিলেন।"))).otherwise(T()))
    return rows.select("doc_id", "source", G.sadhu(T()).alias("s"))


@query(f"""{_LABELLED}, kept AS (SELECT doc_id, source FROM lab QUALIFY row_number() OVER (PARTITION BY component ORDER BY priority DESC, n_chars DESC, doc_id) = 1), {_POLICY_ONLY}, {_SADHU}
SELECT coalesce(bucket, 'train_only') AS bucket, count(*) AS docs, sum(floor(length(text) / 4.45))::BIGINT AS tokens, count(*) FILTER (is_sadhu) AS sadhu FROM kept JOIN documents USING (doc_id) LEFT JOIN policy ON policy.source = kept.source JOIN sadhu USING (doc_id) GROUP BY GROUPING SETS ((coalesce(bucket, 'train_only')), ())""")
def near_dup_report(spark, d):
    """Documents, tokens and literary texts of each release bucket after near duplicates, and in all."""
    labelled = _components(spark, d).join(F.broadcast(sources(spark).select("source", "priority")), "source", "left")
    kept = D.select_survivors(labelled, "component", F.desc(F.coalesce("priority", F.lit(0))), F.desc("n_chars"), F.col("doc_id")).where("kept").select("doc_id", "source")
    facts = _docs(spark, d).select("doc_id", F.floor(F.length("text") / 4.45).alias("t")).join(_sadhu(spark, d).select("doc_id", "s.is_sadhu"), "doc_id")
    rows = kept.join(facts, "doc_id").join(F.broadcast(policy(spark)), "source", "left").withColumn("bucket", F.coalesce("bucket", F.lit("train_only")))
    return rows.rollup("bucket").agg(F.count("*").alias("docs"), F.sum("t").alias("tokens"), F.count_if("is_sadhu").alias("sadhu"))


@query(f"""WITH {_SADHU}, u AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 AS uniq, is_sadhu FROM documents JOIN sadhu USING (doc_id))
SELECT source, count(*) FILTER (uniq) AS n_unique, count(*) FILTER (uniq AND is_sadhu) AS sadhu_docs, coalesce(sum(floor(length(text) / 4.45)) FILTER (uniq AND is_sadhu), 0)::BIGINT AS sadhu_tokens FROM u GROUP BY ROLLUP (source)""")
def register_counts(spark, d):
    """Literary documents and tokens among the unique ones, per source and in all. Only digests and counts are shuffled."""
    docs = _docs(spark, d).select("doc_id", "source", F.sha2("text", 256).alias("sha"), F.floor(F.length("text") / 4.45).alias("t"))
    first = docs.groupBy("sha").agg(F.min("doc_id").alias("doc_id"))
    rows = docs.drop("sha").join(first.select("doc_id"), "doc_id").join(_sadhu(spark, d).select("doc_id", "s.is_sadhu"), "doc_id")
    return rows.rollup("source").agg(F.count("*").alias("n_unique"), F.count_if("is_sadhu").alias("sadhu_docs"), F.coalesce(F.sum(F.when(F.col("is_sadhu"), F.col("t"))), F.lit(0)).alias("sadhu_tokens"))


@query(f"""WITH s AS ({SQL['sadhu_score']}), r AS (SELECT source, count(*) AS n, median(per100)::DOUBLE AS middle, 100.0::DOUBLE * count(*) FILTER (is_sadhu) / count(*) AS pct FROM s JOIN documents USING (doc_id) GROUP BY source)
SELECT source, n, middle, pct FROM r ORDER BY middle DESC, source LIMIT 8""")
def register_report(spark, d):
    """Median score and share of literary texts of each source; the eight with the highest median."""
    rows = _sadhu(spark, d).select("source", "s.per100", "s.is_sadhu")
    by = rows.groupBy("source").agg(F.count("*").alias("n"), F.median("per100").alias("middle"), (100.0 * F.count_if("is_sadhu") / F.count("*")).alias("pct"))
    return by.orderBy(F.desc("middle"), "source").limit(8)


@query(f"""WITH st AS ({SQL['cluster_stats']}), p AS (WITH {_POLICY} SELECT coalesce(bucket, 'train_only') AS bucket, sum(floor(length(text) / 4.45))::BIGINT AS tokens, count(*) AS docs FROM documents LEFT JOIN policy USING (source) GROUP BY 1),
x AS (SELECT count(*) AS read, count(DISTINCT text) AS uniq FROM documents), t AS (SELECT sum(tokens)::BIGINT AS total, (SELECT sum(floor(length(text) / 4.45))::BIGINT FROM documents) AS whole, coalesce(sum(tokens) FILTER (bucket = 'releasable'), 0)::BIGINT AS rel, bool_and(docs = 0 OR tokens > 0) AS filled FROM p)
SELECT unnest(['kept_within_unique', 'input_matches_exact', 'tokens_add_up', 'buckets_have_tokens', 'releasable_dominant', 'counts_add_up']) AS gate,
 unnest([kept <= uniq, abs(n_in - read) <= greatest(1, (0.02 * read)::INTEGER) OR n_in >= read, total = whole, filled, total > 0 AND rel / greatest(1, total) > 0.5, n_in > 0 AND removed BETWEEN 0 AND n_in AND kept + removed = n_in]) AS passed FROM st, x, t""")
def release_checks(spark, d):
    """The six checks of a release over the reports of exact and near duplicates and the buckets; a report is one row."""
    sizes = _components(spark, d).groupBy("component").agg(F.count("*").alias("n"))
    near = sizes.agg(F.sum("n").alias("n_in"), F.count("*").alias("kept"), (F.sum("n") - F.count("*")).alias("removed"))
    docs = _docs(spark, d)
    exact = docs.agg(F.count("*").alias("read"), F.count_distinct("text").alias("uniq"), F.sum(F.floor(F.length("text") / 4.45)).alias("whole"))
    by = docs.join(F.broadcast(policy(spark)), "source", "left").groupBy(F.coalesce("bucket", F.lit("train_only")).alias("bucket")).agg(F.count("*").alias("docs"), F.sum(F.floor(F.length("text") / 4.45)).alias("t"))
    held = by.agg(F.sum("t").alias("total"), F.coalesce(F.sum(F.when(F.col("bucket") == "releasable", F.col("t"))), F.lit(0)).alias("rel"), F.bool_and((F.col("docs") == 0) | (F.col("t") > 0)).alias("filled"))
    r = near.crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(held))
    c = F.col
    gates = {
        "kept_within_unique": c("kept") <= c("uniq"), "input_matches_exact": (F.abs(c("n_in") - c("read")) <= F.greatest(F.lit(1), F.floor(0.02 * c("read")))) | (c("n_in") >= c("read")), "tokens_add_up": c("total") == c("whole"),
        "buckets_have_tokens": c("filled"), "releasable_dominant": (c("total") > 0) & (c("rel") / F.greatest(F.lit(1), c("total")) > 0.5), "counts_add_up": (c("n_in") > 0) & c("removed").between(F.lit(0), c("n_in")) & (c("kept") + c("removed") == c("n_in")),
    }
    return r.select(F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), v.alias("passed")) for k, v in gates.items()])).alias("g")).select("g.gate", "g.passed")


# streams


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, d):
    """Tumbling windows of a stream of events with a watermark, to the end of what is there."""
    from textkiln.plans.streams import _stream

    events = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    windows = streams.tumbling(events, "1 hour", "event_type", late="40 days")
    return streams.run_complete(windows, fresh_path(spark, "windows"), fresh_path(spark, "offsets")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source")
def stream_counters(spark, d):
    """Counts per source of a stream."""
    from textkiln.plans.streams import _stream

    return streams.run_complete(streams.counters(_stream(spark, d, "documents"), "source"), fresh_path(spark, "counters"), fresh_path(spark, "offsets"))


@query(f"""WITH RECURSIVE {_LABELLED.split('WITH RECURSIVE ', 1)[1].split(', edges AS', 1)[0]}, pairs AS (SELECT DISTINCT x.doc_id AS later, y.doc_id AS earlier FROM slices x JOIN slices y ON x.band = y.band AND x.slice = y.slice AND y.doc_id < x.doc_id),
n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents), nb AS (SELECT n.i, n.doc_id, coalesce(list(p.earlier) FILTER (p.earlier IS NOT NULL), []) AS e FROM n LEFT JOIN pairs p ON p.later = n.doc_id GROUP BY n.i, n.doc_id),
f(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT nb.i, CASE WHEN list_has_any(f.kept, nb.e) THEN f.kept ELSE list_append(f.kept, nb.doc_id) END FROM f JOIN nb ON nb.i = f.i + 1)
SELECT unnest(kept) AS doc_id FROM (SELECT kept FROM f ORDER BY i DESC LIMIT 1)""")
def stream_near_dedup(spark, d):
    """Near duplicates of a stream against a table of band buckets that outlives the run; in one batch it equals the greedy rule."""
    from textkiln.plans.dedup import _signatures

    folder, seen = fresh_path(spark, "members"), fresh_path(spark, "near-seen")
    D.band_members(_signatures(spark, d), BANDS, ROWS).write.parquet(folder)
    q = spark.readStream.schema("node long, bucket string").parquet(folder).writeStream.foreachBatch(streams.near_seen_batch(seen)).option("checkpointLocation", fresh_path(spark, "offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    return streams.kept_in(spark, seen, "node long, bucket string").select(F.col("node").alias("doc_id")).distinct()


@query("SELECT source, 'live' AS track, count(*) AS docs FROM documents GROUP BY source")
def stream_rotation(spark, d):
    """A stream written to named shards, shipped to another folder and read there."""
    from textkiln.plans.streams import _stream

    folder, target = fresh_path(spark, "rotating"), fresh_path(spark, "shipped")
    rows = _stream(spark, d, "documents").select("doc_id", "text", "source", F.lit("live").alias("track"))
    rows.writeStream.foreachBatch(streams.rotating_batch(folder, "doc_id", 50, target)).option("checkpointLocation", fresh_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return readers.read_jsonl(spark, target).groupBy("source", F.lit("live").alias("track")).agg(F.count("*").alias("docs"))
