"""Scalar queries: normalization and features of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions import normalize as N
from textkiln.functions import ranges as R
from textkiln.functions import script as S
from textkiln.functions import tags as G
from textkiln.functions.text import words
from textkiln.plans.base import BN, bn, md5, n_of, query, table
from textkiln.plans.base import text as T

SP = R.one_of(R.ODD_SPACES)
#: The documents with white space, symbols and marks put in, so that every rule has work.
DIRTY = "concat('  ', replace(replace(replace(text, 'e ', concat('e', chr(160), '  ')), '. ', concat('...!? | ', chr(9472))), 'le', concat('l', chr(2509), chr(2509), 'e')), chr(13), chr(10), chr(10), chr(10), chr(10), 'x|y 3|4 ', chr(8205), '&amp; &lt;b&gt; http://a.b/c me@x.yz  ')"
DIRTY_SQL = f"dirty AS (SELECT doc_id, {DIRTY} AS text FROM documents)"
STRIP = lambda t: f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
SUB = lambda t, p, r="": f"regexp_replace({t}, '{p}', '{r}', 'g')"


def white_sql(t: str) -> str:
    inner = SUB(SUB(SUB(SUB(t, SP, " "), " {2,}", " "), "\\r\\n?", "\n"), "\\n{3,}", "\n\n")
    return STRIP(f"array_to_string(list_transform(string_split({inner}, chr(10)), lambda l: {STRIP('l')}), chr(10))")


DIRTY_SPARK = DIRTY
for _number in (160, 9472, 2509, 8205):
    DIRTY_SPARK = DIRTY_SPARK.replace(f"chr({_number})", f"'{chr(_number)}'")


def dirty(spark, d):
    return table(spark, d, "documents").select("doc_id", F.expr(DIRTY_SPARK).alias("text"))


def _norm(name, column, sql):
    def run(spark, d):
        out = dirty(spark, d).withColumn("out", column())
        return out.select("doc_id", md5("out").alias("out_md5"), F.length("out").alias("n_out"))

    run.__name__ = name
    query(f"WITH {DIRTY_SQL}, o AS (SELECT doc_id, {sql} AS out FROM dirty) SELECT doc_id, md5(out) AS out_md5, length(out)::INTEGER AS n_out FROM o")(run)


_norm("norm_whitespace", lambda: N.clean_whitespace(T()), white_sql("text"))
_norm("norm_punctuation", lambda: N.squeeze_punctuation(T()), SUB("text", "[।!?.]{2,}([।!?.])", "\\1"))
_norm("norm_pipe_danda", lambda: N.pipe_to_danda(T()), f"replace({SUB(SUB('text', '(\\d)\\|(\\d)', '\\1' + chr(0xE001) + '\\2'), '\\|', '।')}, chr(57345), '|')")
_norm("norm_hasanta", lambda: N.squeeze_hasanta(T()), SUB("text", "\\x{09CD}{2,}", "্"))
_norm("norm_orphan_marks", lambda: N.drop_orphan_marks(F.replace(T(), F.lit("a"), F.lit(" া্"))), SUB("replace(text, 'a', concat(' ', chr(2494), chr(2509)))", "(^|\\s)[\\x{09BE}-\\x{09CD}\\x{09D7}\\x{09BC}]+", "\\1"))
_norm("norm_joiners", lambda: N.clean_joiners(T()), SUB("text", "[\\x{200C}\\x{200D}\\x{E000}]"))
_norm("norm_symbols", lambda: N.remove_symbols(T()), SUB("text", R.one_of(R.USELESS)))
_norm("norm_lite", lambda: N.cleanup_lite(T()), white_sql(SUB(SUB("text", "https?://\\S+|www\\.\\S+"), "\\S+@\\S+\\.\\S+")))
_norm("norm_collapse", lambda: N.collapse(T()), f"trim({SUB('text', '\\s+', ' ')})")
_norm("norm_wikitext", lambda: N.strip_wikitext(F.replace(T(), F.lit("th"), F.lit("{{x}}[[t]]''h"))), STRIP(SUB(SUB("replace(text, 'th', '{{x}}[[t]]''''h')", "\\{\\{[^{}]*\\}\\}|\\[\\[|\\]\\]|''''''?|<[^>]+>"), "\\n{3,}", "\n\n")))
_norm("norm_entities", lambda: N.unescape_common(T()), "replace(replace(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')")
_norm("norm_unescape", lambda: N.unescape(T()), "replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')")
_norm("norm_nfc", lambda: N.nfc(F.concat(T(), F.lit("éয়"))), "nfc_normalize(concat(text, 'e', chr(769), chr(2479), chr(2492)))")


@query(f"WITH {BN} SELECT doc_id, md5(text) AS out_md5, length(text)::INTEGER AS n_out FROM bn")
def norm_nfkc(spark, d):
    """Compatibility characters put into the documents (ligatures, full-width and circled forms) come out as the plain ones they stand for."""
    wide = T()
    for plain, odd in (("fi", "ﬁ"), ("ff", "ﬀ"), ("A", "Ａ"), ("b", "ｂ"), ("1", "①"), ("...", "…")):
        wide = F.replace(wide, F.lit(plain), F.lit(odd))
    out = bn(spark, d).withColumn("out", N.nfkc(wide))
    return out.select("doc_id", md5("out").alias("out_md5"), F.length("out").alias("n_out"))


_LITE_SQL = lambda t: SUB(SUB(t, "https?://\\S+|www\\.\\S+"), "\\S+@\\S+\\.\\S+")


def subset_sql(t: str) -> str:
    pairs = ((2465, 2492, 2524), (2466, 2492, 2525), (2479, 2492, 2527), (2503, 2494, 2507))
    for a, b, c in pairs:
        t = f"replace({t}, concat(chr({a}), chr({b})), chr({c}))"
    return SUB(f"translate({t}, concat(chr(2544), chr(2545)), concat(chr(2480), chr(2476)))", "[ \\t]+", " ")


def cleanup_sql(t: str) -> str:
    t = SUB(_LITE_SQL(t), R.one_of(R.USELESS))
    t = f"replace({SUB(SUB(t, '(\\d)\\|(\\d)', '\\1' + chr(0xE001) + '\\2'), '\\|', '।')}, chr(57345), '|')"
    t = SUB(SUB(t, "\\x{09CD}{2,}", "্"), "(^|\\s)[\\x{09BE}-\\x{09CD}\\x{09D7}\\x{09BC}]+", "\\1")
    return white_sql(SUB(SUB(t, "[\\x{200C}\\x{200D}\\x{E000}]"), "[।!?.]{2,}([।!?.])", "\\1"))


_UNESCAPED = "replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query(f"""WITH {BN.replace('bn AS', 'raw AS')}, bn AS (SELECT doc_id, source, {DIRTY} AS text FROM raw), w AS (SELECT doc_id, source, {white_sql(_UNESCAPED)} AS t FROM bn),
o AS (SELECT doc_id, CASE WHEN source = 'src3' THEN {white_sql(_LITE_SQL('lower(t)'))} ELSE {cleanup_sql(subset_sql('t'))} END AS out FROM w)
SELECT doc_id, md5(out) AS out_md5, length(out)::INTEGER AS n_out FROM o""")
def norm_profile_a(spark, d):
    """The whole of profile A on documents with entities, odd spaces, symbols, marks, joiners and addresses put in."""
    raw = bn(spark, d).withColumn("text", F.expr(DIRTY_SPARK))
    out = raw.withColumn("out", N.normalize_document(T(), F.col("source") == "src3"))
    return out.select("doc_id", md5("out").alias("out_md5"), F.length("out").alias("n_out"))


@query(f"WITH {BN} SELECT doc_id, md5({subset_sql('text')}) AS out_md5 FROM bn")
def norm_bengali_subset(spark, d):
    return bn(spark, d).select("doc_id", md5(N.bengali_subset(T())).alias("out_md5"))


_JUNK_LINE = f"({'|'.join(N.BOILERPLATE)})"


@query(f"""WITH {BN}, j AS (SELECT doc_id, concat(text, chr(10), 'সর্বস্বত্ব  সংরক্ষিত ২০২৪', chr(10), chr(10), chr(10), 'x', chr(10), 'বিজ্ঞাপন') AS text FROM bn)
SELECT doc_id, md5({STRIP(SUB(f"array_to_string(list_filter(string_split(text, chr(10)), lambda l: NOT regexp_matches(l, '{_JUNK_LINE}')), chr(10))", "\\n{3,}", "\n\n"))}) AS out_md5 FROM j""")
def norm_boilerplate(spark, d):
    return bn(spark, d).select("doc_id", md5(N.clean_boilerplate(F.concat(T(), F.lit("\nসর্বস্বত্ব  সংরক্ষিত ২০২৪\n\n\nx\nবিজ্ঞাপন")))).alias("out_md5"))


@query("SELECT doc_id, sha256(substr(text, 1, 128)) AS id, sha256(text) AS sha FROM documents")
def doc_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.substring("text", 1, 128), 256).alias("id"), F.sha2("text", 256).alias("sha"))


_B = n_of(R.one_of(R.BENGALI))
_RATIO = lambda a, b: f"CASE WHEN {b} = 0 THEN 0.0::DOUBLE ELSE {a}::DOUBLE / {b} END"


@query(f"""WITH {BN}, c AS (SELECT doc_id, {_B} AS b, {n_of(chr(92) + 'p{L}')} AS l, {n_of(chr(92) + 'S')} AS s, {n_of("[^" + chr(92) + "s.,;:!?" + chr(92) + "-()" + chr(92) + "[" + chr(92) + "]{}" + chr(92) + "x22" + chr(92) + "x27`/" + chr(92) + chr(92) + "|@#$%^&*+=~<>0-9]")} AS k FROM bn)
SELECT doc_id, {_RATIO('b', 'l')} AS per_letter, {_RATIO('b', 's')} AS per_visible, {_RATIO('b', 'k')} AS per_content FROM c""")
def char_ratios(spark, d):
    return bn(spark, d).select("doc_id", S.bengali_ratios(T()).alias("r")).select("doc_id", "r.per_letter", "r.per_visible", "r.per_content")


#: Letters of the Bengali and Devanagari blocks, for a language without class intersection.
BN_L, DV_L = "[\\x{0980}\\x{0985}-\\x{09B9}\\x{09BD}\\x{09CE}\\x{09DC}-\\x{09E1}\\x{09F0}\\x{09F1}\\x{09FC}]", "[\\x{0904}-\\x{0939}\\x{093D}\\x{0950}\\x{0958}-\\x{0961}\\x{0971}-\\x{097F}]"
COUNTS = f"""counts AS (SELECT *, bengali + latin + other + assamese AS letters FROM (SELECT doc_id, text, {n_of(R.one_of(R.BENGALI_LETTERS))} AS bengali, {n_of(R.one_of(R.LATIN))} AS latin, {n_of(R.one_of(R.ASSAMESE))} AS assamese,
 {n_of(R.one_of(R.BLOCKED))} AS blocked, {n_of(chr(92) + 'p{L}')} - {n_of(R.one_of(R.LATIN))} - {n_of(BN_L)} - {n_of(DV_L)} AS other FROM bn))"""


@query(f"WITH {BN}, {COUNTS} SELECT doc_id, bengali, latin, assamese, blocked, other, letters FROM counts")
def script_counts(spark, d):
    return bn(spark, d).select("doc_id", S.script_facts(T()).alias("c")).select("doc_id", "c.*")


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


WORDS = f"list_filter(string_split({SUB('lower(text)', '[^\\p{L}\\p{N}]+', ' ')}, ' '), lambda w: w <> '')"
ROUTE = f"""routed AS (SELECT doc_id, CASE WHEN blocked >= 5 OR blocked / m >= 0.005 THEN 'reject:blocked_script' WHEN other / m >= 0.05 THEN 'reject:foreign_script'
 WHEN assamese >= 15 OR assamese / greatest(1, bengali) >= 0.005 THEN 'reject:assamese' WHEN bengali / m >= 0.88 AND latin / m <= 0.05 THEN CASE WHEN bengali < 200 THEN 'reject:too_short' ELSE 'native:ok' END
 WHEN latin / m > 0.5 THEN CASE WHEN len(w) >= 4 AND bh >= 2 AND bh >= eh THEN 'banglish:romanized' ELSE 'reject:english_or_other' END
 WHEN bengali / m >= 0.5 AND latin / m >= 0.05 THEN 'codeswitch:codeswitch' ELSE 'reject:low_signal' END AS v FROM (SELECT *, greatest(1, letters)::DOUBLE AS m, len(list_filter(w, lambda x: x IN ({_in(S.BANGLISH_MARKERS)}))) AS bh, len(list_filter(w, lambda x: x IN ({_in(S.ENGLISH_MARKERS)}))) AS eh
 FROM (SELECT *, {WORDS} AS w FROM counts)))"""


@query(f"WITH {BN}, {COUNTS}, {ROUTE} SELECT doc_id, split_part(v, ':', 1) AS track, split_part(v, ':', 2) AS reason FROM routed")
def script_route(spark, d):
    return bn(spark, d).select("doc_id", S.route(T()).alias("v")).select("doc_id", "v.track", "v.reason")


@query(f"WITH {BN}, {COUNTS} SELECT doc_id, CASE WHEN bengali / greatest(1, letters) >= 0.9 THEN 'bengali' WHEN latin / greatest(1, letters) >= 0.9 THEN 'latin' ELSE 'mixed' END AS label FROM counts")
def script_label(spark, d):
    c = F.col("c")
    whole = F.greatest(F.lit(1), c["letters"])
    return bn(spark, d).select("doc_id", S.script_facts(T()).alias("c")).select("doc_id", S.script_label(c["bengali"] / whole, c["latin"] / whole).alias("label"))


@query(f"WITH {BN} SELECT doc_id, {n_of(R.one_of(R.DEVANAGARI))} AS devanagari_chars, {n_of(R.one_of(R.ASSAMESE))} AS assamese_chars, {n_of(R.one_of(R.BLOCKED[2:]))} AS other_script_chars FROM bn")
def contamination(spark, d):
    return bn(spark, d).select("doc_id", *[c.alias(k) for k, c in S.contamination(T()).items()])


@query(f"""WITH {BN} SELECT doc_id, {_RATIO(n_of('[A-Za-z]'), n_of(chr(92) + 'p{L}'))} >= 0.8 AND len(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]+')), lambda w: w IN ({_in(S.BANGLISH_KEYWORDS)}))) >= 3 AS banglish FROM bn""")
def banglish_heuristic(spark, d):
    return bn(spark, d).select("doc_id", S.is_banglish(T()).alias("banglish"))


def _dialect_sql():
    has = lambda ws: f"len(list_filter(kinds, lambda x: x IN ({_in(ws)})))"
    rows = ", ".join(f"{{'score': 2 * {has(s)} + {has(w)}, 'rank': {-i}, 'strong': {has(s)}, 'name': '{n}'}}" for i, (n, (s, w)) in enumerate(G.DIALECTS.items()))
    return f"""WITH {BN}, t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_\\x{{0980}}-\\x{{09FF}}]+') AS tokens FROM bn), k AS (SELECT *, list_distinct(tokens) AS kinds FROM t),
b AS (SELECT *, list_max([{rows}]) AS b FROM k), o AS (SELECT *, b.strong >= 2 OR (b.strong >= 1 AND b.score / greatest(1, len(tokens)) >= 0.03) AS ok FROM b)
SELECT doc_id, CASE WHEN ok THEN b.name ELSE 'standard' END AS dialect, CASE WHEN ok THEN b.score ELSE 0 END::INTEGER AS score FROM o"""


@query(_dialect_sql())
def dialect(spark, d):
    return bn(spark, d).select("doc_id", G.dialect(T()).alias("d")).select("doc_id", "d.dialect", "d.score")


@query(f"""WITH {BN}, s AS (SELECT doc_id, nfc_normalize(concat(text, ' করিয়া হইল, তাহার সহিত বলিলেন।')) AS text FROM bn WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, text FROM bn WHERE doc_id % 2 <> 0),
t AS (SELECT doc_id, unnest(list_filter(list_transform(string_split_regex(text, '\\s+'), lambda w: regexp_replace(w, '^[{G.SADHU_STRIP.replace("'", "''")}]+|[{G.SADHU_STRIP.replace("'", "''")}]+$', '', 'g')), lambda w: regexp_matches(w, '{R.one_of(R.BENGALI)}'))) AS t FROM s),
c AS (SELECT doc_id, concat(CASE WHEN starts_with(t, 'হই') AND length(t) >= 4 THEN 'a' ELSE '' END, CASE WHEN contains(t, 'িয়াছ') THEN 'b' ELSE '' END, CASE WHEN contains(t, 'িতেছ') THEN 'c' ELSE '' END, CASE WHEN contains(t, 'িবার') THEN 'd' ELSE '' END,
 CASE WHEN t LIKE '%িয়া' AND length(t) >= 5 AND t NOT IN ({_in(G.NOT_PARTICIPLES)}) THEN 'e' ELSE '' END, CASE WHEN (t LIKE '%িলেন' OR t LIKE '%িলাম') AND t NOT IN ({_in(G.NOT_FINITE)}) THEN 'f' ELSE '' END,
 CASE WHEN (t LIKE '%িবেন' OR t LIKE '%িবে') AND length(t) >= 5 AND t NOT IN ({_in(G.NOT_FUTURE)}) THEN 'g' ELSE '' END, CASE WHEN t IN ({_in(G.PRONOUNS)}) THEN 'h' ELSE '' END, CASE WHEN t IN ({_in(G.PARTICLES)}) THEN 'i' ELSE '' END) AS c FROM t),
a AS (SELECT doc_id, count(*) AS tokens, count(*) FILTER (c <> '') AS hits, array_to_string(list_sort(list_distinct(regexp_extract_all(string_agg(c, ''), '.'))), '') AS cats FROM c GROUP BY doc_id)
SELECT documents.doc_id, coalesce(100.0 * hits / tokens, 0)::DOUBLE AS per100, coalesce(cats, '') AS cats, coalesce(hits, 0)::INTEGER AS hits, coalesce(tokens, 0)::INTEGER AS tokens, coalesce(100.0 * hits / tokens >= 5 AND length(cats) >= 2, false) AS is_sadhu FROM documents LEFT JOIN a USING (doc_id)""")
def sadhu_score(spark, d):
    rows = bn(spark, d).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat(T(), F.lit(" করিয়া হইল, তাহার সহিত বলিলেন।"))).otherwise(T()))
    return rows.select("doc_id", G.sadhu(T()).alias("s")).select("doc_id", "s.per100", "s.cats", "s.hits", "s.tokens", "s.is_sadhu")


@query(f"SELECT doc_id, {n_of(R.one_of(R.EMOJI), 'replace(text, chr(101), chr(128512))')} AS emoji_count FROM documents")
def emoji(spark, d):
    return table(spark, d, "documents").select("doc_id", G.emoji_count(F.replace(T(), F.lit("e"), F.lit("\U0001f600"))).alias("emoji_count"))


def _profanity_sql():
    parts = []
    for level in ("high", "medium", "mild"):
        parts.append(f"list_concat(list_filter([{_in(G.PROFANITY_BN[level])}], lambda x: contains(text, x)), regexp_extract_all(lower(text), '\\b({'|'.join(sorted(G.PROFANITY_ROMAN[level], key=len, reverse=True))})\\b', 1))")
    return f"""WITH {BN}, l AS (SELECT doc_id, {parts[0]} AS h, {parts[1]} AS m, {parts[2]} AS k FROM bn)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(list_concat(h, m), k))), ',') AS hits, CASE WHEN len(h) > 0 THEN 'high' WHEN len(m) > 0 THEN 'medium' WHEN len(k) > 0 THEN 'mild' END AS severity, (len(h) + len(m) + len(k))::INTEGER AS n FROM l"""


@query(_profanity_sql())
def profanity(spark, d):
    return bn(spark, d).select("doc_id", G.profanity(T()).alias("p")).select("doc_id", F.array_join("p.hits", ",").alias("hits"), "p.severity", F.col("p.count").alias("n"))


@query(f"""SELECT doc_id, {n_of(G.EMAIL)} AS n_emails, {n_of(G.URL)} AS n_urls,
 regexp_matches(lower(text), '\\b({"|".join(G.NSFW_ROMAN)})\\b') OR regexp_matches(text, '{"|".join(G.NSFW_BN)}') AS nsfw FROM (SELECT doc_id, replace(text, 'the and ', 'the hot video ') AS text FROM documents)""")
def pii_nsfw(spark, d):
    p = G.personal_data(T())
    return table(spark, d, "documents").withColumn("text", F.replace("text", F.lit("the and "), F.lit("the hot video "))).select("doc_id", p["n_emails"].alias("n_emails"), p["n_urls"].alias("n_urls"), G.nsfw(T()).alias("nsfw"))


@query("SELECT doc_id, regexp_matches(concat('x', text, ' 01712345678x'), '(^|[^\\d])(\\+?880|0)1[3-9]\\d{8}($|[^\\d])') AS has_phone FROM documents")
def pii_phone(spark, d):
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("x"), T(), F.lit(" 01712345678x")).rlike(G.PHONE).alias("has_phone"))


LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {STRIP('l')}), lambda l: l <> '')"
WS = "list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')"
QUALITY = f"""q1 AS (SELECT *, {LINES} AS lines, string_split(text, ',') AS segs, {WS} AS ws, len(list_filter(string_split_regex(text, '[।!?\\n]'), lambda s: {STRIP('s')} <> '')) AS sents, {_RATIO(n_of(chr(92) + 'p{L}'), 'length(text)')} AS lr FROM src),
q2 AS (SELECT *, CASE WHEN len(lines) < 2 THEN 0.0 ELSE 1 - len(list_distinct(lines)) / len(lines) END::DOUBLE AS rep, CASE WHEN len(segs) < 6 THEN 0.0 ELSE len(list_filter(segs, lambda s: len(list_filter(string_split_regex(s, '\\s+'), lambda w: w <> '')) BETWEEN 1 AND 3)) / len(segs) END::DOUBLE AS comma,
 {_RATIO('len(ws)', 'sents')} AS mean FROM q1), q3 AS (SELECT *, comma >= 0.6 OR rep >= 0.5 OR (mean < 3 AND len(ws) > 20) AS spam, len(ws) < 15 AS short, lr < 0.45 AS low_letter FROM q2)"""


@query(f"""WITH src AS (SELECT doc_id, text FROM documents), {QUALITY}
SELECT doc_id, greatest(0.0, least(1.0, 1.0 - CASE WHEN spam THEN 0.5 ELSE 0 END - least(0.3::DOUBLE, rep * 0.6::DOUBLE) - least(0.2::DOUBLE, comma * 0.3::DOUBLE) - CASE WHEN low_letter THEN 0.2 ELSE 0 END - CASE WHEN short THEN 0.15 ELSE 0 END))::DOUBLE AS score,
 spam, short, low_letter, rep >= 0.3 AS repetitive, rep AS rep_ratio, comma AS comma_ratio, mean AS mean_sent_words FROM q3""")
def quality_tags(spark, d):
    return table(spark, d, "documents").select("doc_id", G.quality_tags(T()).alias("q")).select("doc_id", "q.score", "q.spam", "q.short", "q.low_letter", "q.repetitive", "q.rep_ratio", "q.comma_ratio", "q.mean_sent_words")


@query("SELECT doc_id, floor(length(text) / 4.45)::BIGINT AS tokens FROM documents")
def token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.floor(F.length(T()) / 4.45).alias("tokens"))


@query("""WITH h AS (SELECT doc_id, text, left(text, 500) AS h FROM documents), p AS (SELECT *, CASE WHEN contains(h, '।') THEN length(h) - instr(reverse(h), '।') + 1 ELSE 0 END AS a, CASE WHEN contains(h, '.') THEN length(h) - instr(reverse(h), '.') + 1 ELSE 0 END AS b,
 CASE WHEN contains(h, chr(10)) THEN length(h) - instr(reverse(h), chr(10)) + 1 ELSE 0 END AS c FROM h)
SELECT doc_id, md5(CASE WHEN length(text) <= 500 THEN text WHEN a - 1 > 250 THEN left(h, a) WHEN b - 1 > 250 THEN left(h, b) WHEN c - 1 > 250 THEN left(h, c) ELSE h END) AS out_md5 FROM p""")
def truncate_sentence(spark, d):
    return table(spark, d, "documents").select("doc_id", md5(N.truncate_at_sentence(T(), 500)).alias("out_md5"))


_UNESC = "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query(f"""WITH b AS (SELECT page_id, html, regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g') AS b FROM pages),
a AS (SELECT page_id, html, coalesce(nullif(regexp_extract(b, '(?is)<article[^>]*>(.*?)</article>', 1), ''), b) AS a FROM b)
SELECT page_id, md5(array_to_string(list_filter(list_transform(string_split_regex(a, '(?i)<p\\b[^>]*>')[2:], lambda p: trim(regexp_replace({_UNESC.format("regexp_replace(p, '<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g'))), lambda p: p <> ''), chr(10) || chr(10))) AS article_md5,
 md5(trim({_UNESC.format("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")})) AS title_md5 FROM a""")
def html_article(spark, d):
    return table(spark, d, "pages").select("page_id", md5(N.article_of_html(F.col("html"))).alias("article_md5"), md5(N.title_of_html(F.col("html"))).alias("title_md5"))


@query("""SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda u: regexp_extract(u, '^([^?#]*)', 1)))), ' ') AS links FROM pages""")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(F.array_sort(N.links_of_html(F.col("html"))), " ").alias("links"))


@query("SELECT page_id, split_part(url, '#', 1) AS bare, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages")
def url_parts(spark, d):
    return table(spark, d, "pages").select("page_id", F.split_part("url", F.lit("#"), F.lit(1)).alias("bare"), F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)).alias("host"))


@query(f"SELECT doc_id, len({WS})::INTEGER AS n_words, sum(len({WS})) OVER (PARTITION BY lang)::BIGINT AS lang_words FROM documents")
def word_counts(spark, d):
    n = table(spark, d, "documents").select("doc_id", "lang", F.size(words(T())).alias("n_words"))
    by = n.groupBy("lang").agg(F.sum("n_words").alias("lang_words"))  # few languages: partial sums, then a table of some rows
    return n.join(by, "lang").select("doc_id", "n_words", "lang_words")
