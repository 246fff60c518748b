"""Instruction-tuning pairs from conversations and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.functions import sft as P
from textkiln.operators import order
from textkiln.functions import ranges as R
from textkiln.functions.script import bengali_per_content, bengali_per_visible
from textkiln.plans.base import BENGALI, LATIN, n_of, query, table
from textkiln.plans.scalars import _RATIO, LINES, STRIP, SUB

_PAIRS = "pairs AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user' AND text <> '') AS u, arg_min(text, turn) FILTER (role = 'assistant' AND text <> '') AS a FROM conversations GROUP BY conv_id HAVING u IS NOT NULL AND a IS NOT NULL)"
#: The same with Bengali letters in three of four answers and a smiling one in some, so that ratios and moods differ.
_BN_PAIRS = _PAIRS.replace("pairs AS", "plain AS") + f""", pairs AS (SELECT conv_id, u, concat(CASE WHEN conv_id % 4 <> 0 THEN translate(lower(a), '{LATIN}', '{BENGALI}') ELSE a END, CASE WHEN conv_id % 5 = 0 THEN chr(128512) ELSE '' END) AS a FROM plain)"""
_TASK = "CASE " + " ".join(f"WHEN regexp_matches(lower(u), '{p}') THEN '{n}'" for n, p in P.TASKS) + " ELSE 'factual' END"


def pairs(spark, d) -> DataFrame:
    """First user and first assistant turn that aren't empty."""
    turn = lambda role: F.min_by(F.when((F.col("role") == role) & (F.col("text") != ""), F.col("text")), F.when((F.col("role") == role) & (F.col("text") != ""), F.col("turn")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(turn("user").alias("u"), turn("assistant").alias("a")).where("u is not null and a is not null")


def bn_pairs(spark, d) -> DataFrame:
    """Pairs with Bengali letters in three of four answers and a smiling one in some."""
    made = F.when(F.col("conv_id") % 4 != 0, F.translate(F.lower("a"), LATIN, BENGALI)).otherwise(F.col("a"))
    return pairs(spark, d).withColumn("a", F.concat(made, F.when(F.col("conv_id") % 5 == 0, "\U0001f600").otherwise("")))


U, A = (lambda: F.col("u")), (lambda: F.col("a"))


@query(f"WITH {_PAIRS} SELECT conv_id, md5(u) AS u_md5, md5(a) AS a_md5 FROM pairs")
def extract_pairs(spark, d):
    return pairs(spark, d).select("conv_id", F.md5("u").alias("u_md5"), F.md5("a").alias("a_md5"))


@query("SELECT conv_id, md5(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY turn)) AS chat_md5, count(*)::INTEGER AS n_messages FROM conversations GROUP BY conv_id")
def chatml(spark, d):
    chat = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return chat.select("conv_id", F.md5(P.chatml(F.col("m"))).alias("chat_md5"), F.size("m").alias("n_messages"))


@query("SELECT conv_id, turn, role = 'assistant' AS is_target, length('<|im_start|>' || role || chr(10) || text || '<|im_end|>')::INTEGER AS n FROM conversations")
def loss_mask(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", (F.col("role") == "assistant").alias("is_target"), F.length(F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>"))).alias("n"))


@query(f"WITH {_PAIRS} SELECT conv_id, {_TASK} AS task FROM pairs")
def task_class(spark, d):
    return pairs(spark, d).select("conv_id", P.classify_task(U()).alias("task"))


def _ws(c):
    return f"list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')"


def _rep3(c):
    grams = f"list_transform(range(1, len({_ws(c)}) - 1), lambda i: array_to_string({_ws(c)}[i:i + 2], ' '))"
    return f"CASE WHEN len({_ws(c)}) < 9 THEN 0.0::DOUBLE ELSE (SELECT coalesce(sum(k) FILTER (k > 1), 0)::DOUBLE / sum(k) FROM (SELECT count(*) AS k FROM unnest({grams}) t(g) GROUP BY g)) END"


_CONTENT = lambda c: _RATIO(n_of("[\\x{0980}-\\x{09FF}]", c), n_of("[^\\s.,;:!?\\-()\\[\\]{}\\x22\\x27`/\\\\|@#$%^&*+=~<>0-9]", c))
_HITS = lambda ps, c: " + ".join(f"regexp_matches({c}, '{p}')::INTEGER" for p in ps)
_LN = LINES.replace("text", "a")
_FACTS = f"""f AS (SELECT *, len({_ws('a')}) AS n, len(list_filter(string_split_regex(a, '[।.!?\\n]+'), lambda s: {STRIP('s')} <> '')) AS s, {_CONTENT('a')} AS ratio, {_TASK} AS task, {_rep3('a')} AS rep,
 len({_LN}) > len(list_distinct(list_transform({_LN}, lambda l: trim({SUB('l', '\\s+', ' ')})))) AS rl FROM pairs)"""
_SCORE = f"""(CASE WHEN conv_id % 3 = 0 THEN 0.8 WHEN conv_id % 3 = 1 THEN 1.5 ELSE 0 END + CASE WHEN task IN ('creative', 'dialogue', 'advice') AND regexp_matches(a, '{R.one_of(R.EMOJI)}') THEN 0.3 ELSE 0 END + ratio * 3.0::DOUBLE + CASE WHEN n BETWEEN 18 AND 160 THEN 2.0 WHEN n BETWEEN 12 AND 17 THEN 0.8 WHEN n BETWEEN 161 AND 260 THEN 1.0 ELSE -1.0 END + CASE WHEN s BETWEEN 2 AND 6 THEN 1.0 WHEN s = 1 THEN -0.4 ELSE -0.2 END
 + CASE WHEN task = 'creative' AND contains(a, chr(10)) THEN 0.8 ELSE 0 END + CASE WHEN task = 'creative' AND n >= 24 THEN 0.8 ELSE 0 END + CASE WHEN task = 'dialogue' AND ({n_of(':', 'a')} >= 2 OR {n_of('ঃ', 'a')} >= 2) THEN 1 ELSE 0 END
 + CASE WHEN task = 'translation' AND n <= 35 THEN 0.6 ELSE 0 END + CASE WHEN task = 'math' AND regexp_matches(a, '[০-৯0-9]') THEN 0.7 ELSE 0 END + CASE WHEN task = 'structured' AND regexp_matches(a, '(^|\\n)\\s*[-*১-৯0-9]') THEN 0.8 ELSE 0 END
 + CASE WHEN task IN ('creative', 'dialogue', 'advice') AND regexp_matches(a, 'happy|sad|আনন্দ|দুঃখ') THEN 0.3 ELSE 0 END - ({_HITS(P.TEXTBOOK, 'a')}) * 2.5 - ({_HITS(P.GENERIC, 'a')}) * 0.7
 - CASE WHEN task IN ('creative', 'dialogue') THEN ({_HITS(P.META, 'a')}) * 1.5 ELSE 0 END - CASE WHEN regexp_matches(u, 'today|latest|আজ') THEN 2 ELSE 0 END - CASE WHEN rl THEN 1.5 ELSE 0 END - rep * 3.0)::DOUBLE"""


@query(f"WITH {_BN_PAIRS}, {_FACTS} SELECT conv_id, {_SCORE} AS score FROM f")
def pair_score(spark, d):
    source = F.when(F.col("conv_id") % 3 == 0, "my_gold_set").when(F.col("conv_id") % 3 == 1, "sft_style_own").otherwise("chat")
    return bn_pairs(spark, d).select("conv_id", P.score(U(), A(), P.classify_task(U()), source).alias("score"))


@query(f"""WITH {_BN_PAIRS}, c AS (SELECT conv_id, trim({SUB('u', '\\s+', ' ')}) AS u, trim({SUB('a', '\\s+', ' ')}) AS a, u AS raw FROM pairs), f AS (SELECT *, len({_ws('a')}) AS n, {_CONTENT('a')} AS ratio, {_TASK.replace('lower(u)', 'lower(raw)')} AS task, {_rep3('a')} AS rep FROM c)
SELECT conv_id, CASE WHEN u = '' OR a = '' THEN 'empty' WHEN n < 8 THEN 'too_short' WHEN length(a) > 4096 THEN 'too_long' WHEN ratio < 0.35 THEN 'low_bangla' WHEN ({_HITS(P.TEXTBOOK, 'a')}) > 0 THEN 'textbook_style' WHEN regexp_matches(u, 'today|latest|আজ') THEN 'time_sensitive'
 WHEN rep > 0.2 THEN 'repetitive' WHEN task = 'creative' AND n < 24 THEN 'weak_creative' WHEN task = 'dialogue' AND {n_of('[:ঃ]', 'a')} < 2 THEN 'weak_dialogue' WHEN task IN ('creative', 'dialogue') AND ({_HITS(P.META, 'a')}) > 0 THEN 'meta_response'
 WHEN task = 'advice' AND n < 16 THEN 'shallow_advice' WHEN task = 'structured' AND NOT regexp_matches(a, '(^|\\n)\\s*[-*১-৯0-9]') THEN 'unstructured_answer' WHEN ({_HITS(P.GENERIC, 'a')}) >= 3 AND n < 28 THEN 'generic_filler' END AS reason FROM f""")
def pair_reject(spark, d):
    return bn_pairs(spark, d).select("conv_id", P.reject_reason(U(), A(), P.classify_task(U())).alias("reason"))


@query(f"""WITH {_BN_PAIRS}, s AS (SELECT conv_id, left(lower(trim({SUB('u', '\\s+', ' ')})), 80) AS k, CASE WHEN length(a) < 50 THEN 'too_short' WHEN length(a) > 4096 THEN 'too_long' WHEN {_CONTENT('a')} < 0.4 THEN 'low_bangla' END AS r, trim(a) = '' AS e FROM pairs), x AS (SELECT *, CASE WHEN r IS NULL THEN row_number() OVER (PARTITION BY r IS NULL, k ORDER BY conv_id) END AS rn FROM s)
SELECT conv_id, coalesce(r, CASE WHEN rn > 1 THEN 'duplicate' WHEN e THEN 'empty' ELSE 'kept' END) AS status FROM x""")
def curate_chain(spark, d):
    """Length limits and the Bengali ratio, then duplicates by the instruction's first 80 characters among what is left, then blanks."""
    first = F.when(F.length("a") < 50, "too_short").when(F.length("a") > 4096, "too_long").when(bengali_per_content(A()) < 0.4, "low_bangla")
    rows = bn_pairs(spark, d).select("conv_id", P.instruction_key(U()).alias("k"), first.alias("r"), (F.trim("a") == "").alias("e"))
    rank = F.row_number().over(Window.partitionBy(F.col("r").isNull(), "k").orderBy("conv_id"))
    return rows.withColumn("rn", rank).select("conv_id", F.coalesce("r", F.when(F.col("rn") > 1, "duplicate").when(F.col("e"), "empty").otherwise("kept")).alias("status"))


_TOP = f"CASE WHEN length(a) < 100 THEN 0.2 WHEN length(a) < 300 THEN 0.5 WHEN length(a) < 2000 THEN 1.0 ELSE 0.8 END::DOUBLE * 0.3 + CASE WHEN length(u) < 10 THEN 0.3 WHEN length(u) < 200 THEN 1.0 ELSE 0.7 END::DOUBLE * 0.2"


_VISIBLE = _RATIO(n_of("[\\x{0980}-\\x{09FF}]", "a"), n_of("\\S", "a"))


@query(f"WITH {_BN_PAIRS} SELECT conv_id, {_VISIBLE} * 0.5 + {_TOP} AS score FROM pairs ORDER BY score DESC, conv_id LIMIT 20")
def topk_pairs(spark, d):
    return bn_pairs(spark, d).select("conv_id", P.topk_score(bengali_per_visible(A()), A(), U()).alias("score")).orderBy(F.desc("score"), "conv_id").limit(20)


_QUOTA = "CASE task " + " ".join(f"WHEN '{k}' THEN {int(40 * v)}" for k, v in P.QUOTAS.items()) + " ELSE 0 END"


@query(f"""WITH {_PAIRS}, t AS (SELECT conv_id, {_TASK} AS task, length(a) AS score FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY score DESC, conv_id) <= {_QUOTA} AS inq FROM t), o AS (SELECT *, row_number() OVER (ORDER BY inq DESC, score DESC, conv_id) AS p FROM r)
SELECT conv_id, task, inq AS in_quota FROM o WHERE p <= 40""")
def balanced_select(spark, d):
    """Task quotas of 40 by score, filled up with the best of the rest."""
    rows = pairs(spark, d).select("conv_id", P.classify_task(U()).alias("task"), F.length("a").alias("score"))
    quota = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in P.QUOTAS.items() for x in (k, int(40 * v))]), F.col("task")), F.lit(0))
    rank = F.row_number().over(Window.partitionBy("task").orderBy(F.desc("score"), "conv_id"))
    return rows.withColumn("in_quota", rank <= quota).orderBy(F.desc("in_quota"), F.desc("score"), "conv_id").limit(40).select("conv_id", "task", "in_quota")


@query("""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('3:' || doc_id)) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n, CASE lang WHEN 'en' THEN 50 WHEN 'es' THEN 400 WHEN 'de' THEN 200 ELSE 0 END AS q FROM documents)
SELECT doc_id, lang, k::BIGINT AS copy_no, k > 0 AS oversampled FROM r, range(CASE WHEN q > r THEN (q - r - 1) // n + 1 ELSE 0 END) t(k)""")
def oversample(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return order.oversample(docs, "lang", {"en": 50, "es": 400, "de": 200}, order.seeded(3, F.col("doc_id"))).select("doc_id", "lang", F.col("copy_no").cast("long").alias("copy_no"), "oversampled")


@query("""WITH p AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS t FROM pages), x AS (SELECT page_id, k, 'q' || (('0x' || substr(md5(page_id || ':' || k), 1, 4))::INTEGER % 3) AS template, md5(t) AS title_md5 FROM p, range(3) r(k))
SELECT page_id, k::INTEGER AS kind, template, title_md5 FROM x ORDER BY page_id, k LIMIT 200""")
def news_expand(spark, d):
    """Three pairs of each article, templates by hash, cut at 200 pairs."""
    rows = table(spark, d, "pages").select("page_id", F.md5(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1)).alias("title_md5"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("kind"))
    pick = F.conv(F.substring(F.md5(F.concat_ws(":", "page_id", "kind")), 1, 4), 16, 10).cast("int") % 3
    return rows.select("page_id", "kind", F.concat(F.lit("q"), pick).alias("template"), "title_md5").orderBy("page_id", "kind").limit(200)


@query("SELECT k::INTEGER AS k, 't' || (k % 7) AS template FROM range(50) r(k)")
def template_bank(spark, d):
    bank = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "i int, template string")
    return spark.range(50).select(F.col("id").cast("int").alias("k")).join(F.broadcast(bank), F.col("k") % 7 == F.col("i")).select("k", "template")


_KINDS = ("poem", "short_story", "dialogue_scene", "letter_diary", "descriptive", "children_fable", "reflection")


@query(f"""WITH v AS (SELECT doc_id, text, ['{"', '".join(_KINDS)}'][doc_id % 7 + 1] AS kind, len({_ws('text')}) AS n FROM documents)
SELECT doc_id, kind, CASE kind WHEN 'poem' THEN n >= 16 AND {n_of('\\n')} >= 2 WHEN 'short_story' THEN n >= 70 WHEN 'dialogue_scene' THEN {n_of('[:ঃ]')} >= 4 WHEN 'letter_diary' THEN n >= 50 WHEN 'descriptive' THEN n >= 45 WHEN 'children_fable' THEN n >= 55 ELSE n >= 20 END AS valid FROM v""")
def gold_valid(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", kind.alias("kind"), P.valid_pair(kind, F.col("text")).alias("valid"))


@query(f"""WITH {_BN_PAIRS}, t AS (SELECT conv_id, a, {_TASK} AS task, 's' || (conv_id % 12) AS source FROM pairs), r AS (SELECT 'task' AS kind, task AS name, count(*) AS n FROM t GROUP BY task
 UNION ALL (SELECT 'source', source, count(*) AS n FROM t GROUP BY source ORDER BY n DESC, source LIMIT 10) UNION ALL SELECT 'rows', 'emoji', count(*) FILTER (regexp_matches(a, '{R.one_of(R.EMOJI)}')) FROM t
 UNION ALL SELECT 'rows', 'emotion', count(*) FILTER (regexp_matches(a, 'happy|sad|আনন্দ|দুঃখ')) FROM t) SELECT kind, name, n FROM r""")
def selection_report(spark, d):
    """Counts by task, the ten most frequent sources, and rows with emoji or words of emotion."""
    from textkiln.functions.text import any_of

    t = bn_pairs(spark, d).select("a", P.classify_task(U()).alias("task"), F.concat(F.lit("s"), F.col("conv_id") % 12).alias("source"))
    tasks = t.groupBy(F.lit("task").alias("kind"), F.col("task").alias("name")).agg(F.count("*").alias("n"))
    top = t.groupBy(F.lit("source").alias("kind"), F.col("source").alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(10)
    moods = t.agg(F.count_if(F.col("a").rlike(P.EMOJI_PATTERN)).alias("emoji"), F.count_if(any_of(F.col("a"), P.EMOTIONS)).alias("emotion"))
    return tasks.unionByName(top).unionByName(moods.unpivot([], ["emoji", "emotion"], "name", "n").withColumn("kind", F.lit("rows")))


#: Our own pairs of plain style, for a set of fixed examples.
STYLE = (("তুমি কেমন আছো?", "আমি ভালো আছি। তুমি কেমন?"), ("একটু সাহায্য করবে?", "অবশ্যই, কী দরকার বলো।"), ("ধন্যবাদ", "কোনো ব্যাপার না, আবার এসো।"), ("আজ মন খারাপ", "কী হয়েছে? চাইলে আমাকে বলতে পারো।"))


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{u}', '{a}', 'sft_style_own')" for i, (u, a) in enumerate(STYLE)) + ") t(i, user, assistant, source)")
def style_pairs(spark, d):
    """The fixed examples."""
    return spark.createDataFrame([(i, u, a, "sft_style_own") for i, (u, a) in enumerate(STYLE)], "i int, user string, assistant string, source string")


@query("""WITH v AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations), r AS (SELECT conv_id, turn, text, next, turn % 4 AS shape FROM v WHERE next IS NOT NULL)
SELECT conv_id, turn, md5(text) AS user_md5, md5(next) AS assistant_md5 FROM r WHERE shape <> 3""")
def pairs_of_records(spark, d):
    """Pairs of records in mixed shapes: messages first, else the first of the usual key pairs; records with neither leave."""
    from textkiln.sources.chat import pair_in

    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, d, "conversations").withColumn("next", after).where("next is not null")
    message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    shape = F.col("turn") % 4
    record = (
        F.when(shape == 0, F.to_json(F.struct(F.array(message("system", "next"), message("user", "text"), message("assistant", "next")).alias("messages"), F.lit("no").alias("prompt"), F.lit("no").alias("output"))))
        .when(shape == 1, F.to_json(F.struct(F.col("text").alias("instruction"), F.col("next").alias("response"), F.lit("x").alias("input"))))
        .when(shape == 2, F.to_json(F.struct(F.col("next").alias("output"), F.col("text").alias("question")))).otherwise(F.to_json(F.struct(F.col("text").alias("question"))))
    )
    return rows.select("conv_id", "turn", pair_in(record).alias("p")).where("p is not null").select("conv_id", "turn", F.md5("p.user").alias("user_md5"), F.md5("p.assistant").alias("assistant_md5"))


@query(f"SELECT doc_id, md5(CASE WHEN length(t) > 200 AND instr(substr(t, 51), '।') > 0 THEN left(t, 50 + instr(substr(t, 51), '।')) ELSE source END) AS summary_md5 FROM (SELECT doc_id, source, replace(text, '.', '।') AS t FROM documents)")
def pseudo_summary(spark, d):
    t = F.replace(F.col("text"), F.lit("."), F.lit("।"))
    return table(spark, d, "documents").select("doc_id", F.md5(P.pseudo_summary(t, F.col("source"))).alias("summary_md5"))


@query("""WITH v AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN to_json({'role': role, 'content': text}) WHEN 1 THEN to_json({'role': role, 'parts': [text, 'x']}) ELSE to_json({'role': role}) END AS j, text FROM conversations)
SELECT conv_id, turn, md5(CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'x' ELSE '' END) AS content_md5 FROM v""")
def extract_content(spark, d):
    """Content of messages in mixed shapes: content, parts or neither."""
    from textkiln.sources.chat import content_of

    turn = F.col("turn") % 3
    raw = F.when(turn == 0, F.to_json(F.struct("role", F.col("text").alias("content")))).when(turn == 1, F.to_json(F.struct("role", F.array("text", F.lit("x")).alias("parts")))).otherwise(F.to_json(F.struct("role")))
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(content_of(raw)).alias("content_md5"))


