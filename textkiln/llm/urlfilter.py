"""URL filter: rules by host and path, and for other URLs a naive Bayes model over segmented words.

A unigram model of all words of the pages splits concatenated host and path names by Viterbi search ("cheappills" to
"cheap", "pills"). A multinomial naive Bayes model over these words judges the URLs that no rule decides. There are no
labelled URLs, so its training labels are weak: a page is an example to block if its URL has a seed word of unwanted URLs and none of
wanted ones, or if the text of the page itself is junk, and an example to allow otherwise. A word is so judged by the pages of all
URLs that have it, and a URL by all its words. The rules say nothing about words, so their verdicts are not trained on.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.common import batch_of, slices, text_batches
from textkiln.operators.storage import materialize

#: Fixed rules: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Seed words of unwanted and wanted URLs. Each is a word of the language model with this share of all words at least, and counts as
#: this many examples of its side in each place where it can stand.
BLOCK_SEEDS = ("spam", "pills", "cheap", "casino", "poker", "bet", "bets", "ads", "loan", "loans", "xxx", "porn", "adult", "farm", "viagra", "escort", "free", "win", "click")
ALLOW_SEEDS = ("blog", "news", "wiki", "docs", "forum", "edu", "science", "library", "museum", "article")
SEED_SHARE, SEED_WEIGHT = 1e-4, 5
#: A text is junk with fewer words than this, with this share of words that repeat earlier ones, or of words that hold three equal marks in a row.
LEAST_WORDS, MOST_REPEATED, MOST_MARKED = 5, 0.8, 0.3
#: Strength of the smoothing: every word is as if it had been seen so often, in the proportion of all words.
SMOOTHING = 5.0
#: Letters of a piece of a name at most, and of a name: a longer run of letters is several names.
PIECE, NAME = 32, 256
#: Tables of words up to this many rows are broadcast (about 20 MB); larger ones are joined by a shuffle.
BROADCAST_WORDS = 200_000

HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; null where none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered]
    pick = lambda value: reduce(lambda acc, x: acc.when(x[0], F.lit(value(x[1]))), zip(fits[1:], ordered[1:], strict=True), F.when(fits[0], F.lit(value(ordered[0]))))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


_WORD, _DROP = re.compile("[a-z]+"), re.compile(r"<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", re.S)
_MARKS = re.compile(r"([^\w\s])\1\1")


def text_of(html: str) -> str:
    return _DROP.sub(" ", html)


def is_junk(text: str) -> bool:
    words = text.split()
    n = len(words)
    return n < LEAST_WORDS or n - len(set(words)) >= MOST_REPEATED * n or sum(1 for w in words if _MARKS.search(w)) >= MOST_MARKED * n


FACTS = [("word", pa.string(), "string"), ("n", pa.int64(), "long"), ("junk", pa.bool_(), "boolean")]


def read_pages(pages: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over all whole texts: a row (junk, key, host, path, rule, ruled) for each page, and rows (word, n) of word counts."""
    carried = [key, "host", "path", "rule", "ruled"]
    kinds = {c: pages.schema[c].dataType.simpleString() for c in carried}
    ddl = ", ".join([f"{name} {kind}" for name, _, kind in FACTS] + [f"`_{c}` {kinds[c]}" for c in carried])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        schema = None

        def give() -> pa.RecordBatch:
            out = [pa.array(list(seen)), pa.array(list(seen.values()), pa.int64()), pa.nulls(len(seen), pa.bool_())]
            return batch_of(schema, out + [pa.nulls(len(seen), f.type) for f in list(schema)[3:]])

        for batch in slices(batches, text, 4 << 20):
            if schema is None:
                schema = pa.schema([(name, kind) for name, kind, _ in FACTS] + [(f"_{c}", batch.column(c).type) for c in carried])
            junk = []
            for x in batch.column(text).to_pylist():
                bare = text_of(x or "")
                junk.append(is_junk(bare))
                seen.update(_WORD.findall(bare.lower()))
            yield batch_of(schema, [pa.nulls(len(junk), pa.string()), pa.nulls(len(junk), pa.int64()), pa.array(junk), *[batch.column(c) for c in carried]])
            if len(seen) > 200_000:
                yield give()
                seen = Counter()
        if seen:
            yield give()

    return pages.select(text, *carried).mapInArrow(run, ddl)


class Segmenter:
    """Most probable split of a name into words; unknown pieces cost more the longer they are. ``counts`` has all pieces of the names to split."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (total if total is not None else sum(counts.values())) + 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0

    def split(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - PIECE), end):
                cost = self.cost.get(name[start:end])
                options.append((best[start] + (self.unknown + 3.0 * (end - start) if cost is None else cost), start))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]


def names_of(host: Column, path: Column) -> Column:
    """Array of (mark, name): 't' the last label of the host, 'h' names of its other labels, 'p' names of the path in lower case.

    A name is a run of ASCII letters, of digits (all written 0) or of characters outside ASCII; everything else is a border.
    """
    name = F.lit(f"([a-z]{{1,{NAME}}}|[0-9]+|[^\\x00-\\x7F]{{1,{NAME}}})")
    digits = lambda x: F.when(x.rlike("^[0-9]"), F.lit("0")).otherwise(x)
    marked = lambda mark, found: F.transform(found, lambda x: F.struct(F.lit(mark).alias("mark"), digits(x).alias("name")))
    top = F.element_at(F.split(host, r"\."), -1)
    rest = F.left(host, F.length(host) - F.length(top))
    return F.concat(marked("t", F.when(top != "", F.array(top)).otherwise(F.array().cast("array<string>"))), marked("h", F.regexp_extract_all(rest, name, 1)), marked("p", F.regexp_extract_all(F.lower(path), name, 1)))


def segment(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(name, pieces) for the distinct letter names of ``names`` (name) by the counts in ``words`` (word, n): only what occurs in a name is looked up.

    A name has PIECE times its length of pieces at most, so a group is bounded.
    """
    n = F.length("name")
    starts = F.sequence(F.lit(1), n - 1)
    within = lambda i: F.transform(F.sequence(F.lit(2), F.least(n - i + 1, F.lit(PIECE))), lambda k: F.substring(F.col("name"), i, k))
    long = names.where(n > 1)
    pieces = long.select("name", F.explode(F.array_distinct(F.flatten(F.transform(starts, within)))).alias("word"))
    known = pieces.join(bounded(words), "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    schema = pa.schema([("name", pa.string()), ("pieces", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, found in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist(), strict=True):
                out.append(Segmenter({r["word"]: r["n"] for r in found or ()}, total).split(name))
            yield batch_of(schema, [batch.column("name"), out])

    return names.join(known, "name", "left").mapInArrow(run, "name string, pieces array<string>")


def bounded(df: DataFrame) -> DataFrame:
    """``df``, a table, with a broadcast hint if it has BROADCAST_WORDS rows at most."""
    return F.broadcast(df) if df.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS else df


def log_odds(a: Column, b: Column, allow: float, block: float) -> Column:
    """Of a word with ``a`` and ``b`` examples, when all words have ``allow`` and ``block``: 0 for a word never seen."""
    whole = allow + block
    return F.log((b + SMOOTHING * block / whole) / block) - F.log((a + SMOOTHING * allow / whole) / allow)


def judge(pages: DataFrame, *, rules=RULES, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict, log_odds) for every page: the rule's verdict or else the model's (block above 0).

    Null URLs and ones without :// have empty host and path, fit no rule and are judged by the prior. A null or empty html has no words and
    is junk. A very long URL is split into many names. Counts are over all words of all pages and live in tables; of the words only those that
    stand in a name are looked up, and words never seen count for neither side. Repeated rows are judged alike and each is an example;
    an empty table gives an empty one. Other columns, also of clashing names, are not read.
    """
    parts = text_batches(pages).select(F.col(key), F.col(text).cast("string").alias(text), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    facts = materialize(read_pages(parts.withColumns({"rule": rule, "ruled": ruled}), key, text), "url-facts")
    rows = facts.where("junk is not null").select(F.col(f"_{key}").alias(key), *[F.col(f"_{c}").alias(c) for c in ("host", "path", "rule", "ruled")], "junk")
    counts = facts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    seeds = pages.sparkSession.createDataFrame([(w, max(1, int(total * SEED_SHARE))) for w in (*BLOCK_SEEDS, *ALLOW_SEEDS)], "word string, n long")
    words = materialize(counts.unionByName(seeds).groupBy("word").agg(F.max("n").alias("n")), "url-words")

    urls = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.count_if("junk").alias("junk"))
    named = materialize(urls.withColumn("names", names_of(F.col("host"), F.col("path"))), "urls")
    single = named.select("host", "path", F.posexplode("names").alias("at", "x")).select("host", "path", "at", "x.mark", "x.name")
    letters = single.where("mark <> 't' and name rlike '^[a-z]'").select("name").distinct()
    split = materialize(segment(letters, words, total), "names")
    placed = single.join(bounded(split), "name", "left").withColumn("pieces", F.when((F.col("mark") == "t") | F.col("pieces").isNull(), F.array("name")).otherwise(F.col("pieces")))
    tokens = placed.groupBy("host", "path").agg(F.flatten(F.array_sort(F.collect_list(F.struct("at", F.transform("pieces", lambda w: F.concat_ws(":", "mark", w)).alias("w"))))["w"]).alias("tokens"))
    known = named.join(tokens, ["host", "path"], "left").select("host", "path", "n", "junk", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    has = lambda seeds: F.arrays_overlap("tokens", F.array(*[F.lit(f"{mark}:{w}") for mark in "hp" for w in seeds]))
    known = known.withColumn("b", F.when(has(BLOCK_SEEDS) & ~has(ALLOW_SEEDS), F.col("n")).otherwise(F.col("junk")))
    known = materialize(known.withColumn("a", F.col("n") - F.col("b")), "url-tokens")

    seen = known.select(F.explode("tokens").alias("token"), "a", "b")
    m = seen.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()  # of the pages alone
    given = [(f"{mark}:{w}", SEED_WEIGHT * (not side), SEED_WEIGHT * side) for side, seeds in enumerate((ALLOW_SEEDS, BLOCK_SEEDS)) for mark in "hp" for w in seeds]
    seen = seen.unionByName(pages.sparkSession.createDataFrame(given, "token string, a long, b long"))
    examples = materialize(seen.groupBy("token").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-examples")
    n = known.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    prior = math.log(((n["b"] or 0) + 1) / ((n["a"] or 0) + 1))
    odds = examples.select("token", log_odds(F.col("a"), F.col("b"), (m["a"] or 0) + 1, (m["b"] or 0) + 1).alias("odds"))
    scored = known.select("host", "path", F.explode_outer("tokens").alias("token")).join(bounded(odds), "token", "left").groupBy("host", "path").agg((F.coalesce(F.sum("odds"), F.lit(0.0)) + prior).alias("log_odds"))
    out = rows.join(bounded(materialize(scored, "url-scores")), ["host", "path"])
    return out.select(key, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"), "log_odds")
