"""Instruction-tuning pairs: task classes, scores, rejection and chat formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln.functions.normalize import collapse
from textkiln.functions.script import bengali_per_content
from textkiln.functions.tags import EMOJI_PATTERN
from textkiln.functions.text import any_of, hits, lines, ngrams, patterns_hit, strip, words

#: Our own cue lists: ordered tasks with regular expressions over the lower-cased request.
TASKS = (("creative", r"(poem|story|song|letter|কবিতা|গল্প).{0,40}(write|লিখ)|(write|লিখ).{0,40}(poem|story|song|letter|কবিতা|গল্প)"), ("dialogue", r"dialogue|conversation|সংলাপ|কথোপকথন"), ("translation", r"translat|অনুবাদ"), ("math", r"[+×÷%]|equation|সমীকরণ|যোগ|ভাগ"), ("structured", r"\blist\b|steps|তালিকা|ধাপ|the "), ("advice", r"how |should|কিভাবে|উচিত|পরামর্শ| of "))
TEXTBOOK, GENERIC = (r"chapter \d", r"as an ai", r"অধ্যায়"), (r"important", r"various", r"in general", r"গুরুত্বপূর্ণ")
META, TIME_SENSITIVE = (r"here is (a|the)", r"নিচে"), (r"today", r"latest", r"আজ")
EMOTIONS = ("happy", "sad", "আনন্দ", "দুঃখ")
#: Shares of the tasks in a selection.
QUOTAS = {"factual": 0.18, "advice": 0.18, "creative": 0.24, "dialogue": 0.12, "translation": 0.04, "math": 0.12, "structured": 0.12}
LIST_LINE = r"(^|\n)\s*[-*১-৯0-9]"


def classify_task(user: Column) -> Column:
    low = F.lower(user)
    out = F.when(low.rlike(TASKS[0][1]), TASKS[0][0])
    for name, pattern in TASKS[1:]:
        out = out.when(low.rlike(pattern), name)
    return out.otherwise("factual")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def sentence_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[।.!?\n]+"), lambda s: strip(s) != ""))


def repeated_ngrams(text: Column, n: int = 3) -> Column:
    """Share of n-grams that occur more than once, all their occurrences counted; 0 below 3 n words."""
    tokens = words(text)
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("repeated"))

    def step(acc: Column, gram: Column) -> Column:  # over sorted grams: the second of a run brings the first with it
        same = (acc["run"] > 0) & (acc["last"] == gram)
        run = F.when(same, acc["run"] + 1).otherwise(1)
        return F.struct(gram.alias("last"), run.alias("run"), (acc["repeated"] + F.when(same, F.when(acc["run"] == 1, 2).otherwise(1)).otherwise(0)).alias("repeated"))

    count = F.aggregate(F.array_sort(ngrams(tokens, n)), start, step)["repeated"]
    return F.when(F.size(tokens) < 3 * n, 0.0).otherwise(count / F.greatest(F.size(tokens) - n + 1, F.lit(1)))


def repeated_lines(text: Column) -> Column:
    found = F.transform(lines(text), collapse)
    return F.size(found) > F.size(F.array_distinct(found))


def score(user: Column, answer: Column, task: Column, source: Column) -> Column:
    """Additive score of a pair (weights and bands are fixed values)."""
    n, s = word_count(answer), sentence_count(answer)
    lively = task.isin("creative", "dialogue", "advice")
    give = lambda flag, x: F.when(flag, F.lit(float(x))).otherwise(0.0)
    out = bengali_per_content(answer) * 3.0
    out = out + F.when(n.between(18, 160), 2.0).when(n.between(12, 17), 0.8).when(n.between(161, 260), 1.0).otherwise(-1.0)
    out = out + F.when(s.between(2, 6), 1.0).when(s == 1, -0.4).otherwise(-0.2)
    out = out + give((task == "creative") & answer.contains("\n"), 0.8) + give((task == "creative") & (n >= 24), 0.8)
    out = out + give((task == "dialogue") & ((hits(answer, ":") >= 2) | (hits(answer, "ঃ") >= 2)), 1) + give((task == "translation") & (n <= 35), 0.6)
    out = out + give((task == "math") & answer.rlike("[০-৯0-9]"), 0.7) + give((task == "structured") & answer.rlike(LIST_LINE), 0.8)
    out = out + give(source.contains("gold"), 0.8) + give(source.startswith("sft_style_"), 1.5)
    out = out + give(lively & answer.rlike(EMOJI_PATTERN), 0.3) + give(lively & any_of(answer, EMOTIONS), 0.3)
    out = out - patterns_hit(answer, TEXTBOOK) * 2.5 - patterns_hit(answer, GENERIC) * 0.7
    out = out - F.when(task.isin("creative", "dialogue"), patterns_hit(answer, META) * 1.5).otherwise(0.0)
    return out - give(any_of(user, TIME_SENSITIVE), 2) - give(repeated_lines(answer), 1.5) - repeated_ngrams(answer) * 3.0


def reject_reason(user: Column, answer: Column, task: Column, min_ratio: float = 0.35) -> Column:
    """The first reason to drop a pair, null to keep it (limits are fixed values). Works on collapsed text, so a list shows only at its start."""
    user, answer = collapse(user), collapse(answer)
    n = word_count(answer)
    cues = hits(answer, "[:ঃ]")
    return (
        F.when((user == "") | (answer == ""), "empty").when(n < 8, "too_short").when(F.length(answer) > 4096, "too_long")
        .when(bengali_per_content(answer) < min_ratio, "low_bangla").when(patterns_hit(answer, TEXTBOOK) > 0, "textbook_style").when(any_of(user, TIME_SENSITIVE), "time_sensitive")
        .when(repeated_ngrams(answer) > 0.20, "repetitive").when((task == "creative") & (n < 24), "weak_creative").when((task == "dialogue") & (cues < 2), "weak_dialogue")
        .when(task.isin("creative", "dialogue") & (patterns_hit(answer, META) > 0), "meta_response").when((task == "advice") & (n < 16), "shallow_advice")
        .when((task == "structured") & ~answer.rlike(LIST_LINE), "unstructured_answer").when((patterns_hit(answer, GENERIC) >= 3) & (n < 28), "generic_filler")
    )


def topk_score(bn_ratio: Column, answer: Column, user: Column) -> Column:
    """0.5 ratio + 0.3 length band + 0.2 request band (fixed values)."""
    n, m = F.length(answer), F.length(user)
    return bn_ratio * 0.5 + F.when(n < 100, 0.2).when(n < 300, 0.5).when(n < 2000, 1.0).otherwise(0.8) * 0.3 + F.when(m < 10, 0.3).when(m < 200, 1.0).otherwise(0.7) * 0.2


def chatml(messages: Column) -> Column:
    """Messages (role, content) as ChatML."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>"))), "\n")


def instruction_key(text: Column) -> Column:
    return F.left(F.lower(collapse(text)), F.lit(80))


def pseudo_summary(text: Column, title: Column) -> Column:
    """Through the first danda at or after position 50 of a long text, else the title."""
    at = F.locate("।", text, 51)
    return F.when((F.length(text) > 200) & (at > 0), F.substring(text, F.lit(1), at)).otherwise(title)


def valid_pair(kind: Column, answer: Column) -> Column:
    """Least words, line breaks and speaker marks of each kind of gold pair (fixed values)."""
    n, breaks, speakers = word_count(answer), hits(answer, "\n"), hits(answer, "[:ঃ]")
    return (
        F.when(kind == "poem", (n >= 16) & (breaks >= 2)).when(kind == "short_story", n >= 70).when(kind == "dialogue_scene", speakers >= 4)
        .when(kind == "letter_diary", n >= 50).when(kind == "descriptive", n >= 45).when(kind == "children_fable", n >= 55).otherwise(n >= 20)
    )
