"""Small building blocks on text columns. Python's notions are kept: strip and split work on white space of any kind that is ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hits(text: Column, pattern: str) -> Column:
    """Number of matches."""
    return F.regexp_count(text, F.lit(pattern))


def chars(text: Column, kind: str) -> Column:
    """Characters of the class ``kind``: runs are cut out and the lengths compared, which builds no list of matches."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{kind}+", ""))


def others(text: Column, kind: str) -> Column:
    """Characters outside the class ``kind``: a class in brackets that is negated runs many times slower."""
    return F.length(F.regexp_replace(text, f"{kind}+", ""))


def sub(text: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(text, pattern, to)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def only(row: Column, keep) -> Column:
    """The struct ``row`` in an array if ``keep`` holds for it, else an empty array, to be exploded: a filter on what is costly to compute goes below the projection that computes it, and there computes it again."""
    return F.filter(F.array(row), keep)


def strip(text: Column) -> Column:
    return sub(text, r"^\s+|\s+$")


def words(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0. Both are computed once."""
    return let(F.struct(part.alias("part"), whole.alias("whole")), lambda x: F.when(x["whole"] == 0, F.lit(0.0)).otherwise(x["part"] / F.when(x["whole"] != 0, x["whole"])))


def literal_set(values) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)])


def count_in(tokens: Column, values) -> Column:
    """Tokens that are among values, repeats counted."""
    return F.size(F.filter(tokens, lambda t: t.isin(*sorted(values))))


def ngrams(tokens: Column, n: int) -> Column:
    """Consecutive n-grams joined by a space; none for fewer tokens."""
    none = F.array().cast("array<string>")
    return let(tokens, lambda t: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " "))).otherwise(none))


def any_of(text: Column, patterns) -> Column:
    """Whether any pattern matches, by one alternation."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def patterns_hit(text: Column, patterns) -> Column:
    """Number of the patterns that match."""
    out = F.lit(0)
    for p in patterns:
        out = out + text.rlike(p).cast("int")
    return out
