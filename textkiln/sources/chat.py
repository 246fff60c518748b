"""Chat records in mixed shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_of(message: Column) -> Column:
    """Content of a message given as JSON: its content, else its parts (strings, or objects with text) by lines, else empty."""
    parts = F.from_json(F.get_json_object(message, "$.parts"), "array<string>")
    texts = F.transform(parts, lambda p: F.when(p.startswith("{"), F.get_json_object(p, "$.text")).otherwise(p))
    return F.coalesce(F.get_json_object(message, "$.content"), F.array_join(F.filter(texts, lambda t: t.isNotNull()), "\n"), F.lit(""))


def pair_of(record: Column) -> Column:
    """Struct (user, assistant) of a record given as JSON without messages: the first of the usual key pairs, questions before answers."""
    out = None
    for q in ("question", "prompt", "instruction", "input"):
        for a in ("answer", "response", "output"):
            u, v = F.get_json_object(record, f"$.{q}"), F.get_json_object(record, f"$.{a}")
            pair = F.struct(u.alias("user"), v.alias("assistant"))
            out = F.when(u.isNotNull() & v.isNotNull(), pair) if out is None else out.when(u.isNotNull() & v.isNotNull(), pair)
    return out


def pair_in(record: Column) -> Column:
    """Struct (user, assistant) of a record given as JSON: its first non-empty user and assistant messages, else pair_of, else null."""
    messages = F.from_json(F.get_json_object(record, "$.messages"), "array<struct<role: string, content: string>>")
    turn = lambda role: F.get(F.filter(messages, lambda m: (m["role"] == role) & (F.trim(F.coalesce(m["content"], F.lit(""))) != "")), F.lit(0))["content"]
    return F.coalesce(F.when(turn("user").isNotNull() & turn("assistant").isNotNull(), F.struct(turn("user").alias("user"), turn("assistant").alias("assistant"))), pair_of(record))
