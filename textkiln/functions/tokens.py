"""Tokenizers that are given by a factory: counts, ids with begin and end, decoding, round trips, vocabulary lookups."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.functions.workers import by_workers

#: A factory is called once per worker; the tokenizer has encode(text) -> ids, decode(ids) -> text and pieces() -> list of strings.
Factory = Callable[[], "object"]


class SentencePieces:
    """A SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)

    def pieces(self) -> list[str]:
        return [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]


class HuggingTokenizer:
    """A file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids, skip_special_tokens=False)

    def pieces(self) -> list[str]:
        return [self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size())]


@lru_cache(4)
def tokenizer_of(path: str):
    """One per worker and file."""
    return SentencePieces(path) if path.endswith(".model") else HuggingTokenizer(path)


def _ids_array(found: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))))


def token_ids(text: Column, path: str, begin: int | None = None, end: int | None = None) -> Column:
    """Ids of the whole text, between ``begin`` and ``end`` where these are given; a null text has none of its own."""

    def make():
        model = tokenizer_of(path)
        return lambda rows: _ids_array([[] if t is None else model.encode(t) for t in rows])

    mark = lambda x: [F.array(F.lit(x))] if x is not None else []
    return F.concat(*mark(begin), by_workers(make, "array<int>", pa.list_(pa.int32()))(text), *mark(end))


def decoded(ids: Column, path: str) -> Column:
    def make():
        model = tokenizer_of(path)
        return lambda rows: [None if x is None else model.decode(x) for x in rows]

    return by_workers(make, "string", pa.string())(ids)


def vocabulary(spark, path: str) -> DataFrame:
    """(id, piece) of the tokenizer's file: bounded by its vocabulary."""
    return spark.createDataFrame(list(enumerate(tokenizer_of(path).pieces())), "id int, piece string")


def fertility(docs: DataFrame, text: str, path: str) -> DataFrame:
    """One row: n_tokens, n_words, per_word, in_range (1.3 to 1.8), single (share of distinct words that are one token), round_trips (texts that decode to themselves)."""
    rows = docs.select(F.col(text).alias("t")).withColumn("ids", token_ids(F.col("t"), path))
    words = F.filter(F.split(F.col("t"), r"\s+"), lambda w: w != "")
    sums = rows.agg(F.sum(F.size("ids")).alias("n_tokens"), F.sum(F.size(words)).alias("n_words"), F.count_if(decoded(F.col("ids"), path) == F.col("t")).alias("round_trips"))
    distinct = docs.select(F.explode(F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")).alias("w")).distinct()
    single = distinct.agg(F.avg((F.size(token_ids(F.col("w"), path)) == 1).cast("double")).alias("single"))
    out = sums.crossJoin(F.broadcast(single))  # two tables of one row
    per_word = F.col("n_tokens") / F.col("n_words")
    return out.select("n_tokens", "n_words", per_word.alias("per_word"), per_word.between(1.3, 1.8).alias("in_range"), "single", "round_trips")
