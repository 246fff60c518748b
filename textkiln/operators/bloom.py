"""Duplicates by strategy: none, exact, or a Bloom filter of fixed memory that may drop some unique rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.operators.dedup import exact_dedup

#: Bits of the filter, hashes of a key, and the second seed.
BITS, HASHES, SECOND = 1 << 31, 10, 0x9E3779B1


class Bloom:
    """Double hashing: the i-th bit of a key is h1 + i * h2 modulo the bits."""

    def __init__(self, bits: int, hashes: int = HASHES):
        self.bits, self.hashes, self.held = bits, hashes, bytearray(-(-bits // 8))

    def add(self, key: bytes) -> bool:
        """Whether the key is new; it is held from now on."""
        import xxhash

        first, step = xxhash.xxh64_intdigest(key, seed=0), xxhash.xxh64_intdigest(key, seed=SECOND) | 1
        new = False
        for at in ((first + i * step) % self.bits for i in range(self.hashes)):
            if not self.held[at >> 3] >> (at & 7) & 1:
                self.held[at >> 3] |= 1 << (at & 7)
                new = True
        return new


def bloom_dedup(df: DataFrame, text: str, *order: str, bits: int = BITS, parts: int | None = None) -> DataFrame:
    """Rows whose text was not met before in the order of columns; a false positive drops a unique row.

    The filter is cut into ``parts`` filters by a hash of the text, each filled by one task in order, so equal texts meet and memory is
    bits / 8 / parts bytes a task. Only the text's digest and the order are sorted; a null text is a text like others.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", F.coalesce(F.sha2(text, 256), F.lit("")))
    dealt = keyed.repartition(parts, "_key").sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Bloom(max(8, bits // parts))
        for pdf in batches:
            yield pdf[[seen.add(k.encode()) for k in pdf["_key"]]].drop(columns="_key")

    return dealt.mapInPandas(run, df.schema)


def dedup(df: DataFrame, text: str, *order: str, strategy: str = "exact", **options) -> DataFrame:
    """By name: 'none' keeps all rows, 'exact' the first of each text, 'bloom' the first ones in fixed memory."""
    if strategy == "none":
        return df
    if strategy == "exact":
        return exact_dedup(df.withColumn("_sha", F.coalesce(F.sha2(text, 256), F.lit(""))), "_sha", *[F.col(c) for c in order]).drop("_sha").select(*df.columns)
    if strategy == "bloom":
        return bloom_dedup(df, text, *order, **options)
    raise ValueError(f"unknown strategy {strategy}; known: bloom, exact, none")
