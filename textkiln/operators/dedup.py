"""Exact and near duplicates: survivors by order or priority, MinHash signatures, band edges, survivors of components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.functions.text import let, ngrams, words
from textkiln.functions.workers import by_workers, cuts, trim
from textkiln.operators.storage import materialize

#: The Mersenne prime 2^61 - 1 of the permutations, and the bits of a signature value.
P61 = (1 << 61) - 1
MASK32 = (1 << 32) - 1
#: Words of more bytes are hashed as a whole.
_LONG = 48
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def first_wins(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """Rows that come first among those of equal key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def exact_dedup(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per value of ``key``, such as the SHA-256 of a text; the first by ``order``.

    Aggregates before it shuffles, so a hot text costs one row a task. All columns travel: leave the text out and join it back where it is wanted.
    """
    names = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_row"))
    return best.select(key, "_row.*")


def word_shingles(text: Column, n: int = 5) -> Column:
    """Distinct word n-grams; a shorter text is one shingle of all its words."""
    short = lambda t: F.array(F.array_join(t, " "))
    return let(words(text), lambda t: F.array_distinct(F.when(F.size(t) < n, short(t)).otherwise(ngrams(t, n))))


def char_shingles(text: Column, n: int = 5) -> Column:
    """Distinct character n-grams; a shorter text is one shingle, a null one has none.

    The text is cut into characters once: substring() would count from the text's beginning for every gram.
    """
    grams = let(F.split(text, ""), lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(c, i, n), "")))
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def distinct_grams(text: str, n: int = 5) -> int:
    """How many distinct character n-grams a text has, exactly; a shorter text is one."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) <= n:
        return 1
    bits, size = 64 // n, len(c) - n + 1
    if int(c.max()) >> bits:
        c = np.unique(c, return_inverse=True)[1]  # the text's own alphabet
    large = int(c.max()) >> bits > 0
    gram = c[:size].astype(np.uint64)
    for i in range(1, n):
        if large:  # still too many letters: what precedes is numbered first
            gram = np.unique(gram, return_inverse=True)[1].astype(np.uint64)
        gram = (gram << np.uint64(21 if large else bits)) | c[i : i + size].astype(np.uint64)
    gram.sort()
    return 1 + int(np.count_nonzero(gram[1:] != gram[:-1]))


def count_char_shingles(text: Column, n: int = 5) -> Column:
    """The size of char_shingles() by Arrow workers, which make no string of a shingle."""
    return by_workers(lambda: lambda rows: [0 if t is None else distinct_grams(t, n) for t in rows], "int", pa.int32())(text)


def hash60(text: Column) -> Column:
    """60 bits of the MD5, below 2^61 - 1, the same in every engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def permutations(n: int, seed: int = 1) -> list[tuple[int, int]]:
    """n pairs (a in [1, 2^31), b in [0, P)) of a fixed generator: a of 31 bits keeps every product below 2^63."""
    out, state = [], seed
    for _ in range(n):
        pair = []
        for _ in range(2):
            state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            pair.append(state >> 3)
        out.append((1 + pair[0] % ((1 << 31) - 1), pair[1] % P61))
    return out


def permuted(x: np.ndarray, perms: list[tuple[int, int]]) -> Iterator[np.ndarray]:
    """For each permutation ((a x + b) mod P) mod 2^32 of hashes below 2^60, in an array that the next one overwrites.

    a x + b is q 2^61 + r with q at most 2^30, and 2^61 is 1 modulo P, so the remainder is q + r, less P where that is P or more. As 2^61 is 0
    modulo 2^32, the low 32 bits of q + r are those of a x + b + q. q + r reaches P only where the upper 30 bits of r are 2^30 - 2 at least: those
    rare hashes get one more, as P is -1 modulo 2^32.
    """
    u, low31, low30 = np.uint64, np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    high, low, word = x >> u(31), x & low31, x.astype(np.uint32)
    t, h, q, out = np.empty_like(x), np.empty_like(x), np.empty_like(x), np.empty_like(word)
    for a, b in perms:
        np.multiply(low, u(a), out=t)
        t += u(b)
        np.right_shift(t, u(31), out=q)
        np.multiply(high, u(a), out=h)
        h += q
        np.right_shift(h, u(30), out=q)
        h &= low30
        np.multiply(word, np.uint32(a), out=out)
        out += np.uint32(b & MASK32)
        out += q.astype(np.uint32)
        if len(x) and int(h.max()) >= (1 << 30) - 2:
            r = (h << u(31)) | (t & low31)
            out += (q + r >= u(P61)).astype(np.uint32)
        yield out


def signatures_of(sets: list[np.ndarray], perms: list[tuple[int, int]], block: int = 16384, most: int = 1 << 19) -> np.ndarray:
    """For each set (none empty) of hashes below 2^60 a row: for each permutation the least ((a x + b) mod P) mod 2^32.

    Sets are taken together up to ``most`` hashes. Where these are mostly the same ones, as character n-grams are, each is permuted once and the sets gather
    rows of that table; else the hashes are permuted set by set.
    """
    at, out = 0, np.empty((len(sets), len(perms)), np.int64)
    ends = np.cumsum([len(x) for x in sets])
    while at < len(sets):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        x = np.concatenate(sets[at:to]).astype(np.uint64)
        starts = np.concatenate(([0], ends[at : to - 1] - done))
        if to - at > 1 and (known := _few(x)) is not None:
            table, flat = np.empty((len(known[0]), len(perms)), np.uint32), np.empty((len(perms), block), np.uint32)
            for s in range(0, len(table), block):
                here = known[0][s : s + block]
                for k, v in enumerate(permuted(here, perms)):
                    flat[k, : len(here)] = v
                for c in range(0, len(here), 256):  # turned while it is in the cache
                    table[s + c : s + min(c + 256, len(here))] = flat[:, c : min(c + 256, len(here))].T
            for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(x)], strict=True)):
                out[at + i] = np.min([table.take(known[1][c : min(c + 4096, e)], axis=0).min(axis=0) for c in range(s, e, 4096)], axis=0)
        else:
            i = 0
            while i < len(starts):
                j = max(i + 1, int(np.searchsorted(starts, starts[i] + block, "right")) - 1)
                s, e = starts[i], starts[j] if j < len(starts) else len(x)
                for k, v in enumerate(permuted(x[s:e], perms)):
                    out[at + i : at + j, k] = np.minimum.reduceat(v, starts[i:j] - s)
                i = j
        at = to
    return out


def _few(x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The distinct values and the place of each among them, if they are half as many at most."""
    values, place = np.unique(x, return_inverse=True)
    return (values, place) if 2 * len(values) <= len(x) else None


def gram_hashes(texts: list[str], n: int = 5) -> list[np.ndarray]:
    """For each text the distinct hashes below 2^60 of its word n-grams; fewer words are one shingle, none a single empty one."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inner = np.concatenate(([False], ~_SPACE[data]))
    edge = np.flatnonzero(inner[1:] != inner[:-1])
    at, to = edge[::2], edge[1::2]
    word, left, size = np.zeros(len(at), np.uint64), np.arange(len(at)), to - at
    for i in range(min(int(size.max(initial=0)), _LONG)):  # the i-th byte of every word that has one
        left = left[size[left] > i]
        h = (word[left] ^ data[at[left] + i]) * np.uint64(0x9E3779B97F4A7C15)
        word[left] = h ^ (h >> np.uint64(29))
    for w in np.flatnonzero(size > _LONG).tolist():
        word[w] = np.frombuffer(hashlib.blake2b(data[at[w] : to[w]].tobytes(), digest_size=8).digest(), np.uint64)[0]

    def mixed(k: int, begin: int, stop: int) -> np.ndarray:
        h = np.full(stop - begin, k, np.uint64)
        for i in range(k):
            h = (h ^ word[begin + i : stop + i]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
        return (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(4)

    grams = mixed(n, 0, max(0, len(word) - n + 1))
    first = np.searchsorted(at, np.cumsum([0] + [len(r) + 1 for r in raw])).tolist()
    return [np.unique(grams[a : b - n + 1]) if b - a >= n else mixed(b - a, a, a + 1) for a, b in zip(first[:-1], first[1:], strict=True)]


def char_hashes(texts: list[str], n: int = 5) -> list[np.ndarray]:
    """For each text the distinct hashes below 2^60 of its character n-grams; a shorter text is one shingle."""
    out = []
    for text in texts:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size = max(1, len(c) - n + 1)
        h = np.zeros(size, np.uint64)
        for i in range(min(n, len(c))):
            h = (h ^ c[i : i + size]) * np.uint64(0x9E3779B97F4A7C15)  # one to one in each character
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(np.unique((h ^ (h >> np.uint64(32))) >> np.uint64(4)))
    return out


def signatures(df: DataFrame, column: str, perms: list[tuple[int, int]], name: str = "sig", shingles: str = "words", n: int = 5) -> DataFrame:
    """MinHash signatures by Arrow workers: ``column``, an array of hashes below 2^60 or a text, becomes the array ``name``.

    A text is shingled by ``n`` words or by ``n`` chars; a null one is an empty one.
    """
    keep = [c for c in df.columns if c != column]
    text = df.schema[column].dataType.simpleString() == "string"
    ddl = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + f", `{name}` array<bigint>"
    hashes = {"words": gram_hashes, "chars": char_hashes}[shingles]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at, n_rows in cuts(batch.column(column)):
                    part = batch.slice(at, n_rows)
                    sets = part.column(column)
                    made = signatures_of(hashes([v or "" for v in sets.to_pylist()], n) if text else [v.values.to_numpy(zero_copy_only=False) for v in sets], perms)
                    sig = pa.ListArray.from_arrays(pa.array(np.arange(n_rows + 1) * len(perms), pa.int32()), pa.array(made.ravel()))
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], sig], names=[*keep, name])
        finally:
            trim()

    return df.mapInArrow(run, ddl)


def band_members(signatures: DataFrame, bands: int, rows: int, node: str = "doc_id", sig: str = "sig") -> DataFrame:
    """(node, bucket): each node in the buckets of its band slices."""
    cut = F.array(*[F.concat_ws("-", F.lit(i), F.slice(sig, i * rows + 1, rows).cast("array<string>")) for i in range(bands)])
    return signatures.select(F.col(node).alias("node"), F.explode(cut).alias("bucket"))


def band_edges(signatures: DataFrame, bands: int, rows: int, node: str = "doc_id", sig: str = "sig") -> DataFrame:
    """Edges (a, b) from the members of each bucket of equal band slices to its least one: linear in the bucket.

    The least members are a table: the join with it is split where a bucket is hot, which one with an aggregate of the same stage isn't.
    """
    members = band_members(signatures, bands, rows, node, sig)
    least = materialize(members.groupBy("bucket").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"), "buckets")
    return members.withColumnRenamed("node", "a").join(least, "bucket").where("a <> b").select("a", "b").distinct()


def select_survivors(labelled: DataFrame, component: str, *order: Column) -> DataFrame:
    """Adds ``kept``: the first of each component by ``order``."""
    return labelled.withColumn("kept", F.row_number().over(Window.partitionBy(component).orderBy(*order)) == 1)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
