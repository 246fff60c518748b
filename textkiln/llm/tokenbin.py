"""Token-id files compressed by a Re-Pair grammar.

Each shard's ids are shortened by replacing frequent pairs of neighbouring symbols by new symbols, again and
again, until no pair occurs LEAST times; pairs never reach across documents. A file holds the rules, the length each symbol
expands to, and where each document's symbols start, so one document is decoded without the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.common import batch_of, slices, text_batches, text_buffers, trimmed
from textkiln.llm.files import atomic_writer, attempt_name, deal, reader
from textkiln.llm.words import encoder
from textkiln.operators.storage import materialize

MAGIC = b"TKRP0002"
#: A pair of fewer occurrences gets no rule: a rule takes 12 bytes, and each use saves one symbol of about 18 bits.
LEAST = 16
#: Ids in a file, about.
FILE_IDS = 4_000_000
#: Bits of the table that tells which pairs can be frequent; they are counted exactly afterwards.
_BITS = 18
#: The goal falls by this factor from round to round.
STEP = 4


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - _BITS)


def _closed(x: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Of pairs (at, to) of equal symbols, in order, every second of a run: it overlaps the one before."""
    twin = np.flatnonzero(x[at] == x[to])
    begins = np.ones(len(twin), bool)
    begins[1:] = at[twin[1:]] != to[twin[:-1]]
    index = np.arange(len(twin))
    return twin[((index - np.maximum.accumulate(np.where(begins, index, 0))) & 1) == 1]


def _choose(at: np.ndarray, to: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Indexes of occurrences (at, to), in order, that stay: of two that overlap the one of the better pair."""
    kept, index = [], np.arange(len(at))
    while len(index):
        near = at[index[1:]] == to[index[:-1]]
        r = rank[index]
        wins = np.ones(len(index), bool)
        wins[:-1] &= ~near | (r[:-1] <= r[1:])
        wins[1:] &= ~near | (r[1:] < r[:-1])
        kept.append(index[wins])
        gone = wins.copy()
        gone[1:] |= wins[:-1] & near
        gone[:-1] |= wins[1:] & near
        index = index[~gone]
    return np.concatenate(kept) if kept else index


def _replace(x: np.ndarray, at: np.ndarray, to: np.ndarray, goal: int, floor: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gives the pairs among the candidates (at, to), in order, that occur ``goal`` times new symbols from ``first`` on, the most frequent first.

    Returns the rules, the indexes of the candidates replaced (their symbols are set) and those of candidates of frequent pairs that were not.
    A pair that overlaps leave fewer than ``floor`` occurrences waits.
    """
    none = np.zeros(0, np.int64)
    keys = x[at].astype(np.uint64) << np.uint64(32) | x[to]
    found = np.sort(keys)
    edge = np.flatnonzero(np.concatenate((np.ones(min(len(found), 1), bool), found[1:] != found[:-1])))
    size = np.diff(np.concatenate((edge, [len(found)])))
    pairs, size = found[edge[size >= goal]], size[size >= goal]
    if not len(pairs):
        return np.zeros((0, 2), np.uint32), none, none
    rank = np.empty(len(pairs), np.int64)
    rank[np.argsort(-size, kind="stable")] = np.arange(len(pairs))
    if len(keys) < 1 << 16:
        which = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
    else:  # by a table of slots, and where several pairs have one slot by search
        slot = lambda k: ((k >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) ^ k * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(46)
        home, place, shared = slot(pairs), np.full(1 << 18, -1, np.int32), np.zeros(1 << 18, bool)
        place[home] = np.arange(len(pairs))
        shared[home[place[home] != np.arange(len(pairs))]] = True
        at_slot = slot(keys)
        which = place[at_slot]
        search = np.flatnonzero(shared[at_slot])
        which[search] = np.minimum(np.searchsorted(pairs, keys[search]), len(pairs) - 1)
    hit = np.flatnonzero(which >= 0)
    hit = hit[pairs[which[hit]] == keys[hit]]
    order = rank[which[hit]]
    win = _choose(at[hit], to[hit], order)
    used = np.bincount(order[win], minlength=len(pairs)) >= floor
    win = win[used[order[win]]]
    new = np.cumsum(used) - 1
    x[at[hit[win]]] = (first + new[order[win]]).astype(np.uint32)
    lost = np.ones(len(hit), bool)
    lost[win] = False
    chosen = np.empty(len(pairs), np.uint64)
    chosen[rank] = pairs
    chosen = chosen[used]
    return np.stack([(chosen >> np.uint64(32)).astype(np.uint32), chosen.astype(np.uint32)], 1), hit[win], hit[lost]


def build_grammar(x: np.ndarray, last: np.ndarray, first: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last flags, rules [n, 2]) of ids ``x``; ``last`` marks the last id of each document.

    A round counts pairs exactly and replaces those of at least ``goal`` occurrences, the more frequent one first where two overlap. The goal
    falls with the rounds to ``least``. There only pairs beside the last replacements, or that lost to an overlap, can be left,
    and rounds go on over these until no pair within a document occurs ``least`` times.
    """
    x, last, rules, made, goal = x.astype(np.uint32), last.copy(), [np.zeros((0, 2), np.uint32)], first, 0
    while len(x) > 1 and goal != least:
        slot = _slots(x[:-1], x[1:])
        count = np.bincount(slot, minlength=1 << _BITS)
        top = int(count.max())
        goal = max(least, min(top, goal or top) // STEP)
        hot = (count >= goal)[slot]
        hot[np.flatnonzero(last[:-1])] = False
        at = np.flatnonzero(hot)
        at = np.delete(at, _closed(x, at, at + 1))
        fresh, done, lost = _replace(x, at, at + 1, goal, max(least, goal // STEP), made)
        made += len(fresh)
        rules.append(fresh)
        if goal != least and len(done):
            done = at[done]
            last[done] = last[done + 1]
            keep = np.ones(len(x), bool)
            keep[done + 1] = False
            x, last = x[keep], last[keep]
    if len(x) > 1:  # at the last goal symbols stay in place, linked to the next and the one before
        after, before, alive = np.arange(1, len(x) + 1, dtype=np.int32), np.arange(-1, len(x) - 1, dtype=np.int32), np.ones(len(x), bool)
        to, near = at + 1, np.zeros(len(x) + 1, bool)
        while len(done):
            places, gone, lost = at[done], to[done], at[lost]
            last[places], alive[gone] = last[gone], False
            after[places] = after[gone]
            tail = after[gone] < len(x)
            before[after[gone][tail]] = places[tail]
            for spots in (places, before[places], after[places], lost, before[lost]):  # -1 and len(x), outside, are the mark's last place
                near[spots] = True
            near[-1] = False
            at = np.flatnonzero(near)
            near[at] = False
            at = at[alive[at] & ~last[at]]
            to = after[at]
            keep = np.ones(len(at), bool)
            keep[_closed(x, at, to)] = False
            at, to = at[keep], to[keep]
            fresh, done, lost = _replace(x, at, to, least, least, made)
            made += len(fresh)
            rules.append(fresh)
        x, last = x[alive], last[alive]
    return x, last, np.concatenate(rules)


class Grammar:
    """Expansions of all symbols from the rules; a rule names symbols before it only."""

    def __init__(self, rules: np.ndarray, first: int):
        self.first = first
        highest = np.maximum.accumulate(rules.max(1)) if len(rules) else np.zeros(0, np.int64)
        self.length, self.start, self.flat = np.ones(first, np.int64), np.arange(first), np.arange(first, dtype=np.uint32)
        at = 0
        while at < len(rules):  # the rules up to the first one that names one of these
            to = int(np.searchsorted(highest, first + at))
            size = self.length[rules[at:to].astype(np.int64)].sum(1)
            flat = self.expand(rules[at:to].ravel())
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
            self.length, self.flat = np.concatenate((self.length, size)), np.concatenate((self.flat, flat))
            at = to

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        size = self.length[symbols]
        to = np.cumsum(size)
        return self.flat[np.repeat(self.start[symbols] - to + size, size) + np.arange(int(to[-1]) if len(to) else 0)]


def lengths_of(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule expands to."""
    out = np.ones(first + len(rules), np.int64)
    highest, at = np.maximum.accumulate(rules.max(1)) if len(rules) else np.zeros(0, np.int64), 0
    while at < len(rules):
        to = int(np.searchsorted(highest, first + at))
        out[first + at : first + to] = out[rules[at:to].astype(np.int64)].sum(1)
        at = to
    return out[first:]


def pack_symbols(x: np.ndarray, symbols: int) -> tuple[int, bytes]:
    """(bits, bytes): the low 16 bits of all symbols, then what is above them in 0, 1, 2, 4, 8 or 16 bits each."""
    bits = next(b for b in (0, 1, 2, 4, 8, 16) if symbols <= 1 << 16 + b)
    low, high = x.astype("<u2").tobytes(), x >> np.uint32(16)
    if bits in (1, 2, 4):
        high = np.concatenate((high, np.zeros(-len(x) % (8 // bits), np.uint32))).astype(np.uint8).reshape(-1, 8 // bits)
        return bits, low + np.bitwise_or.reduce(high << (np.arange(8 // bits, dtype=np.uint8) * np.uint8(bits)), axis=1).tobytes()
    return bits, low + (high.astype("<u1" if bits == 8 else "<u2").tobytes() if bits else b"")


def unpack_symbols(raw: bytes, at: int, n: int, bits: int) -> np.ndarray:
    low = np.frombuffer(raw, "<u2", n, at).astype(np.uint32)
    at += 2 * n
    if bits in (1, 2, 4):
        packed = np.frombuffer(raw, np.uint8, -(-n * bits // 8), at)
        high = (packed[:, None] >> (np.arange(8 // bits, dtype=np.uint8) * np.uint8(bits)) & np.uint8((1 << bits) - 1)).ravel()[:n]
    elif bits:
        high = np.frombuffer(raw, "<u1" if bits == 8 else "<u2", n, at)
    else:
        return low
    return low | high.astype(np.uint32) << np.uint32(16)


def pack(x: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, first: int, nulls: int = 0, least: int = LEAST) -> bytes:
    """One file of documents whose ids stand in ``x`` in a row. Ids are below ``first``; rule i makes the symbol first + i. The first
    ``nulls`` documents have no id of their own."""
    last = np.zeros(len(x), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    x, last, rules = build_grammar(x, last, first, least)
    filled = np.zeros(len(sizes), np.int64)
    filled[sizes > 0] = np.diff(np.concatenate(([-1], np.flatnonzero(last))))
    lengths = lengths_of(rules, first)
    bits, symbols = pack_symbols(x, first + len(rules))
    head = np.array([len(sizes), len(rules), len(x), first, bits, nulls], "<u8")
    return b"".join([MAGIC, head.tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), np.asarray(doc_ids, "<i8").tobytes(), np.concatenate(([0], np.cumsum(filled))).astype("<u8").tobytes(), sizes.astype("<u8").tobytes(), symbols])


class TokenFile:
    """Reads a packed file: doc_ids (of the first ``nulls`` documents: none), sizes, and the ids of any documents by position."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        docs, rules, n, first, bits, self.nulls = np.frombuffer(raw, "<u8", 6, 8).tolist()
        at = 56
        self.rules = np.frombuffer(raw, "<u4", 2 * rules, at).reshape(-1, 2)
        self.lengths = np.frombuffer(raw, "<u4", rules, at := at + 8 * rules)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at := at + 4 * rules)
        self.starts = np.frombuffer(raw, "<u8", docs + 1, at := at + 8 * docs).astype(np.int64)
        self.sizes = np.frombuffer(raw, "<u8", docs, at := at + 8 * (docs + 1)).astype(np.int64)
        self.symbols = unpack_symbols(raw, at + 8 * docs, n, bits)
        self.grammar = Grammar(self.rules, first)

    def ids(self, i: int, to: int | None = None) -> np.ndarray:
        """Ids of document i, or of the documents from i up to ``to`` in a row."""
        return self.grammar.expand(self.symbols[self.starts[i] : self.starts[i + 1 if to is None else to]])


FILES = pa.schema([("partition", pa.int64()), ("file", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("bytes", pa.int64())])


def write_token_files(docs: DataFrame, path: str, folder: str, *, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """Encode whole texts with the byte-level tokenizer at ``path``, end each by ``end_id``, and write files in ascending key order.

    Returns one row per file: partition, file, path, n_docs, n_ids, bytes; (partition, file) is the order. Null
    and empty texts hold only the end id; rows of a null key come first; rows of one key are ordered, and dealt over tasks, by a hash of
    their texts. A very long text is one document of a file of its own size at least. An empty table gives no file. Other
    columns, whatever their names, are not read.
    """
    ordered = text_batches(docs).select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.col(text).cast("string").alias("text")).repartitionByRange("k", "h").sortWithinPartitions("k", "h").select("k", "text")

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(path, True), TaskContext.get().partitionId()
        first = words.tokenizer.get_vocab_size(with_added_tokens=True)
        ids, sizes, keys, held, file = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            k = pa.concat_arrays(keys)
            raw = pack(np.concatenate(ids), np.concatenate(sizes), k.fill_null(0).to_numpy(), first, k.null_count)
            name = attempt_name("ids", file, ".tkrp")
            with atomic_writer(folder, name) as out:
                out.write(raw)
            return batch_of(FILES, [[part], [file], [f"{folder}/{name}"], [len(k)], [held], [len(raw)]])

        for batch in slices(batches, "text", 4 << 20):
            data, off = text_buffers(batch.column("text"))
            flat, at = words.encode_texts(data, off)
            ids.append(np.insert(flat, at[1:], np.uint32(end_id)))
            sizes.append(np.diff(at) + 1)
            keys.append(batch.column("k"))
            held += len(ids[-1])
            if held >= FILE_IDS:
                yield flush()
                ids, sizes, keys, held, file = [], [], [], 0, file + 1
        if held:
            yield flush()

    return materialize(ordered.mapInArrow(run, "partition long, file long, path string, n_docs long, n_ids long, bytes long"), "token-files")


def read_token_files(files: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32[, ids]) of the files of write_token_files: one task reads a file at a time.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over little-endian uint32 ids. An empty list of files gives no rows.
    """
    before = F.sum("n_ids").over(Window.orderBy("partition", "file")) - F.col("n_ids")  # one row per file
    listed = deal(materialize(files.withColumn("start", before).select("path", "start"), "token-starts"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with reader(path) as stream:
                    f = TokenFile(stream.read())
                a = 0
                while a < len(f.doc_ids):
                    to = max(a + 1, int(np.searchsorted(f.starts, f.starts[a] + (1 << 17), "right")) - 1)
                    ids, n = f.ids(a, to), f.sizes[a:to]
                    at = np.concatenate(([0], np.cumsum(n)))
                    raw = memoryview(ids.astype("<u4")).cast("B")
                    crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    keys = pa.array(f.doc_ids[a:to], mask=np.arange(a, to) < f.nulls)
                    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))] * with_ids
                    yield batch_of(schema, [keys, pa.array(start + at[:-1]), pa.array(n), pa.array(crc, pa.int64()), *lists])
                    start, a = start + int(at[-1]), to

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
