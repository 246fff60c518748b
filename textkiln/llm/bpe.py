"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last bytes cuts every text into chunks, wherever equal passages stand in it, and a chunk
that the worker has met is not encoded again. A cut can part a word. So at each join the text from the last whole word
before it to the first one after it is encoded again, and what stands between these two is taken over if the ids at both ends are
those that the chunks have; a chunk without white space is drawn into the join. Where a join doesn't agree the library encodes the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textkiln.llm.common import slices, splitmix, text_batches, text_buffers, trimmed
from textkiln.llm.jaccard import _BYTE, _power
from textkiln.llm.words import _SPACE, Encoder, encoder

#: Bytes of the rolling window, and the mean length of a chunk.
WINDOW, MEAN = 24, 256
#: Bytes of chunks that a worker keeps; then it starts afresh.
KEEP = 16 << 20


def cuts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, mean: int = MEAN) -> np.ndarray:
    """Positions in ``data`` where a chunk ends inside a text: set by the ``window`` bytes before, on whole characters."""
    n = len(data)
    if n <= window:
        return np.zeros(0, np.int64)
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], dtype=np.uint64, out=sums[1:])
    rolled = splitmix((sums[window:n] - sums[: n - window]) * down[: n - window])
    at = np.flatnonzero(rolled % np.uint64(mean) == 0) + window
    at = at[(data[at] & 0xC0) != 0x80]
    start = offsets[np.searchsorted(offsets, at, "right") - 1]
    return at[at - start >= window]


class ChunkEncoder:
    """Encodes texts by their chunks, which it keeps as (text before the first white space, ids between, text after the last, first and
    last word between); for a chunk without white space only the first is set."""

    def __init__(self, words: Encoder):
        self.words, self.kept, self.joins, self.size, self.encoded, self.reused, self.unrepaired = words, {}, {}, 0, 0, 0, 0

    def _learn(self, fresh: list[bytes]) -> None:
        """Encodes distinct new chunks, all at once."""
        ends = np.cumsum([len(x) for x in fresh])
        starts = ends - [len(x) for x in fresh]
        data = np.frombuffer(b"".join(fresh), np.uint8)
        space = np.flatnonzero(_SPACE[data])
        lo, hi = np.searchsorted(space, starts), np.searchsorted(space, ends)
        some = np.flatnonzero(hi > lo)
        first, last = space[lo[some]] - starts[some], space[hi[some] - 1] - starts[some]
        middles = [fresh[i][a + 1 : b] for i, a, b in zip(some.tolist(), first.tolist(), last.tolist(), strict=True)]
        flat, at = self.words.encode_texts(np.frombuffer(b" ".join(middles), np.uint8), np.cumsum([0] + [len(x) + (i < len(middles) - 1) for i, x in enumerate(middles)]))
        raw, at = memoryview(flat.tobytes()), (4 * at).tolist()
        made = dict.fromkeys(fresh)
        for n, i in enumerate(some.tolist()):
            whole, middle, ids = fresh[i], middles[n], bytes(raw[at[n] : at[n + 1]])
            made[whole] = (whole[: first[n]], ids, whole[last[n] + 1 :], (middle.split(None, 1) or [b""])[0], (middle.rsplit(None, 1) or [b""])[-1])
            self.size += len(whole) + len(ids) + 500
        for whole in fresh:
            self.kept[whole] = made[whole] or (whole, None, b"", b"", b"")
            self.size += len(whole) + 200
        self.encoded += len(fresh)

    def _repair(self, windows: list[tuple[bytes, bytes, bytes]]) -> None:
        """The ids of the parted word in (last word before, parted word, first word after), None where the ids at the ends aren't theirs."""
        texts = [b" ".join(w).decode() for w in windows]
        sides = [w[i] for w in windows for i in (0, 2)]
        flat, at = self.words.encode_texts(np.frombuffer(b" ".join(sides) + b" ", np.uint8), np.cumsum([0] + [len(x) + 1 for x in sides]))
        for n, (window, found) in enumerate(zip(windows, self.words.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True)):
            ids, left, right = np.array(found.ids, np.uint32), flat[at[2 * n] : at[2 * n + 1]], flat[at[2 * n + 1] : at[2 * n + 2]]
            inner = ids[len(left) : len(ids) - len(right)]
            agree = len(inner) == len(ids) - len(left) - len(right) and (ids[: len(left)] == left).all() and (ids[len(ids) - len(right) :] == right).all()
            self.joins[window] = inner.tobytes() if agree else None

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text in ``data``."""
        if self.size > KEEP:
            self.kept, self.joins, self.size = {}, {}, 0
        raw = data.tobytes()
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))  # what can be a special token is left to the library
        whole = set((np.searchsorted(offsets, special, "right") - 1).tolist())
        bounds = np.unique(np.concatenate((offsets, cuts(data, offsets))))
        owner = (np.searchsorted(offsets, bounds[:-1], "right") - 1).tolist()
        chunks = [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        fresh = dict.fromkeys(x for x, i in zip(chunks, owner, strict=True) if x not in self.kept and i not in whole)
        self.reused += len(chunks) - len(fresh)
        if fresh:
            self._learn(list(fresh))
        plans: dict[int, list] = {}  # of each text: ids, or the windows of parted words
        at = 0
        while at < len(chunks):
            i, to = owner[at], at
            while to < len(chunks) and owner[to] == i:
                to += 1
            if i not in whole:
                plans[i] = self._plan(chunks[at:to])
            at = to
        windows = {p for plan in plans.values() for p in plan if type(p) is tuple and p not in self.joins}
        if windows:
            self._repair(list(windows))
            self.size += 300 * len(windows)
        out = []
        for i in range(len(offsets) - 1):
            if i in whole:
                out.append(self.words.whole(raw[offsets[i] : offsets[i + 1]].decode()))
                continue
            parts = [self.joins[p] if type(p) is tuple else p for p in plans.get(i, ())]
            if None in parts:
                self.unrepaired += 1
                out.append(self.words.whole(raw[offsets[i] : offsets[i + 1]].decode()))
            else:
                out.append(np.frombuffer(b"".join(parts), "<u4"))
        return out

    def _plan(self, chunks: list[bytes]) -> list:
        out, open_, before = [], b"", b""
        for x in chunks:
            head, ids, tail, one, last = self.kept[x]
            open_ += head
            if ids is None:
                continue
            if open_:
                out.append((before, open_, one))
            out.append(ids)
            open_, before = tail, last
        if open_:
            out.append((before, open_, b""))
        return out


@trimmed
def encoded(batches: Iterator[pa.RecordBatch], path: str, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches with the ids (uint32) of each row's whole text; null is empty."""
    chunks = ChunkEncoder(encoder(path, False))
    for batch in slices(batches, column, 2 << 20):
        data, off = text_buffers(batch.column(column))
        yield batch, chunks.encode(data, off - off[0])


def vocabulary(path: str) -> list[str]:
    """Token strings by id."""
    t = encoder(path, False).tokenizer
    return [t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True))]


def decode(ids: np.ndarray, pieces: list[str]) -> str:
    """As decode(ids, skip_special_tokens=False) of a tokenizer without a decoder: token strings joined by a space."""
    return " ".join([pieces[i] for i in ids.tolist()])


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and ids. A null or empty text has no ids; other columns stay (n_tokens and ids are replaced).

    A long text is encoded whole, repeated rows alike, and an empty table gives an empty one.
    """
    keep = [c for c in docs.columns if c not in ("n_tokens", "ids")]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep) + ", n_tokens long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, path, text):
            flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
            at = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(at), pa.int64()), lists], names=[*keep, "n_tokens", "ids"])

    return text_batches(docs).select(*keep).mapInArrow(run, ddl)


def decode_documents(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with the column decoded (replaced if there is one); null ids give null, none an empty text, an empty table an empty one."""
    keep = [c for c in docs.columns if c != "decoded"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            out = [None if x is None else " ".join([pieces[i] for i in x]) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*keep, "decoded"])

    return text_batches(docs).select(*keep).mapInArrow(run, ddl)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass and keeps only digests of both.

    Null and empty texts have no ids and the digests of an empty text; long texts are read whole; null and repeated keys stay as they
    are, a row each; an empty table gives an empty one. Other columns, also of these names, are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        numbers = [str(i) for i in range(len(pieces))]
        for batch, ids in encoded(batches, path, text):
            a, b = [], []
            for x in ids:
                listed = x.tolist()
                a.append(hashlib.sha256(" ".join([numbers[i] for i in listed]).encode()).hexdigest())
                b.append(hashlib.sha256(" ".join([pieces[i] for i in listed]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([len(x) for x in ids], pa.int64()), pa.array(a), pa.array(b)], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_batches(docs).select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
