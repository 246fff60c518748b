"""Exact encoding by pieces: words are encoded by the tokenizers library once and then looked up, many at a time.

Both kinds of tokenizer below split a text at ASCII white space before anything else, so the ids of a text are those
of its pieces in a row. A piece of up to 16 bytes is its own key in a hash table of two 64-bit numbers, so a lookup is
exact and needs no Python object; longer ones are keyed by their bytes. Texts with the start of a special
token, and for byte-level tokenizers also those with control characters or white space outside ASCII, go to the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np

#: Pieces kept by a worker, and the slots of their table; a full table is emptied, which changes nothing but time.
MAX_PIECES, SLOTS = 3 << 19, 1 << 21
#: Bytes looked up at a time.
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[[*range(0x09), *range(0x0E, 0x20), 0x7F]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Letters that both kinds of tokenizer keep together, that are in NFC and have lower cases of one letter.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įıĴ-ɏ]+")
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_EMPTY = np.zeros(0, np.uint32)


@lru_cache
def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: printable ones themselves, others from U+0100 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def marks_at(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Where the ASCII marks that end a word begin, if a plain letter stands before them: there all these tokenizers part; else its end."""
    cut, left = to.copy(), np.flatnonzero(_MARK[data[to - 1]])
    while len(left):
        cut[left] -= 1
        left = left[cut[left] > at[left]]
        left = left[_MARK[data[cut[left] - 1]]]
    some = np.flatnonzero(cut < to)
    inside = some[cut[some] > at[some]]
    last, second = data[cut[inside] - 1], data[np.maximum(cut[inside] - 2, 0)]
    two = (cut[inside] - at[inside] >= 2) & (last >= 0x80)
    latin = ((second == 0xC3) & (last != 0x97) & (last != 0xB7)) | ((second == 0xC4) & (last != 0xB0) & (last != 0xB2) & (last != 0xB3)) | ((second >= 0xC5) & (second <= 0xC8))
    ok = _LETTER[last] | (two & latin)
    keep = np.zeros(len(at), bool)
    keep[inside[ok]] = True
    return np.where(keep, cut, to)


def pieces(data: np.ndarray, offsets: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all texts in ``data``, in order.

    Pieces are words, without the marks that end them, and these marks; where ``spaced``, a space belongs to the word after it, and the rest of the white space between two words is a
    piece, or two where no space ends it: what comes before the last character, and that character. White space that ends a text is one piece.
    """
    n = len(data)
    inner = ~_SPACE[data]
    new = np.zeros(n + 1, bool)
    new[offsets] = True
    starts, ends = inner.copy(), inner.copy()
    starts[1:] &= ~inner[:-1] | new[1:n]
    ends[:-1] &= ~inner[1:] | new[1:n]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    cut = marks_at(data, at, to)
    if not spaced:
        begin, end = np.stack((at, cut), 1).ravel(), np.stack((cut, to), 1).ravel()
        keep = end > begin
        return begin[keep], end[keep]
    text = np.searchsorted(offsets, at, "right") - 1
    before = offsets[text]  # where the gap before a word begins
    same = np.flatnonzero(text[1:] == text[:-1]) + 1
    before[same] = to[same - 1]
    lead = (at > before) & (data[np.maximum(at - 1, 0)] == 0x20)
    word = at - lead
    last = np.where((word > before) & ~lead, word - 1, word)
    gap = np.flatnonzero(offsets[1:] > offsets[:-1])
    tail = offsets[:-1].copy()
    tail[text] = to  # of the words of a text the last one stays
    tail, stop = tail[gap], offsets[1:][gap]
    begin = np.concatenate((np.stack((before, last, word, cut), 1).ravel(), tail))
    end = np.concatenate((np.stack((last, word, cut, to), 1).ravel(), stop))
    keep = end > begin
    begin, end = begin[keep], end[keep]
    order = np.argsort(begin, kind="stable")
    return begin[order], end[order]


class Encoder:
    """spaced: byte-level BPE, where white space has tokens; else white space is dropped."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self._clear()

    def _clear(self) -> None:
        self.entry = np.full(SLOTS, -1, np.int32)
        self.first, self.second = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)  # the key of each entry
        self.long: dict[bytes, int] = {}
        self.count, self.used = 0, 0
        self.start, self.pool = np.zeros((1 << 16) + 1, np.uint32), np.zeros(1 << 18, np.uint16 if self.small else np.uint32)  # ids of entry i: pool[start[i]:start[i + 1]]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_texts(raw, np.array([0, len(raw)]))[0]

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in ``data`` (UTF-8) in a row, and where each text's ids start."""
        offsets = np.asarray(offsets, np.int64) - offsets[0]
        out, counts, at = [], np.zeros(len(offsets) - 1, np.int64), 0
        while at < len(counts):
            to = min(len(counts), max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1))
            ids, n = self._block(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            out.append(ids)
            counts[at:to] = n
            at = to
        return np.concatenate(out) if out else _EMPTY, np.concatenate(([0], np.cumsum(counts)))

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odd = self._odd(data, offsets)
        if len(odd):
            ids, counts, at = [], [], 0
            for i in [*odd.tolist(), len(offsets) - 1]:
                if i > at:
                    part, n = self._plain(data[offsets[at] : offsets[i]], offsets[at : i + 1] - offsets[at])
                    ids.append(part)
                    counts.append(n)
                if i < len(offsets) - 1:
                    ids.append(self.whole(data[offsets[i] : offsets[i + 1]].tobytes().decode()))
                    counts.append(np.array([len(ids[-1])]))
                at = i + 1
            return np.concatenate(ids), np.concatenate(counts)
        return self._plain(data, offsets)

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts for the library; what lies across the border of two texts may name one too many."""
        bad = [np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))]
        if not self.spaced:
            bad.append(np.flatnonzero(data == 0))
        else:
            bad.append(np.flatnonzero(_CONTROL[data]))
            padded = np.concatenate((data, np.zeros(2, np.uint8)))
            for lead, test in (
                (0xC2, lambda b, c: b <= 0xA0), (0xE1, lambda b, c: ((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E))),
                (0xE2, lambda b, c: ((b == 0x80) & ((c <= 0x8F) | (c >= 0xA8))) | ((b == 0x81) & (c >= 0x9F))), (0xE3, lambda b, c: (b == 0x80) & (c == 0x80)), (0xEF, lambda b, c: (b == 0xBB) & (c == 0xBF)),
            ):
                at = np.flatnonzero(data == lead)
                bad.append(at[test(padded[at + 1], padded[at + 2])])
        bad = np.concatenate(bad)
        return np.unique(np.searchsorted(offsets, bad, "right") - 1) if len(bad) else bad

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = pieces(data, offsets, self.spaced)
        found = self.lookup(data, begin, end)
        ids, size = self.ids_of(found)
        at = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(begin, offsets)]
        return ids, np.diff(at)

    def ids_of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of entries in a row, and how many each has."""
        start = self.start[entries].astype(np.int64)
        size = self.start[entries + 1] - start
        to = np.cumsum(size)
        return self.pool[np.repeat(start - to + size, size) + np.arange(int(to[-1]) if len(to) else 0)].astype(np.uint32), size

    def lookup(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each piece; new pieces are encoded. Pieces hold no zero byte."""
        if self.count + len(begin) > MAX_PIECES:
            self._clear()
        size = end - begin
        raw = np.concatenate((data, np.zeros(16, np.uint8)))
        words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
        first = words[begin] & _MASK[np.minimum(size, 8)]
        second = np.zeros(len(begin), np.uint64)
        wide = np.flatnonzero(size > 8)
        second[wide] = words[begin[wide] + 8] & _MASK[np.minimum(size[wide] - 8, 8)]
        out = np.full(len(begin), -1, np.int32)
        short, long = np.flatnonzero(size <= 16), np.flatnonzero(size > 16)
        slot = ((first[short] * np.uint64(0x9E3779B97F4A7C15)) ^ (second[short] * np.uint64(0xBF58476D1CE4E5B9))) * np.uint64(0x94D049BB133111EB)
        slot = (slot >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        open_, slot = self._probe(first, second, short, slot, out)
        if len(open_):
            key = np.stack((first[open_], second[open_]), 1)
            kinds, one, back = np.unique(key.view("V16").ravel(), return_index=True, return_inverse=True)
            made = self._encode(data, begin[open_[one]], end[open_[one]])
            self._insert(kinds.view(np.uint64).reshape(-1, 2), slot[one], made)
            out[open_] = made[back]
        if len(long):
            names = [data[a:b].tobytes() for a, b in zip(begin[long].tolist(), end[long].tolist(), strict=True)]
            fresh = {name: i for i, name in enumerate(names) if name not in self.long}
            if fresh:
                at = long[list(fresh.values())]
                self.long.update(zip(fresh, self._encode(data, begin[at], end[at]).tolist(), strict=True))
            out[long] = [self.long[name] for name in names]
        return out

    def _probe(self, first: np.ndarray, second: np.ndarray, open_: np.ndarray, slot: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fills ``out`` for pieces in the table; gives the others and the free slot that each came to."""
        missing, free = [], []
        while len(open_):
            entry = self.entry[slot]
            empty = entry < 0
            hit = ~empty & (self.first[entry] == first[open_]) & (self.second[entry] == second[open_])
            out[open_[hit]] = entry[hit]
            missing.append(open_[empty])
            free.append(slot[empty])
            on = ~(hit | empty)
            open_, slot = open_[on], (slot[on] + 1) & (SLOTS - 1)
        return (np.concatenate(missing), np.concatenate(free)) if missing else (open_, slot)

    def _insert(self, keys: np.ndarray, slot: np.ndarray, entries: np.ndarray) -> None:
        self.first[entries], self.second[entries] = keys[:, 0], keys[:, 1]
        left = np.arange(len(keys))
        while len(left):
            at = slot[left]
            _, one = np.unique(at, return_index=True)
            one = one[self.entry[at[one]] < 0]
            self.entry[at[one]] = entries[left[one]]
            stay = np.ones(len(left), bool)
            stay[one] = False
            left = left[stay]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)

    def _encode(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """New entries for distinct pieces, encoded one by one: plain letters are one piece for the model, others go through all steps."""
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        letters, tokenize, plain, spaced = dict(enumerate(byte_letters())), self.tokenizer.model.tokenize, _LETTERS.fullmatch, self.spaced
        ids, others = [], []
        for i, text in enumerate(texts):
            if plain(text, text[0] == " "):
                piece = (text if spaced else text.lower()).encode().decode("latin-1").translate(letters)  # bytes as characters
                ids.append([t.id for t in tokenize(piece)])
            else:
                ids.append(None)
                others.append(i)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False), strict=True):
            ids[i] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        n, m = self.count + len(ids) + 1, self.used + len(flat)
        for name, need in (("start", n), ("first", n), ("second", n), ("pool", m)):
            held = getattr(self, name)
            if need > len(held):
                setattr(self, name, np.concatenate((held, np.zeros(max(need - len(held), len(held) // 2), held.dtype))))
        self.pool[self.used : m] = flat
        self.start[self.count + 1 : n] = self.used + np.cumsum(size)
        made = np.arange(self.count, n - 1, dtype=np.int32)
        self.count, self.used = n - 1, m
        return made


@lru_cache(2)
def encoder(path: str, spaced: bool) -> Encoder:
    """One per worker process, so pieces are shared by all its tasks."""
    return Encoder(path, spaced)
