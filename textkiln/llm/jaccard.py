"""Jaccard similarity join of word n-gram sets by prefix trees.

Sets are hashed n-grams in one global order. Two sets of at least ``percent`` % similarity differ in at most
``D = size * (100 - percent) / percent`` n-grams, so of ``D + 1 + spare`` ranges of hash values at least
``1 + spare`` hold the same n-grams in both. Documents that agree with others in too few ranges have no
partner and leave. Of the others' signatures those that the most sets have go, one fewer than must agree: two
sets that link still share one that is left (the prefix filter), so common passages don't tie all documents into
one group. The rest form candidate groups. In each, prefix trees over the sets find the pairs:
a node's n-grams are matched once for all sets below it, and a subtree ends where its remaining length
can't reach the overlap that is needed. The result is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textkiln.llm.common import GOLDEN, batch_of, slices, splitmix, text_batches, text_buffers, trimmed
from textkiln.operators.graph import components
from textkiln.operators.storage import materialize, release

#: Growth from one class of set sizes to the next.
RATIO = 1.25
#: Sets and n-grams of a group that one task holds of each side.
PART_SETS, PART_GRAMS = 512, 400_000
#: Bits that tell which texts are candidates: a broadcast of a 64th of them in rows at most.
FILTER_BITS = 1 << 24
#: Sets that share a node with another one and are renamed in one go; with more of them the rest follows in the next.
MOST_SALTED = 100_000

_rng = np.random.default_rng(20240607)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = int(_rng.integers(0, 1 << 63)) * 8 + 5
_GRAM = _rng.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least n of them."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE & (1 << 64) - 1), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in ``data`` (UTF-8), and where each text's words start. A-Z equal a-z."""
    offsets = offsets - offsets[0]
    n = len(data)
    inner = ~_SPACE[data]
    new = np.zeros(n + 1, bool)
    new[offsets] = True
    starts = inner.copy()
    starts[1:] &= ~inner[:-1] | new[1:n]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:] | new[1:n]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], dtype=np.uint64, out=sums[1:])
    hashed = splitmix((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64) * GOLDEN)
    return hashed, np.searchsorted(at, offsets)


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct n-gram hashes; a text of fewer words is one n-gram, one of none is empty."""
    words, first = word_hashes(data, offsets)
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        grams += words[i : i + len(grams)] * _GRAM[i]
    grams = splitmix(grams)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield splitmix((words[a:b] * _GRAM[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.full(1, b - a, np.uint64) * GOLDEN)
        else:
            yield words[:0]


def node_of(grams: np.ndarray, salted: frozenset = frozenset()) -> tuple[int, int]:
    """Identity of a set, signed 64 bits, and 64 bits more by which two sets of one identity are told apart; those in ``salted`` swap the two."""
    raw = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    node, check = int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)
    return (check, node) if node in salted else (node, check)


def _classes(percent: int, largest: int = 1 << 40) -> np.ndarray:
    out = [8]
    while out[-1] < largest:
        out.append(int(out[-1] * RATIO) + 1)
    return np.array(out)


def _signatures(grams: np.ndarray, percent: int, tops: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(class, ranges that must agree, signatures) for each size class in which a partner can be the smaller set or this one is."""
    n = len(grams)
    mixed = np.zeros(n + 1, np.uint64)
    np.cumsum(splitmix(grams), dtype=np.uint64, out=mixed[1:])
    high = grams >> np.uint64(32)
    for k in range(int(np.searchsorted(tops, -(-percent * n // 100))), int(np.searchsorted(tops, n)) + 1):
        differ = int(tops[k]) * (100 - percent) // percent
        spare = 3 + differ // 2
        ranges = differ + 1 + spare
        edges = ((np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) + np.uint64(ranges - 1)) // np.uint64(ranges)
        bounds = np.searchsorted(high, edges)
        filled = np.flatnonzero(np.diff(bounds))
        empty = ranges - len(filled)
        need = 1 + spare - empty
        if need < 1:  # the ranges that agree may all be empty: these count too
            filled, need = np.arange(ranges), 1
        yield k, need, splitmix((mixed[bounds[filled + 1]] - mixed[bounds[filled]]) + (filled + 1).astype(np.uint64) * GOLDEN + splitmix(np.full(1, k, np.uint64)))


FACTS = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("n_grams", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("blob", pa.binary())])
FACTS_DDL = "part int, doc_id long, n_grams long, node long, check long, blob binary"
HITS = pa.schema([("doc_id", pa.int64()), ("n_grams", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("sig", pa.int64()), ("class", pa.int32()), ("need", pa.int32()), ("holders", pa.int32())])
HITS_DDL = "doc_id long, n_grams long, node long, check long, sig long, class int, need int, holders int"


def packed(node: np.ndarray, kind: np.ndarray, need: np.ndarray, own: np.ndarray, sigs: np.ndarray) -> bytes:
    """A blob of signatures without their 16 high bits, which the part tells; own: the place of each one's set in node, kind and need, ascending, none left out.

    The numbers of sets and signatures; nodes, classes, the need byte by byte; a bit for each signature that begins a set; low and high parts. Of a
    large table hardly two signatures of a set meet in a blob, so what is held of a set is most of it.
    """
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    return b"".join((
        np.array([len(node), len(sigs)], "<u4").tobytes(), node.astype("<i8").tobytes(), kind.astype("u1").tobytes(), need.astype("<i4").view("u1").reshape(-1, 4).T.tobytes(),
        np.packbits(new).tobytes(), (sigs & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), ((sigs >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes(),
    ))


def unpacked(blob: pa.Buffer | bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What was given to ``packed``; signatures without their 16 high bits."""
    view = memoryview(blob)
    n, m = np.frombuffer(view, "<u4", 2).tolist()
    ends = np.cumsum([8, 8 * n, n, 4 * n, -(-m // 8), 4 * m]).tolist()
    need = np.ascontiguousarray(np.frombuffer(view, "u1", 4 * n, ends[2]).reshape(4, n).T).view("<i4").ravel()
    own = np.cumsum(np.unpackbits(np.frombuffer(view, "u1", -(-m // 8), ends[3]), count=m), dtype=np.uint32) - np.uint32(1)
    sigs = np.frombuffer(view, "<u4", m, ends[4]).astype(np.uint64) | np.frombuffer(view, "<u2", m, ends[5]).astype(np.uint64) << np.uint64(32)
    return np.frombuffer(view, "<i8", n, ends[0]), np.frombuffer(view, "u1", n, ends[1]), need, own, sigs


@trimmed
def _sign(batches: Iterator[pa.RecordBatch], n: int, percent: int, parts: int, salted: frozenset, flush: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Documents to a row each, and to blobs of signatures for each part. Equal sets of one task sign once."""
    tops, seen, entries, sigs, owner, held = _classes(percent), set(), [], [], [], 0

    def blobs() -> pa.RecordBatch:
        node, kind, need = (np.array(c, np.int64) for c in zip(*entries, strict=True))
        s, own = np.concatenate(sigs), np.repeat(np.arange(len(owner), dtype=np.uint32), owner)
        part = ((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        s, own, part = s[order], own[order], part[order]
        cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            used = np.unique(own[a:b])
            out.append(packed(node[used], kind[used], need[used], own[a:b], s[a:b]))
        none = pa.nulls(len(out), pa.int64())
        return batch_of(FACTS, [pa.array(part[cuts[:-1]], pa.int32()), none, none, none, none, pa.array(out, pa.binary())])

    for batch in slices(batches, "text", 1 << 19):
        data, off = text_buffers(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        sizes, nodes, checks = [], [], []
        for doc_id, grams in zip(ids, gram_sets(data, off, n), strict=True):
            node, check = node_of(grams, salted) if len(grams) else (None, None)
            sizes.append(len(grams))
            nodes.append(node)
            checks.append(check)
            if node is None or doc_id is None or node in seen:
                continue
            seen.add(node)
            for k, need, s in _signatures(grams, percent, tops):
                entries.append((node, k, need))
                sigs.append(s)
                owner.append(len(s))
                held += len(s)
        yield batch_of(FACTS, [pa.array([hash((i, m)) % parts for i, m in zip(ids, sizes, strict=True)], pa.int32()), batch.column("doc_id"), sizes, nodes, checks, pa.nulls(len(ids), pa.binary())])
        if held >= flush:
            yield blobs()
            entries, sigs, owner, held = [], [], [], 0
    if held:
        yield blobs()


@trimmed
def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part: passes the document rows on, and gives every set's signatures that another set has too. It holds one part at a time."""
    blobs, current = [], None
    for batch in batches:
        docs = batch.filter(batch.column("blob").is_null())
        if docs.num_rows:
            none, small = pa.nulls(docs.num_rows, pa.int64()), pa.nulls(docs.num_rows, pa.int32())
            yield batch_of(HITS, [*[docs.column(c) for c in ("doc_id", "n_grams", "node", "check")], none, small, small, small])
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
            if not blob.is_valid:
                continue
            if part != current:
                yield from _matches(current, blobs)
                blobs, current = [], part
            blobs.append(blob.as_buffer())
    yield from _matches(current, blobs)


def _matches(part: int, blobs: list) -> Iterator[pa.RecordBatch]:
    nodes, kinds, needs, owners, sigs, seen = [], [], [], [], [], 0
    for blob in blobs:
        node, kind, need, own, s = unpacked(blob)
        for held, more in zip((nodes, kinds, needs, owners, sigs), (node, kind, need, own + np.uint32(seen), s | np.uint64(part & 0xFFFF) << np.uint64(48)), strict=True):
            held.append(more)
        seen += len(node)
    if not sigs:
        return
    nodes, kinds, needs, own, s = (np.concatenate(x) for x in (nodes, kinds, needs, owners, sigs))
    del owners, sigs
    order = np.argsort(s, kind="stable")
    s, own = s[order], own[order]
    same = s[1:] == s[:-1]
    some = np.zeros(len(s), bool)
    some[1:] |= same
    some[:-1] |= same
    s, own = s[some], own[some]
    node = nodes[own]
    order = np.lexsort((node, s))
    s, own, node = s[order], own[order], node[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (node[1:] != node[:-1])
    s, own, node = s[first], own[first], node[first]
    same = s[1:] == s[:-1]
    some = np.zeros(len(s), bool)
    some[1:] |= same
    some[:-1] |= same
    s, own, node = s[some].view(np.int64), own[some], node[some]
    cuts = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), s[1:] != s[:-1], [True])))
    holders = np.repeat(np.diff(cuts), np.diff(cuts)).astype(np.int32)
    for a in range(0, len(s), 1 << 16):
        b = min(len(s), a + (1 << 16))
        none = pa.nulls(b - a, pa.int64())
        yield batch_of(HITS, [none, none, pa.array(node[a:b]), none, pa.array(s[a:b]), pa.array(kinds[own[a:b]], pa.int32()), pa.array(needs[own[a:b]]), pa.array(holders[a:b])])


class PrefixTree:
    """A compressed trie over ordered sets, laid out level by level for traversal with arrays."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        """sets: increasing token ranks; sizes: of the whole sets, tokens that can't match included."""
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        parent, begin, owner, ends = [-1], [0], [0], [[]]  # node: the tokens from begin to its end in the set owner
        stop, stack = [0], [0]
        for at, i in enumerate(order):
            s = sets[i]
            common = 0
            if at:
                other = sets[order[at - 1]]
                m = min(len(s), len(other))
                differ = np.flatnonzero(s[:m] != other[:m])
                common = int(differ[0]) if len(differ) else m
            while stop[stack[-1]] > common:
                node = stack.pop()
                if stop[stack[-1]] < common:  # split: an inner node for the part in common
                    parent.append(stack[-1]), begin.append(begin[node]), owner.append(owner[node]), ends.append([]), stop.append(common)
                    parent[node], begin[node] = len(parent) - 1, common
                    stack.append(len(parent) - 1)
            if len(s) > common:
                parent.append(stack[-1]), begin.append(common), owner.append(i), ends.append([]), stop.append(len(s))
                stack.append(len(parent) - 1)
            ends[stack[-1]].append(i)
        n = len(parent)
        depth, kids = np.zeros(n, np.int64), [[] for _ in range(n)]
        for x in range(1, n):
            kids[parent[x]].append(x)
        walk = [0]
        for x in walk:
            for y in kids[x]:
                depth[y] = depth[x] + 1
                walk.append(y)
        # walk is level order; the longest rest and the smallest whole size below each node bound what a subtree can reach
        rest, least = np.zeros(n, np.int64), np.full(n, 1 << 60)
        for x in reversed(walk):
            for i in ends[x]:
                least[x] = min(least[x], sizes[i])
            for y in kids[x]:
                rest[x] = max(rest[x], rest[y] + stop[y] - begin[y])
                least[x] = min(least[x], least[y])
        index = np.empty(n, np.int64)
        index[walk] = np.arange(n)
        self.tokens = np.concatenate([sets[owner[x]][begin[x] : stop[x]] for x in walk if x] or [np.zeros(0, np.int64)])
        length = np.array([0 if x == 0 else stop[x] - begin[x] for x in walk])
        self.start = np.concatenate(([0], np.cumsum(length)))
        self.rest, self.least, self.sizes = rest[walk], least[walk], sizes
        self.kids_from = np.searchsorted(np.array([index[parent[x]] if x else -1 for x in walk]), np.arange(n + 1))
        self.ends = [np.array(ends[x], np.int64) for x in walk]
        self.has_end = np.array([bool(len(e)) for e in self.ends])

    def search(self, query: np.ndarray, size: int, mark: np.ndarray, percent: int) -> np.ndarray:
        """Sets with at least ``percent`` % similarity to ``query`` of the whole size ``size``; mark: all False, by token."""
        mark[query] = True
        needed = lambda other: -(-percent * (size + other) // (100 + percent))  # noqa: E731  of overlap
        live, overlap, left, found = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, len(query), np.int64), []
        while len(live):
            ok = overlap + np.minimum(left, self.rest[live]) >= needed(self.least[live])
            live, overlap, left = live[ok], overlap[ok], left[ok]
            for at in np.flatnonzero(self.has_end[live]):
                e = self.ends[live[at]]
                found.append(e[overlap[at] >= needed(self.sizes[e])])
            lo, hi = self.kids_from[live], self.kids_from[live + 1]
            count = hi - lo
            if not (total := int(count.sum())):
                break
            kid = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total)
            a, b = self.start[kid], self.start[kid + 1]
            span = b - a
            at = np.concatenate(([0], np.cumsum(span)))
            taken = self.tokens[np.repeat(a - at[:-1], span) + np.arange(at[-1])]
            sums = np.concatenate(([0], np.cumsum(mark[taken])))
            gain = sums[at[1:]] - sums[at[:-1]]
            passed = np.searchsorted(query, self.tokens[b - 1], "right")  # of the query, up to the node's last token
            live, overlap = kid, np.repeat(overlap, count) + gain
            left = len(query) - passed
        mark[query] = False
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def tree_join(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of similar sets, of different sides if ``side`` is given. Tokens are ordered by ascending frequency."""
    none = np.zeros(0, np.int64)
    if len(sets) < 2:
        return none, none
    sizes = np.array([len(s) for s in sets])
    token, back, freq = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(token), np.int64)
    rank[np.argsort(freq, kind="stable")] = np.arange(len(token))
    ranked, at = [], np.concatenate(([0], np.cumsum(sizes)))
    shared = freq[back] > 1
    for i in range(len(sets)):
        ranked.append(np.sort(rank[back[at[i] : at[i + 1]][shared[at[i] : at[i + 1]]]]))
    able = np.flatnonzero([100 * len(r) >= percent * n for r, n in zip(ranked, sizes, strict=True)])
    mark, left, right = np.zeros(len(token), bool), [none], [none]
    stored = able if side is None else able[side[able] == 1]
    asking = able if side is None else able[side[able] == 0]
    if len(stored) and len(asking):
        tree = PrefixTree([ranked[i] for i in stored], sizes[stored])
        for i in asking:
            j = stored[tree.search(ranked[i], int(sizes[i]), mark, percent)]
            j = j[j > i] if side is None else j
            left.append(np.full(len(j), i))
            right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@trimmed
def _groups(batches: Iterator[pa.RecordBatch], n: int, percent: int, salted: frozenset) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (grp, lo, hi): joins each run of sets and gives a spanning forest of its links."""
    key, sets, nodes, own = None, {}, [], []

    def done() -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            found = [sets[x] for x in nodes]
            i, j = tree_join(found, np.array(own) if key[1] != key[2] else None, percent)
            root = _forest(len(nodes), i, j)
            edges = [(nodes[x], nodes[r]) for x, r in enumerate(root) if x != r]
            if edges:
                yield batch_of(LINKS, [list(c) for c in zip(*edges, strict=True)])

    for batch in slices(batches, "text", 1 << 19):
        data, off = text_buffers(batch.column("text"))
        rows = zip(*(batch.column(c).to_pylist() for c in ("grp", "lo", "hi", "own", "node")), gram_sets(data, off, n), strict=True)
        for grp, lo, hi, part, node, grams in rows:
            if (grp, lo, hi) != key:
                yield from done()
                key, sets, nodes, own = (grp, lo, hi), {}, [], []
            if node not in sets and len(grams) and node_of(grams, salted)[0] == node:
                sets[node] = grams
                nodes.append(node)
                own.append(int(part != lo))
    yield from done()


def rarest(hits: DataFrame) -> DataFrame:
    """Rows (node, class, sig, need, holders) of the signatures by which a set can meet a partner: all but the ``need - 1`` that the most sets hold.

    Sets that link share ``need`` signatures of a class at least, of either's; in one order of all signatures the first that they share is
    among those left of both. A set with fewer than ``need`` has no row.
    """
    common_first = Window.partitionBy("node", "class").orderBy(F.desc("holders"), F.desc("sig"))
    return hits.withColumn("place", F.row_number().over(common_first)).where("place >= need").drop("place")


def among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose doc_id is in ``ids`` (rep), and a few others: ids meet by FILTER_BITS bits, so that other texts aren't shuffled."""
    words = lambda c: f"shiftright(pmod(xxhash64({c}), {FILTER_BITS}L), 6)"
    bit = lambda c: f"shiftleft(1L, cast(pmod(xxhash64({c}), 64L) as int))"
    held = ids.groupBy(F.expr(words("rep")).alias("word")).agg(F.expr(f"bit_or({bit('rep')})").alias("bits"))
    return docs.join(F.broadcast(held), F.expr(f"{words('doc_id')} = word")).where(F.expr(f"bits & {bit('doc_id')} <> 0")).select(docs.columns)


def similarity_groups(docs: DataFrame, *, n: int = 5, percent: int = 80, salted: frozenset = frozenset()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Words are runs of characters other than ASCII white space, with A-Z as a-z; texts link when
    100 * |intersection| >= percent * |union| of their distinct word n-grams. A shorter text is one n-gram of
    all its words; null and empty texts have none and link with nothing. Rows of a null id link with
    nothing either and have a null component. Equal sets are one node, so copies and repeated rows cost
    nothing; repeated ids share a component only through their texts. A very long text is one set of all its n-grams; an empty table gives an
    empty one. Other columns are not read. Words and n-grams are told apart by 64-bit hashes, sets by 128 bits: where two different ones
    share a node (64 bits of these) all is done again with the other 64 bits for those in ``salted``.
    """
    spark = docs.sparkSession
    parts = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = texts.mapInArrow(lambda it: _sign(it, n, percent, parts, salted), FACTS_DDL)
    facts = materialize(signed.repartition("part").sortWithinPartitions("part").mapInArrow(_hits, HITS_DDL), "signatures")
    rows = facts.where("sig is null").select("doc_id", "n_grams", "node", "check")
    of_node = rows.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_grams").alias("n_grams"), F.min("check").alias("check"), F.max("check").alias("other"))
    of_node = materialize(of_node, "nodes")
    release(spark)
    shared = of_node.where("check <> other").select("node").limit(MOST_SALTED).collect()  # of 10**10 sets about three share a node with another one
    if shared:
        return similarity_groups(docs, n=n, percent=percent, salted=salted | {r["node"] for r in shared})
    kept = rarest(facts.where("sig is not null")).select("sig", "node")
    # least members are tables of their own: a join with an aggregate of the same stage isn't split where a key is hot
    center = materialize(kept.groupBy("sig").agg(F.min("node").alias("center")), "centers")
    star = kept.join(center, "sig").select(F.col("node").alias("a"), F.col("center").alias("b"))
    grouped = components(star).withColumnRenamed("component", "grp")
    release(spark)
    members = materialize(grouped.join(of_node.select("node", "rep", "n_grams"), "node"), "members")
    split = members.groupBy("grp").agg(F.ceil(F.greatest(F.count("*") / PART_SETS, F.sum("n_grams") / PART_GRAMS)).cast("int").alias("parts"))
    dealt = members.join(split, "grp").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # merge: candidates grow with the documents, so their join is a sort-merge join at every size
    with_text = dealt.join(among(texts.where("doc_id is not null"), members).hint("merge"), dealt["rep"] == texts["doc_id"]).select("grp", "node", "own", "parts", "text")
    with_text = with_text.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["grp", "lo", "hi"]
    blocks = with_text.select("grp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "text")
    blocks = blocks.repartition(*keys).sortWithinPartitions(*keys, "node")
    links = blocks.mapInArrow(lambda it: _groups(it, n, percent, salted), "a long, b long")
    comp = components(links)
    labelled = rows.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = materialize(labelled.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    out = labelled.join(least, "component", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n_grams").alias("n_shingles"), component_id.alias("component_id"))
