"""Near-duplicate vectors by lattice hashing.

Each table projects the normalised vectors onto 8 random orthonormal directions, scales them and decodes them
to the nearest point of the lattice E8. A vector is stored in its own cell and looks into the neighbouring
cells it is closest to. Vectors that meet are compared by their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.llm.common import GOLDEN, batch_of, splitmix
from textkiln.operators.graph import components
from textkiln.operators.storage import materialize

#: Tables, neighbouring cells probed in each, and the scale of the projections: recall is measured in tests/llm/test_operators.py.
TABLES, PROBES, SCALE = 4, 2, 2.1
#: Rows of a cell that one task compares at a time; larger cells are split into pairs of parts.
PART_ROWS = 1024
#: Cells where vectors meet are broadcast up to this count (about 3 MB), and joined by a shuffle beyond it.
BROADCAST_CELLS = 100_000


@lru_cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8: round, and where the sum is odd round the worst coordinate the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
    if len(odd):
        gap = x[odd] - r[odd]
        worst = np.abs(gap).argmax(1)
        r[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return r


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 + 1/2."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache
def _projection(dim: int, table: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, table, dim])
    return np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim]


def cells(unit: np.ndarray, label: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """uint64 [rows, tables, 1 + probes]: the own cell, then the nearest neighbouring cells; the label is part of the cell."""
    out = np.empty((len(unit), tables, 1 + probes), np.uint64)
    weights = splitmix(np.arange(1, 9, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    for t in range(tables):
        x = unit @ _projection(unit.shape[1], t, seed) * (scale * np.sqrt(unit.shape[1] / 8))
        own = decode_e8(x)
        points = [own]
        if probes:
            near = np.argpartition(-((x - own) @ roots().T), probes - 1, axis=1)[:, :probes]
            points += [own + roots()[near[:, p]] for p in range(probes)]
        base = splitmix(label.astype(np.int64).view(np.uint64) + splitmix(np.full(1, t + 1, np.uint64)))
        for p, point in enumerate(points):
            whole = (point * 2).astype(np.int64).view(np.uint64)
            out[:, t, p] = splitmix((whole * weights).sum(1, dtype=np.uint64) + base)
    return out


def _encode(batches: Iterator[pa.RecordBatch], schema: pa.Schema, how: tuple) -> Iterator[pa.RecordBatch]:
    """Vectors as doubles in bytes, with the cells of all tables: of each table first the own one, then those it looks into."""
    tables, probes, scale, seed = how
    for whole in batches:
        for a in range(0, whole.num_rows, 2048):
            batch = whole.slice(a, 2048)
            col = batch.column("vector")
            sizes = np.diff(np.asarray(col.offsets))
            flat = col.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                v = flat[starts[rows][:, None] + np.arange(dim)].astype(np.float64)
                scaled = v / np.abs(v).max(1, keepdims=True)
                unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                code = cells(unit, batch.column("salt").to_numpy()[rows], tables, probes, scale, seed).reshape(len(rows), -1)
                raw = np.ascontiguousarray(v)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * code.shape[1], pa.int32()), pa.array(np.ascontiguousarray(code).view(np.int64).ravel()))
                kept = batch.take(pa.array(rows))
                yield batch_of(schema, [*[kept.column(c) for c in ("id", "label", "weight")], pa.array([r.tobytes() for r in raw], pa.binary()), lists])


def _meet(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First table and smallest cell in which rows i and j meet: one of them stored there, the other one stored or looking."""
    n, tables = len(i), codes.shape[1]
    first, cell = np.full(n, tables, np.int64), np.zeros(n, np.uint64)
    for t in range(tables):
        left = np.flatnonzero(first == tables)
        if not len(left):
            break
        a, b = codes[i[left], t], codes[j[left], t]
        at_a, at_b = (b == a[:, :1]).any(1), (a == b[:, :1]).any(1)
        hit = at_a | at_b
        best = np.where(at_a & at_b, np.minimum(a[:, 0], b[:, 0]), np.where(at_a, a[:, 0], b[:, 0]))
        first[left[hit]], cell[left[hit]] = t, best[hit]
    return first, cell


def _roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least member of each row's component under the pairs (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _compare(group: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a cell, or of two parts of it: per row the weight linked (pairs that first meet here), and the component's root."""
    home, part, codes, table, cell = group["home"], group["part"], group["codes"], group["table"], group["cell"]
    n = len(home)
    links, keep_i, keep_j = np.zeros(n, np.int64), [], []
    unit = group["unit"]
    for a in range(0, n, PART_ROWS):
        close = unit[a : a + PART_ROWS] @ unit.T >= threshold - 1e-9
        i, j = np.nonzero(close)
        i = i + a
        ok = (i < j) & (home[i] | home[j]) & (group["label"][i] == group["label"][j]) & (group["id"][i] != group["id"][j])
        if part is not None:
            ok &= part[i] != part[j]
        i, j = i[ok], j[ok]
        for c in range(0, len(i), 1 << 16):
            x, y = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
            v, w = group["vec"][x], group["vec"][y]
            cosine = (v * w).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((w * w).sum(1)))
            good = cosine >= threshold
            x, y = x[good], y[good]
            t, k = _meet(codes, x, y)
            here = (t == table) & (k == cell)
            np.add.at(links, x[here], group["weight"][y[here]])
            np.add.at(links, y[here], group["weight"][x[here]])
            keep_i.append(x)
            keep_j.append(y)
    return links, _roots_of(n, np.concatenate(keep_i or [home[:0].astype(int)]), np.concatenate(keep_j or [home[:0].astype(int)]))


def _cells_of(batches: Iterator[pa.RecordBatch], schema: pa.Schema, threshold: float, shape: tuple) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (cell, parts): compare each run and give (id, links, root) for rows that linked."""
    held, key = [], None

    def done(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        if t.num_rows < 2:
            return
        sizes = np.array([len(x) for x in t.column("vec").to_pylist()])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            if len(at) < 2:
                continue
            s = t.take(pa.array(at))
            vec = np.frombuffer(b"".join(s.column("vec").to_pylist()), np.float64).reshape(len(at), -1)
            lo, hi = int(s.column("lo")[0].as_py()), int(s.column("hi")[0].as_py())
            scaled = vec / np.abs(vec).max(1, keepdims=True)
            g = {c: s.column(c).to_numpy() for c in ("home", "id", "weight")}
            g["label"] = s.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            g |= {"vec": scaled, "unit": scaled / np.linalg.norm(scaled, axis=1, keepdims=True), "codes": s.column("codes").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(at), *shape)}
            g |= {"table": int(s.column("t")[0].as_py()), "cell": np.uint64(int(s.column("cell")[0].as_py()) & (1 << 64) - 1), "part": s.column("own").to_numpy() if lo != hi else None}
            links, root = _compare(g, threshold)
            linked = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
            if len(linked):
                yield batch_of(schema, [pa.array(g["id"][linked]), pa.array(links[linked]), pa.array(g["id"][root[linked]])])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "t", "lo", "hi")], 1)
        cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if key is not None and tuple(keys[a]) != key:
                yield from done(held)
                held = []
            key = tuple(keys[a])
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield from done(held)


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.98, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors are compared if their labels, of any type, are equal and not null and their lengths agree; null, empty and zero
    vectors and ones with null or non-finite components link with nothing. Equal vectors of a label are one row until the end,
    so copies cost nothing. Only ids and cells are shuffled to find the cells where vectors meet; the vectors follow into those. A cell above PART_ROWS
    rows is split into parts that are compared pair by pair. Each pair counts in the first table and cell where it meets, so links are not counted twice.
    Repeated ids are rows of their own that share an id; extra columns, also of clashing names, are not read. Null ids come back unlinked; an empty
    table gives an empty one.
    """
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    valid = base.where(F.coalesce(fine, F.lit(False)))
    keyed = valid.withColumn("h", F.xxhash64("label", "vector"))
    reps = keyed.groupBy("h", "label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    reps = materialize(reps, "vectors")
    how, shape = (tables, probes, scale, seed), (tables, 1 + probes)
    coded_schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("weight", pa.int64()), ("vec", pa.binary()), ("codes", pa.list_(pa.int64()))])
    coded = reps.select("id", "label", "weight", "vector", F.xxhash64("label").alias("salt")).mapInArrow(lambda it: _encode(it, coded_schema, how), "id long, label string, weight long, vec binary, codes array<long>")
    coded = materialize(coded, "coded")
    stored = coded.select("id", F.posexplode("codes").alias("p", "cell")).select("id", "cell", F.floor(F.col("p") / (1 + probes)).cast("int").alias("t"), (F.col("p") % (1 + probes) == 0).alias("home"))
    meeting = stored.groupBy("cell", "t").agg(F.count("*").alias("n"), F.bool_or("home").alias("any")).where("n > 1 and any")
    meeting = materialize(meeting.select("cell", "t", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")), "cells")
    if meeting.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS:
        meeting = F.broadcast(meeting)
    dealt = stored.join(meeting, ["cell", "t"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    keys = ["cell", "t", "lo", "hi"]
    # merge: vectors that meet grow with the table
    dealt = dealt.select(*keys, "own", "home", "id").join(coded.hint("merge"), "id").repartition(*keys).sortWithinPartitions(*keys, "id")
    found_schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    found = materialize(dealt.mapInArrow(lambda it: _cells_of(it, found_schema, threshold, shape), "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = reps.select("h", F.col("label").alias("_l"), F.col("vector").alias("_v"), "id", "weight").join(links, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    facts = facts.select("h", "_l", "_v", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    done = keyed.join(facts, (keyed["h"] == facts["h"]) & (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v")))
    done = done.select("vec_id", (F.col("links") + F.col("weight") - 1).alias("n_links"), F.col("component").alias("component_id"))
    rest = base.where(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
