"""Quality classifier by compression: which of two Zstandard dictionaries shortens a text more.

One dictionary is trained on good and one on bad labelled text. A text is cut into blocks, each block is compressed
with both, and the difference of the summed sizes, divided by their sum, is the only thing that is known of a
text. A logistic calibration makes it a score: the probability of label 1 at even odds of the two classes, so a
score means the same whatever share of the labels is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textkiln.llm.common import slices, text_batches, text_buffers, trimmed

#: Bytes of a block and of a dictionary; compression level.
BLOCK, DICTIONARY, LEVEL = 512, 112 << 10, 3
#: Bytes of the segments that dictionaries are made of, and of the strings whose frequency picks them.
SEGMENT, GRAM = 200, 8
#: The bound of the training sample: labelled documents of each class, with whole texts.
SAMPLE_DOCS = 3000


def held_out(key: Column) -> Column:
    """True for the fifth of the ids that training never sees: crc32 of the decimal id divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def blocks_of(raw: memoryview | bytes, size: int = BLOCK) -> list:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def make_dictionary(blocks: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary, or where there is too little text for one the text itself."""
    try:
        return zstd.train_dictionary(size, blocks, k=SEGMENT, d=GRAM).as_bytes()
    except zstd.ZstdError:
        return b"".join(blocks)[-size:]


@lru_cache(8)
def _compressor(raw: bytes):
    if not raw:
        return zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False)
    d = zstd.ZstdCompressionDict(raw)
    d.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    #: Log odds of label 1 at difference 0, and their growth with the difference.
    offset: float = 0.0
    slope: float = 0.0

    def difference(self, blocks: list) -> float:
        """In (-1, 1): above 0 where the good dictionary gives the smaller size; 0 for no text."""
        good, bad = _compressor(self.good).compress, _compressor(self.bad).compress
        a, b = sum([len(good(x)) for x in blocks]), sum([len(bad(x)) for x in blocks])
        return (b - a) / (a + b) if blocks else 0.0

    def score(self, blocks: list) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.offset + self.slope * self.difference(blocks), -35, 35))))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 200) -> tuple[float, float]:
    """(offset, slope) of a logistic curve over ``x`` with both classes of ``y`` at equal total weight.

    Newton's method on the penalised loss; a step is halved until the loss falls, and a fit that doesn't converge is an error.
    """
    n, ones = len(y), int(y.sum())
    weight = np.where(y == 1, n / (2 * max(1, ones)), n / (2 * max(1, n - ones)))
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    s, w = np.stack([np.ones(n), (x - mean) / spread], 1), np.zeros(2)

    def loss(w: np.ndarray) -> float:
        z = s @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * (w @ w))

    held = loss(w)
    for _ in range(rounds):
        p = np.exp(-np.logaddexp(0, -(s @ w)))
        down = s.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((s * (weight * p * (1 - p))[:, None]).T @ s + ridge * np.eye(2), down)
        gain = float(down @ step)
        if gain <= 1e-10 * (1 + held):
            break
        size = 1.0
        while not (new := loss(w + size * step)) <= held - 1e-4 * size * gain:
            size /= 2
            if size < 1e-12:
                raise ValueError(f"the calibration finds no smaller loss than {held:.6g}")
        w, held = w + size * step, new
    else:
        raise ValueError(f"the calibration hasn't converged after {rounds} rounds: loss {held:.6g}")
    w = w + step  # the last step is within the tolerance
    return float(w[0] - w[1] * mean / spread), float(w[1] / spread)


def fit_model(rows: list[tuple[int, list[bytes]]]) -> Model:
    """From (label, blocks): each half is judged by dictionaries of the other half for the calibration, which then serves the whole."""
    dictionaries = lambda part: [make_dictionary([b for y, bs in part if y == c for b in bs]) for c in (1, 0)]
    if not rows:
        return Model(b"", b"")
    x, y = [], []
    for fold in (0, 1):
        other = Model(*dictionaries(rows[1 - fold :: 2]))
        x += [other.difference(bs) for _, bs in rows[fold::2]]
        y += [label for label, _ in rows[fold::2]]
    return Model(*dictionaries(rows), *calibrate(np.array(x), np.array(y, float)))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on labelled rows outside the held-out fifth, at most ``sample_docs`` of each class in order of a hash of the id.

    The whole texts of these rows reach the driver and nothing else does. Labels that are null or neither 0 nor 1, null
    ids and labels of absent documents are left out. A repeated label counts once (1 before 0), a repeated id with
    its greatest text; null and empty texts have no blocks. Without any row, as with empty tables, every score is 0.5. Other columns,
    also of clashing names, are not read.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    present = docs.select(F.col(key).alias("k")).distinct()
    known = known.where(~held_out(F.col("k"))).join(present, "k").withColumn("h", F.md5(F.col("k").cast("string")))
    picked = known.where("y = 1").orderBy("h").limit(sample_docs).unionByName(known.where("y = 0").orderBy("h").limit(sample_docs))
    chosen = F.broadcast(picked.select("k", "y", "h"))  # 2 * sample_docs rows at most
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").cast("binary").alias("t")).join(chosen, "k")
    found = sorted(rows.groupBy("h", "y").agg(F.max("t").alias("t")).collect(), key=lambda r: r["h"])
    return fit_model([(r["y"], blocks_of(bytes(r["t"] or b""))) for r in found])


def score_column(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text, which depends on nothing but the text and the model.

    Null and empty texts get the score of difference 0. A long text is read block by block. Repeated rows come back
    repeated with equal scores, an empty table gives an empty one; a column called ``name`` is replaced and all others stay.
    """
    keep = [c for c in docs.columns if c != name]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep) + f", `{name}` double"

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            data, off = text_buffers(batch.column(text))
            view, off = memoryview(np.ascontiguousarray(data)), (off - off[0]).tolist()
            scores = [model.score(blocks_of(view[a:b])) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*keep, name])

    return text_batches(docs).select(*keep).mapInArrow(run, ddl)
