"""Exact top-k search over 64-bit binary codes by incremental multi-index hashing.

A code is cut into segments of equal width, each with an index from its value to the codes. A query probes all values within
segment radius 0, 1, 2, ...; after radius r every code at Hamming distance below segments * (r + 1) has been met in
some segment, so the search of a query ends as soon as its k-th verified distance is below that bound. A radius is one join of
the open queries' probes with the index by (segment, value); the best distances found so far are carried to the next one, where
farther codes are dropped at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.operators.storage import materialize

BITS = 64


def sign_code(vector: Column) -> Column:
    """64-bit code: bit i is set where component i is above 0 (null components: not set); a vector of another length than 64, or null, has none."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(vector) == BITS, F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))


def segments_for(n: int) -> int:
    """Segments for n codes: about as wide as the logarithm of n, so that a value has few codes."""
    return 8 if n < 1 << 12 else 4 if n < 1 << 24 else 2


def _segment(code: Column, s: Column, width: int) -> Column:
    return F.call_function("shiftrightunsigned", code, (s * width).cast("int")).bitwiseAND(F.lit((1 << width) - 1))


def _probes(open_: DataFrame, segments: int, radius: int) -> DataFrame:
    """(q, bound, s, value): the values at distance ``radius`` from each segment of each open query, each once, bit after bit."""
    width = BITS // segments
    out = open_.select("q", "bound", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("s"), F.lit(0).cast("long").alias("mask"), F.lit(-1).alias("top"))
    for left in range(radius - 1, -1, -1):  # so many bits are set after this one, all above it
        out = out.where(F.col("top") + 1 <= width - 1 - left).withColumn("top", F.explode(F.sequence(F.col("top") + 1, F.lit(width - 1 - left))))
        out = out.withColumn("mask", F.col("mask").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("top"))))
    return out.select("q", "bound", "s", _segment(F.col("q"), F.col("s"), width).bitwiseXOR(F.col("mask")).alias("value"))


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, *, segments: int | None = None) -> DataFrame:
    """The k nearest of ``index`` (id, code) for each of ``queries`` (id, code): query_id, rank, neighbor_id, distance.

    Exact; ties by the smaller id; an id is no neighbour of itself. Rows with null id or code take no part.
    Of equal codes only the k + 1 smallest ids can be among the k nearest, so no more of them are searched, and equal
    queries are searched once: a hot code costs no more than a rare one. Repeated ids count once; an empty index or query set gives no rows;
    with fewer than k others a query gets them all. Other columns, also of clashing names, are not read.
    """
    index = index.select(F.col("id").cast("long").alias("id"), F.col("code").cast("long").alias("code")).where("id is not null and code is not null").distinct()
    index = index.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    codes = materialize(index.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")
    asked = materialize(queries.select(F.col("id").cast("long").alias("query_id"), F.col("code").cast("long").alias("q")).where("query_id is not null and q is not null").distinct(), "queries")
    size = codes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("ids")).first()
    m = segments or segments_for(size["n"])
    width, want = BITS // m, k + 1
    entries = codes.select("code", F.element_at("ids", 1).alias("least"), F.size("ids").alias("n_ids"), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("s"))
    entries = entries.withColumn("value", _segment(F.col("code"), F.col("s"), width))
    found, open_ = None, asked.select("q").distinct().withColumn("bound", F.lit(None).cast("int"))
    for radius in range(width + 1):
        differ = F.col("q").bitwiseXOR(F.col("code"))
        apart = [(F.lit(t), F.bit_count(_segment(differ, F.lit(t), width))) for t in range(m)]
        # a pair is taken up once: at its least segment distance, in the first segment that has it
        once = reduce(lambda a, b: a & b, [((t < F.col("s")) & (d > radius)) | (t == F.col("s")) | ((t > F.col("s")) & (d >= radius)) for t, d in apart])
        distance = F.bit_count(differ)
        # merge: probes are many more than their queries' size tells
        met = _probes(open_.repartition("q"), m, radius).join(entries.hint("merge"), ["s", "value"]).where(once & (F.col("bound").isNull() | (distance <= F.col("bound"))))
        met = met.select("q", "code", "least", "n_ids", distance.cast("int").alias("distance"))
        nearest = Window.partitionBy("q").orderBy("distance", "least")
        best = (met if found is None else met.unionByName(found)).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= want).drop("rank")
        found = materialize(best, "found")
        seen = F.sum("n_ids").over(nearest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        reached = found.withColumn("seen", seen).groupBy("q").agg(F.min(F.when(F.col("seen") >= want, F.col("distance"))).alias("bound"), F.max("seen").alias("seen"))
        left = open_.select("q").join(reached, "q", "left").where(f"(bound is null or bound >= {m * (radius + 1)}) and coalesce(seen, 0) < {size['ids']}" if size["ids"] < want else f"bound is null or bound >= {m * (radius + 1)}")
        open_ = materialize(left.select("q", "bound"), "open")
        if open_.isEmpty():
            break
    near = found.join(codes, "code").select("q", "distance", F.explode("ids").alias("neighbor_id"))
    pairs = asked.join(near, "q").where("neighbor_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
