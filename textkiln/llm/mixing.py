"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only.

A source of measured size ``s`` and target share ``w`` of ``total`` gets the mean repetition rate
``w * total / s``. Every row's copy count is the Poisson quantile of a uniform number hashed from the seed and
the row's id: with the same seed, the same rows are drawn on any cluster. Copies are then ordered by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The largest mean that one draw inverts; a larger one is the sum of independent draws of equal mean.
DRAW_MEAN = 16.0
#: Rates of more sources than this are joined without a broadcast.
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column | str) -> Column:
    """In [0, 1), from 52 bits of the MD5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... up to where the tail falls below 1e-17, for means up to DRAW_MEAN."""
    steps = F.sequence(F.lit(1), F.lit(int(DRAW_MEAN + 12 * DRAW_MEAN**0.5 + 20)))
    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), F.array(zero).alias("cdf"))
    return F.aggregate(
        steps, start,
        lambda a, j: F.struct((a["p"] * mean / j).alias("p"), F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["p"] * mean / j).alias("cdf")),
    )["cdf"]


def rates(docs: DataFrame, weights: dict[str, float], *, source: str = "source", measure: Column | None = None, total: float | None = None, default: float = 0.0) -> DataFrame:
    """One row per source of ``docs``: size, rate, draws and the CDF of one draw.

    ``weights`` are normalised over the sources that occur and have a size; ``default`` is the weight of others,
    the null source included. ``total`` defaults to the size of the input. A source of size 0 gets rate 0.
    """
    size = F.coalesce(measure if measure is not None else F.octet_length("text").cast("long"), F.lit(0))
    by = docs.groupBy(F.col(source).alias("_tk_source")).agg(F.sum(size).alias("_tk_size"))
    w = F.lit(float(default))
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        w = F.when(F.col("_tk_source").isNull(), w).otherwise(F.coalesce(F.try_element_at(table, F.col("_tk_source")), w))
    by = by.withColumn("_tk_w", F.when(F.col("_tk_size") > 0, w).otherwise(0.0))
    sums = by.agg(F.sum("_tk_w").alias("_tk_all_w"), F.sum("_tk_size").alias("_tk_all"))
    goal = F.lit(float(total)) if total is not None else F.col("_tk_all").cast("double")
    rate = F.when((F.col("_tk_w") > 0) & (F.col("_tk_size") > 0), F.col("_tk_w") * goal / F.col("_tk_all_w") / F.col("_tk_size")).otherwise(0.0)
    draws = F.greatest(F.lit(1), F.ceil(F.col("_tk_rate") / DRAW_MEAN).cast("int"))
    out = by.crossJoin(F.broadcast(sums)).withColumn("_tk_rate", rate).withColumn("_tk_draws", draws)  # one row of sums
    return out.select("_tk_source", "_tk_size", "_tk_rate", "_tk_draws", poisson_cdf(F.col("_tk_rate") / F.col("_tk_draws")).alias("_tk_cdf"))


def replicate(docs: DataFrame, weights: dict[str, float], *, key: str = "doc_id", source: str = "source", seed: int = 0, shuffle: bool = True, **options) -> DataFrame:
    """The rows of ``docs``, each ``n_copies`` times with ``copy_no`` from 0, in the order of ``shuffle_key``.

    Null keys draw like a key named "null"; repeated rows draw alike; rows with count 0 leave. An empty table
    gives an empty one; a null or empty text has size 0, a very long one counts with all its bytes. Columns named n_copies, copy_no, shuffle_key, rate
    are replaced, other ones stay. The key is uniform, so its leading digits alone deal the copies over the partitions in its order: no sample is drawn for
    the sort, and the copies of one row go to all partitions.
    """
    by = rates(docs, weights, source=source, **options)
    if by.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        by = F.broadcast(by)
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    draw = lambda c: F.size(F.filter(F.col("_tk_cdf"), lambda p: p <= uniform(F.lit(seed), name, c.cast("string"))))
    count = F.aggregate(F.sequence(F.lit(0), F.col("_tk_draws") - 1), F.lit(0), lambda a, c: a + draw(c))
    joined = docs.join(by, docs[source].eqNullSafe(by["_tk_source"])).withColumns({"rate": F.col("_tk_rate"), "n_copies": count})
    drawn = joined.where("n_copies > 0").drop("_tk_source", "_tk_size", "_tk_rate", "_tk_draws", "_tk_cdf")
    out = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    out = out.withColumn("shuffle_key", F.substring(F.md5(F.concat_ws(":", F.lit(f"order{seed}"), name, F.col("copy_no").cast("string"))), 1, 16))
    if not shuffle:
        return out
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * parts / (1 << 32)).cast("int")
    return out.repartitionById(parts, place).sortWithinPartitions("shuffle_key")
