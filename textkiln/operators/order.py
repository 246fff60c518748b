"""Order-dependent operators: global numbering without one big task, budgets, chunks, splits, packing, quotas."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textkiln.operators.storage import materialize


def seeded(seed: int | str, key: Column) -> Column:
    """A reproducible random order: the MD5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _sums_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds _s, the sum of _v over the rows of the partition before each."""
    held = 0
    for batch in batches:
        v = np.asarray(batch.column("_v").fill_null(0))
        to = held + np.cumsum(v)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to - v, pa.int64())], names=[*batch.schema.names, "_s"])
        held = int(to[-1]) if len(to) else held


def numbered(df: DataFrame, *order: str, value: Column | None = None, buckets: int | None = None) -> DataFrame:
    """Adds ``pos`` (from 0 in the order of columns) and, with ``value``, ``before`` (its sum over the rows before).

    Rows are range-partitioned and sorted; each range is numbered by itself and shifted by the sums of the ranges
    before it, of which there are ``buckets``, by default as many as shuffle partitions. The ranges are a table: drawn a second time, their
    borders would be others.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = value if value is not None else F.lit(0)
    ranged = df.withColumn("_v", F.coalesce(v.cast("long"), F.lit(0))).repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # partition and place in it
    ranged = ranged.withColumn("_m", at).withColumns({"_part": F.shiftright("_m", 33).cast("int"), "_i": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_m")
    if value is not None:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", _s long"
        ranged = ranged.mapInArrow(_sums_before, ddl)
    local = materialize(ranged, "ranges")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = local.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_v").alias("_t"))
    sums = sums.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_t0"))
    out = local.join(F.broadcast(sums), "_part").withColumn("pos", F.col("_i") + F.col("_n0"))
    if value is not None:
        out = out.withColumn("before", F.col("_s") + F.col("_t0"))
    return out.drop("_v", "_part", "_i", "_s", "_n0", "_t0")


def budget_sample(df: DataFrame, size: Column, budget: int, seed: int, key: str) -> DataFrame:
    """Rows in seeded order until their sizes reach the budget; the row that crosses it stays."""
    shuffled = df.withColumn("_h", seeded(seed, F.col(key)))
    return numbered(shuffled, "_h", value=size).where(F.col("before") < budget).drop("_h", "pos", "before")


def placed_in_group(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``pos`` from 0 within each group, by the global numbering less the group's first: no task holds a whole group. Groups are few."""
    placed = numbered(df, group, *order)
    first = placed.groupBy(group).agg(F.min("pos").alias("_first"))
    joined = placed.join(first.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("pos", F.col("pos") - F.col("_first")).drop("_first", "_group")


def rotate(df: DataFrame, order: str, group: str, rows: int) -> DataFrame:
    """Adds ``shard``: every ``rows`` rows of a group in order start a new one."""
    return placed_in_group(df, group, order).withColumn("shard", F.floor(F.col("pos") / rows)).drop("pos")


def sample_rows(df: DataFrame, n: int, key: str, seed: int | str = 0) -> DataFrame:
    """``n`` rows drawn without replacement: the first in seeded order of the key."""
    return df.withColumn("_h", seeded(seed, F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def running_share(df: DataFrame, *order: str, value: Column) -> DataFrame:
    """Adds ``so_far``, the sum of values up to and with the row in order, and its share of the whole."""
    placed = numbered(df.withColumn("_value", value.cast("long")), *order, value=F.col("_value")).drop("pos")
    whole = df.agg(F.sum(value.cast("long")).alias("_whole"))
    out = placed.crossJoin(F.broadcast(whole)).withColumn("so_far", F.col("before") + F.col("_value"))  # a table of one row
    return out.withColumn("share", F.col("so_far") / F.col("_whole")).drop("before", "_value", "_whole")


def map_batches(df: DataFrame, change, schema: str, size: int = 1000) -> DataFrame:
    """``change``, a function from a table of at most ``size`` rows to one of any number, over all rows in batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), size):
                yield change(pdf.iloc[at : at + size].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def size_chunks(df: DataFrame, order: str, size: str, target: int) -> DataFrame:
    """(order, chunk): a chunk closes with the row that brings its own size to the target.

    The cut depends on all cuts before it, so thin rows (order, size) are folded in one ordered pass.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, held = 0, 0
        for pdf in batches:
            out = []
            for s in pdf[size]:
                out.append(chunk)
                held += s
                if held >= target:
                    chunk, held = chunk + 1, 0
            yield pd.DataFrame({order: pdf[order], "chunk": out})

    kind = df.schema[order].dataType.simpleString()
    return df.select(order, size).repartition(1).sortWithinPartitions(order).mapInPandas(fold, f"{order} {kind}, chunk long")


def split_by_position(df: DataFrame, key: str, seed: int, shares: list[tuple[str, float]]) -> DataFrame:
    """Adds ``split``: exact shares (floored) by seeded order; the last name takes the rest."""
    n = df.count()
    at, out, pos = 0, None, F.col("pos")
    for name, share in shares[:-1]:
        at += int(n * share)
        out = F.when(pos < at, name) if out is None else out.when(pos < at, name)
    rest = F.lit(shares[-1][0])
    split = rest if out is None else out.otherwise(rest)
    return numbered(df.withColumn("_h", seeded(seed, F.col(key))), "_h").withColumn("split", split).drop("_h", "pos")


def pack_sequences(df: DataFrame, order: str, tokens: str, length: int, offset: int = 0) -> DataFrame:
    """(seq, start, tokens) of fixed length over the concatenated token stream, from ``offset`` on; a short tail is left out."""
    placed = numbered(df.select(order, tokens), order, value=F.size(tokens))
    cells = placed.select((F.col("before") - offset).alias("b"), F.posexplode(tokens).alias("i", "token")).select((F.col("b") + F.col("i")).alias("at"), "token").where("at >= 0")
    grouped = cells.groupBy(F.floor(F.col("at") / length).alias("seq")).agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("c"))
    return grouped.where(F.size("c") == length).select("seq", (F.col("seq") * length + offset).alias("start"), F.col("c.token").alias("tokens"))


def oversample(df: DataFrame, group: str, quotas: dict[str, int], *order: Column) -> DataFrame:
    """Each group repeated cyclically, or cut, to its quota: adds copy_no and oversampled."""
    table = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    keyed = df
    for i, c in enumerate(order):
        keyed = keyed.withColumn(f"_o{i}", c)
    names = [f"_o{i}" for i in range(len(order))]
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).withColumnRenamed(group, "_group")
    sized = placed_in_group(keyed, group, *names).join(sizes, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_q", F.coalesce(F.try_element_at(table, F.col(group)), F.lit(0)))
    copies = F.when(F.col("_q") > F.col("pos"), F.floor((F.col("_q") - F.col("pos") - 1) / F.col("_n")) + 1).otherwise(0)
    out = sized.withColumn("_c", copies).where("_c > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
    return out.withColumn("oversampled", F.col("copy_no") > 0).drop("_q", "_n", "pos", "_c", "_group", *names)
