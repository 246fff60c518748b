"""Hierarchical weighted hash tree: region, rack and shard are drawn level by level.

At every node each child draws ``-ln(u) / weight`` with ``u`` hashed from (child, key); the smallest draw
wins, so a child is chosen in proportion to its weight and a changed weight moves keys only into or out of
the subtree that holds it. Draws of other subtrees do not change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shards of a rack and racks of a region in the base layout.
RACK_SHARDS, REGION_RACKS = 4, 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(n_shards: int, base: int = 16, weights: dict[int, float] | None = None) -> list[Leaf]:
    """Leaves for ``n_shards``: the first ``base`` in full regions, each later one a region of its own.

    A later shard therefore takes keys only into itself, at any count from ``base`` on.
    """
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    base, leaves, per_region = min(base, n_shards), [], RACK_SHARDS * REGION_RACKS
    regions = -(-base // per_region)
    for s in range(n_shards):
        region, rack = (s // per_region, s % per_region // RACK_SHARDS) if s < base else (regions + s - base, 0)
        leaves.append(Leaf(region, rack, s, (weights or {}).get(s, 1.0)))
    if any(not x.weight > 0 for x in leaves):
        raise ValueError("weights must be positive")
    return leaves


def _draw(key: Column, children: list[tuple[str, float, Column]], seed: int) -> Column:
    """The value of the child with the smallest weighted draw; children: (name, weight, value)."""
    if len(children) == 1:
        return children[0][2]
    draws = []
    for i, (name, weight, value) in enumerate(children):
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}/{name}"), key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        draws.append(F.struct((-F.ln(u) / F.lit(float(weight))).alias("draw"), F.lit(i).alias("i"), value.alias("value")))
    return F.array_min(F.array(*draws))["value"]


def assign(key: Column, leaves: list[Leaf], seed: int = 0) -> Column:
    """Shard of ``key`` by descent: the region by the sums of its leaves' weights, then rack, then shard."""
    def pick(level: int, among: list[Leaf], path: str) -> Column:
        if level == 3:
            return F.lit(among[0].shard).cast("int")
        groups: dict[int, list[Leaf]] = {}
        for x in among:
            groups.setdefault((x.region, x.rack, x.shard)[level], []).append(x)
        ids = sorted(groups)
        chosen = _draw(key, [(f"{path}/{g}", sum(x.weight for x in groups[g]), F.lit(g)) for g in ids], seed)
        if level == 2:
            return chosen.cast("int")
        if len(ids) == 1:
            return pick(level + 1, groups[ids[0]], f"{path}/{ids[0]}")
        return F.element_at(F.transform(F.array(chosen), lambda g: _branch(g, [(i, pick(level + 1, groups[i], f"{path}/{i}")) for i in ids])), 1)

    return pick(0, leaves, "")


def _branch(chosen: Column, arms: list[tuple[int, Column]]) -> Column:
    out = F.when(chosen == arms[0][0], arms[0][1])
    for i, arm in arms[1:]:
        out = out.when(chosen == i, arm)
    return out


def shard(df: DataFrame, key: str, n_shards: int = 16, *, text: str = "text", seed: int = 0, bucket_rows: int = 1_000_000) -> DataFrame:
    """Add shard, slot (gapless from 0 in each shard) and grown_shard (with one shard more) to every row.

    Slots are numbered in hash buckets of about ``bucket_rows`` rows, each from the sum of the counts before
    it, so no task orders a whole shard. A null key is a key like others; null text has size 1 and CRC 0; a long text counts with all its bytes.
    Rows that are repeated get slots of their own; an empty table gives an empty one. Columns of these names are replaced; others stay.
    """
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    k = F.col(key)
    place, grown = assign(k, tree(n_shards), seed), assign(k, tree(n_shards + 1, base=n_shards if n_shards < 16 else 16), seed)
    buckets = max(1, -(-df.count() // (bucket_rows * n_shards)))
    bucket = F.pmod(F.xxhash64(F.lit("slot"), k, size), F.lit(buckets)).cast("int")  # by size too: rows of one hot key are spread
    keyed = df.withColumns({
        "size": size, "text_crc32": F.crc32(F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))), "law": F.lit("key"),
        "shard": place, "grown_shard": grown, "_tk_bucket": bucket,
    })
    counts = df.select(place.alias("shard"), bucket.alias("_tk_bucket")).groupBy("shard", "_tk_bucket").agg(F.count("*").alias("_tk_n"))
    before = counts.withColumn("_tk_before", F.sum("_tk_n").over(Window.partitionBy("shard").orderBy("_tk_bucket")) - F.col("_tk_n")).drop("_tk_n")
    within = Window.partitionBy("shard", "_tk_bucket").orderBy(key, "size", "text_crc32")
    out = keyed.withColumn("_tk_i", F.row_number().over(within) - 1).join(before, ["shard", "_tk_bucket"])
    return out.withColumn("slot", F.col("_tk_i") + F.col("_tk_before")).drop("_tk_bucket", "_tk_i", "_tk_before")
