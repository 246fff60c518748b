"""Estimates over literal grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkiln.functions import estimate as E
from textkiln.plans.base import query, table


@query("SELECT layers::BIGINT AS layers, width, (32000 * width + layers * (width * width * 2 + width * (width // 8) * 4 + 3 * width * (width * 8 // 3) + 2 * width) + width)::BIGINT AS parameters FROM range(4, 33) l(layers), (VALUES (512::BIGINT), (768), (1024)) w(width)")
def parameter_grid(spark, d):
    grid = spark.range(4, 33).withColumnRenamed("id", "layers").withColumn("width", F.explode(F.array(*[F.lit(w).cast("long") for w in (512, 768, 1024)])))
    w = F.col("width")
    return grid.withColumn("parameters", E.parameters(F.lit(32000), w, F.col("layers"), F.expr("width * 8 div 3"), F.lit(8), F.lit(2), F.lit(True)))


@query("""WITH g AS (SELECT layers, width, (32000 * width + layers * (width * width * 2 + width * (width // 8) * 4 + 3 * width * (width * 8 // 3) + 2 * width) + width)::BIGINT AS p FROM range(4, 33) l(layers), (VALUES (512::BIGINT), (768), (1024)) w(width))
SELECT width, arg_min(layers, abs(p - 150000000) * 100 + layers)::BIGINT AS layers FROM g GROUP BY width""")
def layers_for_target(spark, d):
    """Layers of each width that come nearest to 150 million parameters."""
    gap = F.abs(F.col("parameters") - 150_000_000) * 100 + F.col("layers")
    return parameter_grid(spark, d).groupBy("width").agg(F.min_by("layers", gap).alias("layers"))


@query("SELECT lang, floor(sum(length(text)) / 4.45)::BIGINT AS tokens, floor(sum(length(text)) / 4.45) * 4.45 * 3.0 / 1e9 AS gb, floor(sum(length(text)) / 4.45) / 20.0 AS params FROM documents GROUP BY lang")
def corpus_estimate(spark, d):
    by = table(spark, d, "documents").groupBy("lang").agg(E.tokens_of_chars(F.sum(F.length("text"))).alias("tokens"))
    return by.select("lang", "tokens", E.gb_of_tokens(F.col("tokens")).alias("gb"), E.chinchilla_params(F.col("tokens")).alias("params"))
