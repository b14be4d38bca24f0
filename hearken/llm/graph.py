"""Connected components of an edge table, by alternating large and small stars; nothing is collected but two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, saved, shared_folder

SALTS = 32


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every node of `edges` (src, dst) but the roots. Rounds go on until
    nothing changes, which takes about the logarithm of the longest path. Loops and repeats do no harm; an edge with a
    null end is left out; no edges, no rows."""
    spark = edges.sparkSession
    path, before = shared_folder(spark, "edges"), None
    now = saved(edges.where("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges", path)
    while True:
        # Each edge is hung up at the least neighbour of its end. An end that many edges share is met in SALTS parts; only
        # ends that have a lesser neighbour themselves need be looked up.
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        inner = least.join(now.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        parts = inner.select(F.col("u").alias("v"), "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salted = now.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int"))
        large = salted.join(parts, ["v", "salt"], "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, path = path, shared_folder(spark, "edges")
        now = saved(hung.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges", path)
        removed(spark, last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
