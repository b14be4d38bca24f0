"""Scaled synthetic feedback with its truth: every row is a function of its number and the seed, so any partition can be
made anywhere, again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import satisfaction_for

PRODUCTS = ("AUD-1100", "KIT-2100", "FIT-3100", "CLN-4100", "SND-5100")
ISSUES = 3  # the first so many products have an issue


def pick(name: str, n: int, seed: int) -> Column:
    """An integer from 0 to n - 1 for each row."""
    return F.pmod(F.xxhash64("id", F.lit(name), F.lit(seed)), F.lit(n)).cast("int")


def surveys(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n raw survey rows (strings) with position, planted_mismatch and malformed beside them."""
    base = spark.range(n)
    product = pick("product", len(PRODUCTS), seed)
    stars = F.when(product < ISSUES, 1 + pick("p", 2, seed)).otherwise(4 + pick("p", 2, seed))
    service = 2 + pick("s", 4, seed)
    planted = F.pmod("id", F.lit(15)) == 8
    label = F.when(planted, F.when(product < ISSUES, "Very Satisfied").otherwise("Dissatisfied")).otherwise(satisfaction_for(stars, service))
    stars, service = F.when(planted & (product < ISSUES), 1).when(planted, 5).otherwise(stars), F.when(planted & (product < ISSUES), 1).when(planted, 5).otherwise(service)
    malformed = F.when(F.pmod("id", F.lit(29)) == 5, "no_customer_id").when(F.pmod("id", F.lit(29)) == 21, "no_survey_date")
    day = F.concat(F.lit("2026-"), F.lpad((1 + pick("m", 9, seed)).cast("string"), 2, "0"), F.lit("-"), F.lpad((1 + pick("d", 28, seed)).cast("string"), 2, "0"))
    return base.select(
        F.lit("synthetic.csv").alias("source_key"), F.col("id").alias("position"),
        F.when(malformed == "no_customer_id", "").otherwise(F.concat(F.lit("CUST-"), (F.col("id") + 3000).cast("string"))).alias("customer_id"),
        F.element_at(F.array(*map(F.lit, PRODUCTS)), product + 1).alias("product_id"),
        F.when(malformed == "no_survey_date", "").otherwise(day).alias("survey_date"),
        stars.cast("string").alias("product_rating"), service.cast("string").alias("service_rating"), label.alias("overall_satisfaction"),
        F.when(product < ISSUES, "Build quality").otherwise("").alias("improvement_area"), F.when(F.pmod("id", F.lit(5)) == 0, "").otherwise("Works as told, so far.").alias("comments"),
        planted.alias("planted_mismatch"), malformed.alias("malformed"),
    )


def reviews(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n raw reviews with planted_mismatch and malformed beside them."""
    product = pick("product", len(PRODUCTS), seed)
    bad = product < ISSUES
    planted = F.pmod("id", F.lit(7)) == 2
    stars = F.when(bad == planted, 4 + pick("r", 2, seed)).otherwise(1 + pick("r", 2, seed))
    malformed = F.when(F.pmod("id", F.lit(19)) == 3, "short_text").when(F.pmod("id", F.lit(19)) == 7, "no_product_id").when(F.pmod("id", F.lit(19)) == 11, "rating_range")
    text = F.when(bad, "It broke within a week and I want a refund.").otherwise("A great buy, I am happy with it.")
    return spark.range(n).select(
        F.format_string("review_%09d", "id").alias("file_name"), F.when(malformed == "short_text", "Bad").otherwise(text).alias("review_text"),
        F.when(~F.coalesce(malformed == "no_product_id", F.lit(False)), F.element_at(F.array(*map(F.lit, PRODUCTS)), product + 1)).alias("product_id"),
        F.concat(F.lit("CUST-"), F.col("id").cast("string")).alias("customer_id"), F.when(malformed == "rating_range", 9).otherwise(stars).alias("rating"), F.lit("2026-05-04").alias("review_date"),
        planted.alias("planted_mismatch"), malformed.alias("malformed"),
    )


def images(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n processed images: image_key, full_text, metadata."""
    product, order = pick("product", len(PRODUCTS), seed), (F.col("id") + 9001).cast("string")
    pid = F.element_at(F.array(*map(F.lit, PRODUCTS)), product + 1)
    cust = F.concat(F.lit("CUST-"), (F.col("id") + 2001).cast("string"))
    text = F.concat_ws("\n", F.when(product < ISSUES, "RETURN REQUEST").otherwise("WARRANTY REGISTRATION"), F.concat(F.lit("Order #ORD-"), order), F.concat(F.lit("Product: "), pid), F.concat(F.lit("Customer: "), cust))
    return spark.range(n).select(F.concat(pid, F.lit("_"), cust, F.lit(".png")).alias("image_key"), text.alias("full_text"), F.struct(pid.alias("product_id"), cust.alias("customer_id")).alias("metadata"))
