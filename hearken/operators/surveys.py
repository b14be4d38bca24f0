"""Survey rows: checks, records, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip
from ..functions.values import iso_date, rating, satisfaction_gap, satisfaction_ordinal
from .checks import ADVISORY, FATAL, Check, admissible, issues


TEXTS = ("customer_id", "product_id", "improvement_area", "comments")


def survey_checks() -> list[Check]:
    """Over parsed columns (texts stripped, what cannot be parsed null), in the order that issues are told."""
    present = lambda name: F.col(name) != ""
    known = lambda name: F.col(name).isNotNull()
    return [
        Check("customer_id_present", FATAL, present("customer_id")),
        Check("survey_date_valid", FATAL, known("survey_date")),
        Check("product_rating_in_1_5", FATAL, known("product_rating")),
        Check("service_rating_in_1_5", FATAL, known("service_rating")),
        Check("overall_satisfaction_known_label", FATAL, known("satisfaction_ordinal")),
        Check("product_id_present", ADVISORY, present("product_id")),
        Check("comments_present", ADVISORY, present("comments")),
        Check("improvement_area_present", ADVISORY, present("improvement_area")),
    ]


def numbered(raw: DataFrame, file: str = "source_file", position: str = "position") -> DataFrame:
    """row_number within each file, from 2, since the header is row 1; `position` orders a file's rows."""
    return raw.withColumn("row_number", (F.row_number().over(Window.partitionBy(file).orderBy(position)) + 1).cast("int"))


def survey_records(raw: DataFrame) -> DataFrame:
    """A record for each raw row (row_number and eight string columns); extra columns of `raw` stay in front. Cells are
    parsed in a projection of their own, and judged in the next, so that none is parsed twice."""
    own = ("row_number", *TEXTS, "survey_date", "product_rating", "service_rating", "overall_satisfaction")
    extra = [c for c in raw.columns if c not in own]
    parsed = raw.select(
        *extra,
        "row_number",
        *(strip(F.col(c)).alias(c) for c in TEXTS),
        iso_date(F.col("survey_date")).alias("survey_date"),
        rating(F.col("product_rating")).alias("product_rating"),
        rating(F.col("service_rating")).alias("service_rating"),
        blank_to_null(F.col("overall_satisfaction")).alias("overall_satisfaction"),
        satisfaction_ordinal(F.col("overall_satisfaction")).alias("satisfaction_ordinal"),
    )
    checks = survey_checks()
    tidy = lambda name: blank_to_null(F.col(name)).alias(name)
    return parsed.select(
        *extra,
        "row_number",
        tidy("customer_id"),
        tidy("product_id"),
        "survey_date",
        "product_rating",
        "service_rating",
        "overall_satisfaction",
        "satisfaction_ordinal",
        satisfaction_gap(F.col("satisfaction_ordinal"), F.col("product_rating"), F.col("service_rating")).alias("rating_satisfaction_gap"),
        tidy("improvement_area"),
        tidy("comments"),
        F.coalesce(F.col("comments") != "", F.lit(False)).alias("has_comment"),
        admissible(checks).alias("admissible"),
        issues(checks).alias("issues"),
    )


def survey_summary(records: DataFrame, *by: str) -> DataFrame:
    """One row, or one for each value of `by`, by one aggregate. Means are over admissible records; without any, they are null."""
    mean = lambda c: F.bround(F.avg(F.when(F.col("admissible"), F.col(c))), 2)
    return records.groupBy(*by).agg(
        F.count("*").alias("rows_read"),
        F.count_if("admissible").alias("admissible"),
        F.count_if(~F.col("admissible")).alias("rejected"),
        F.bround(F.try_divide(F.count_if("admissible"), F.count("*")), 3).alias("admission_rate"),
        mean("product_rating").alias("mean_product_rating"),
        mean("service_rating").alias("mean_service_rating"),
        mean("satisfaction_ordinal").alias("mean_satisfaction_ordinal"),
        F.count_if(F.col("admissible") & F.col("has_comment")).alias("with_comment"),
    )


def improvement_counts(records: DataFrame) -> DataFrame:
    """improvement_area and its admissible records, most first; of equals, the one seen first."""
    counted = records.where("admissible and improvement_area is not null").groupBy("improvement_area").agg(F.count("*").alias("n"), F.min("row_number").alias("seen"))
    return counted.orderBy(F.desc("n"), "seen").drop("seen")


def issue_counts(records: DataFrame) -> DataFrame:
    """check and how many records fail it, over all records."""
    told = records.select("row_number", F.explode("issues.check").alias("check"))
    return told.groupBy("check").agg(F.count("*").alias("n"), F.min("row_number").alias("seen")).orderBy(F.desc("n"), "seen").drop("seen")
