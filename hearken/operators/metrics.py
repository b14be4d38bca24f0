"""Metric datapoints: namespace, name, value, unit, dims, ts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def datum(df: DataFrame, namespace: str, name: str, value: Column, ts: Column, unit: str = "None", **dims: Column) -> DataFrame:
    tags = F.create_map(*(x for k, v in dims.items() for x in (F.lit(k), v))) if dims else F.create_map()
    return df.select(F.lit(namespace).alias("namespace"), F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"), tags.cast("map<string,string>").alias("dims"), ts.alias("ts"))


def validation_metrics(verdicts: DataFrame, ts: Column) -> DataFrame:
    """QualityScore and AdmissionRate of each verdict."""
    score = datum(verdicts, "CustomerFeedback/TextQuality", "QualityScore", F.col("quality_score"), ts, Source=F.lit("TextReviews"))
    return score.unionByName(datum(verdicts, "CustomerFeedback/TextQuality", "AdmissionRate", F.col("admissible").cast("int"), ts, Source=F.lit("TextReviews")))


def job_metrics(jobs: DataFrame, ts: Column) -> DataFrame:
    """One TranscriptionJobs count for each job that ended, by status."""
    return datum(jobs.where("status in ('COMPLETED', 'FAILED')"), "CustomerFeedback/Calls", "TranscriptionJobs", F.lit(1), ts, "Count", Status=F.col("status"))


def ruleset_metrics(events: DataFrame, ts: Column) -> DataFrame:
    """The pass rate for each ruleset of an event. A score of 0 counts; an event without a score is left out, whatever its
    state says; without rulesets there is nothing to report."""
    scored = events.where("detail.score is not null").withColumn("ruleset", F.explode(F.coalesce("detail.rulesetNames", F.array().cast("array<string>"))))
    return datum(scored, "CustomerFeedback/DataQuality", "RulesetPassRate", F.col("detail.score"), ts, Ruleset=F.col("ruleset"))


def review_metrics(summary: DataFrame, ts: Column) -> DataFrame:
    """MismatchRate (0 where nothing could be judged), and the documents flagged and escalated."""
    name = "CustomerFeedback/Quality"
    out = datum(summary, name, "MismatchRate", F.coalesce("mismatch_rate", F.lit(0.0)), ts)
    return out.unionByName(datum(summary, name, "RecordsFlagged", F.col("flagged"), ts, "Count")).unionByName(datum(summary, name, "RecordsEscalatedToFM", F.col("escalate_to_fm"), ts, "Count"))


def windowed(metrics: DataFrame, width: str = "1 hour") -> DataFrame:
    """window_start, namespace, name, dims, n, mean, total of each tumbling window; works on streams with a watermark."""
    keyed = metrics.withColumn("tags", F.to_json("dims"))
    return keyed.groupBy(F.window("ts", width).alias("w"), "namespace", "name", "tags").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "namespace", "name", "tags", "n", "mean", "total")
