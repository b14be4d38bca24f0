"""Deterministic quality review: contradictions within a document, routes, summaries, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Business rules: two points on a five-point scale are another opinion. Fixed values.
MIN_RATING_DIVERGENCE, MIN_SURVEY_GAP = 2, 2.0
ROUTES = ("rejected", "review_queue", "escalate_to_fm", "auto_accept")


def rating_divergence(sentiment: Column, rating: Column) -> Column:
    """How far a rating is from what the text's label implies; 0 where they agree or the rule cannot decide."""
    label = F.upper(sentiment)
    return F.coalesce(F.when((label == "POSITIVE") & (rating <= 2), 4 - rating).when((label == "NEGATIVE") & (rating >= 4), rating - 2), F.lit(0))


def survey_divergence(gap: Column) -> Column:
    """The size of a survey's own disagreement, 0 below the threshold or without a gap."""
    return F.coalesce(F.when(F.abs(gap) >= MIN_SURVEY_GAP, F.abs(gap)), F.lit(0.0))


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, source_type, product_id, route, flags, sentiment, rating, rating_satisfaction_gap, text_excerpt of every
    document, inadmissible ones too. Each flag carries its evidence."""
    sentiment, rating, gap = (F.col(f"signals.{c}") for c in ("sentiment", "rating", "rating_satisfaction_gap"))
    apart, own = rating_divergence(sentiment, rating), survey_divergence(gap)
    flag = lambda rule, detail, size: F.struct(F.lit(rule).alias("rule"), detail.alias("detail"), size.cast("double").alias("divergence"))
    flags = F.array_compact(F.array(
        F.when(apart >= MIN_RATING_DIVERGENCE, flag("sentiment_vs_rating", F.concat(F.lit("text scored "), sentiment, F.lit(" but the customer rated it "), rating.cast("string"), F.lit("/5")), apart)),
        F.when(own > 0, flag("survey_label_vs_ratings", F.concat(F.lit("stated satisfaction differs from own ratings by "), own.cast("string"), F.lit(" points")), own)),
    ))
    route = F.when(~F.col("provenance.admissible"), "rejected").when(F.size(flags) > 0, "review_queue").when(sentiment.isNull() & (F.coalesce("text", F.lit("")) != ""), "escalate_to_fm").otherwise("auto_accept")
    return docs.select("doc_id", "source_type", "product_id", route.alias("route"), flags.alias("flags"), sentiment.alias("sentiment"), rating.alias("rating"), gap.alias("rating_satisfaction_gap"), F.left(F.coalesce("text", F.lit("")), F.lit(160)).alias("text_excerpt"))


def review_summary(judged: DataFrame) -> DataFrame:
    """One row: documents, one count a route, judged, flagged, and the rate over what could be judged (null if nothing)."""
    counts = [F.count_if(F.col("route") == r).alias(r) for r in ROUTES]
    flagged, seen = F.count_if(F.col("route") == "review_queue"), F.count_if(F.col("route").isin("review_queue", "auto_accept"))
    return judged.agg(F.count("*").alias("documents"), *counts, seen.alias("judged"), flagged.alias("flagged"), F.bround(F.try_divide(flagged, seen), 4).alias("mismatch_rate"))


def truth_score(flagged: DataFrame, planted: DataFrame) -> DataFrame:
    """One row of counts, precision, recall and F1 of the doc_ids flagged against those planted; null on a zero
    denominator, F1 0 then."""
    both = flagged.select("doc_id").distinct().withColumn("f", F.lit(1)).join(planted.select("doc_id").distinct().withColumn("p", F.lit(1)), "doc_id", "full")
    f, p = F.count("f"), F.count("p")
    tp = F.count_if(F.col("f").isNotNull() & F.col("p").isNotNull())
    counts = both.agg(p.alias("planted"), f.alias("flagged"), tp.alias("true_positives"), (p - tp).alias("missed"), (f - tp).alias("false_positives"))
    precision, recall = F.try_divide("true_positives", "flagged"), F.try_divide("true_positives", "planted")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return counts.select("*", F.bround(precision, 3).alias("precision"), F.bround(recall, 3).alias("recall"), F.bround(f1, 3).alias("f1"))


def truth_sets(flagged: DataFrame, planted: DataFrame) -> DataFrame:
    """doc_id, outcome: hit (both), miss (planted only) or other (flagged only)."""
    f, p = flagged.select("doc_id"), planted.select("doc_id")
    tag = lambda df, name: df.withColumn("outcome", F.lit(name))
    return tag(p.intersect(f), "hit").union(tag(p.subtract(f), "miss")).union(tag(f.subtract(p), "other"))
