"""Redaction of personal data by spans, with an allow-list that reports what it keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MAX_BYTES, is_safe_identifier, redact_spans, strip, truncate_bytes


def span_text(text: Column, span) -> Column:
    return F.substring(text, span["BeginOffset"] + 1, span["EndOffset"] - span["BeginOffset"])


def redact_documents(docs: DataFrame, detect, limit: int | None = MAX_BYTES) -> DataFrame:
    """`docs` with its text redacted, pii_redacted (types, sorted) and pii_allowlisted (spans kept, sorted, null if none).
    `detect(text)` is a Column of spans (Type, BeginOffset, EndOffset) in characters, or `docs` has them already as
    `entities` and `detect` is None. A service takes `limit` bytes: what is beyond goes, since it was not looked at, and
    that the text was cut is set in its provenance. A detector of this library reads texts whole: its limit is None."""
    cut = docs.withColumn("_cut", F.col("text") if limit is None else truncate_bytes(F.col("text"), limit))
    spans = cut.withColumn("_spans", F.coalesce(detect(F.col("_cut")) if detect else F.col("entities"), F.array().cast("array<struct<Type:string,BeginOffset:int,EndOffset:int>>")))
    safe = lambda s: is_safe_identifier(span_text(F.col("_cut"), s))
    split = spans.withColumn("_redact", F.filter("_spans", lambda s: ~safe(s))).withColumn("_kept", F.transform(F.filter("_spans", safe), lambda s: span_text(F.col("_cut"), s)))
    blank = strip(F.col("_cut")) == ""
    types = F.array_sort(F.array_distinct(F.transform("_redact", lambda s: s["Type"])))
    provenance = F.col("provenance").withField("truncated", F.col("provenance.truncated") | (F.col("_cut") != F.col("text")))
    out = split.withColumns({
        "provenance": provenance,
        "pii_redacted": F.when(blank, F.array().cast("array<string>")).otherwise(types),
        "pii_allowlisted": F.when(~blank & (F.size("_kept") > 0), F.array_sort(F.array_distinct("_kept"))),
        "allowlisted_spans": F.when(blank, F.array().cast("array<string>")).otherwise(F.col("_kept")),
        "text": F.when(blank, F.col("text")).otherwise(redact_spans(F.col("_cut"), F.col("_redact"))),
    })
    return out.drop("_cut", "_spans", "_redact", "_kept")


def tally(redacted: DataFrame) -> DataFrame:
    """kind, name, n: documents for each redacted type, spans for each kept identifier."""
    rows = redacted.select(F.explode(F.concat(F.transform("pii_redacted", lambda t: F.struct(F.lit("redacted").alias("kind"), t.alias("name"))), F.transform("allowlisted_spans", lambda t: F.struct(F.lit("allowlisted").alias("kind"), t.alias("name"))))).alias("r"))
    return rows.groupBy("r.kind", "r.name").agg(F.count("*").alias("n"))
