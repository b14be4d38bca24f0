"""What other services would tell, each behind a small interface with a deterministic local default.

A sentiment provider maps a text Column to struct(sentiment, scores); a PII or entity provider maps it to an array of
spans. The defaults are Column expressions and stay in generated code. `replay` joins captured answers instead, and
`call_out` sends batches to a Python callable, once each: filter before it, for no filter passes through it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let, running_sum

# A general English lexicon, not made from any data set at hand. Fixed values.
POSITIVE = ("good", "great", "excellent", "amazing", "happy", "love", "loved", "perfect", "best", "wonderful", "helpful", "pleased", "satisfied", "fantastic", "thank", "thanks", "recommend", "easy", "reliable", "impressed")
NEGATIVE = ("bad", "poor", "terrible", "awful", "broken", "broke", "disappointed", "disappointing", "worst", "hate", "useless", "refund", "defective", "faulty", "stopped", "failed", "fails", "waste", "angry", "unacceptable", "return", "returned", "cracked")


def _hits(text: Column, words: tuple[str, ...]) -> Column:
    return F.size(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?<![a-z])(" + "|".join(words) + r")(?![a-z])"), F.lit(1)))


def lexicon_sentiment(text: Column) -> Column:
    """struct(sentiment, scores): counts of lexicon words, and one for none, shared out over four labels."""
    good, bad = _hits(text, POSITIVE).cast("double"), _hits(text, NEGATIVE).cast("double")
    total = good + bad + F.lit(1.0)
    scores = {"Positive": (good - F.least(good, bad) / 2) / total, "Negative": (bad - F.least(good, bad) / 2) / total, "Neutral": F.lit(1.0) / total, "Mixed": F.least(good, bad) / total}
    label = F.when((good > 0) & (good == bad), "MIXED").when(good > bad, "POSITIVE").when(bad > good, "NEGATIVE").otherwise("NEUTRAL")
    return F.struct(label.alias("sentiment"), F.create_map(*(x for k, v in scores.items() for x in (F.lit(k), v))).alias("scores"))


# What an address ends with, and what a name may follow. Fixed values.
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Boulevard", "Blvd", "Lane", "Ln", "Drive", "Dr", "Court", "Ct", "Square", "Sq", "Place", "Pl", "Terrace", "Way")
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof")
# Kinds of personal data and their patterns, tried from the left. Fixed values. An address is a number, one to four words in
# capitals, and a street's suffix; a name is one or two capitalised words after a title.
PII = (
    ("EMAIL", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("CREDIT_DEBIT_NUMBER", r"(?<![\w-])(?:\d{4}[ -]){3}\d{4}(?![\w-])"),
    ("SSN", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("PHONE", r"(?<![\w-])(?:\+\d{1,3}[ -]?)?(?:\(\d{3}\) ?|\d{3}[ -])\d{3}[ -]\d{4}(?![\w-])"),
    ("LICENSE_PLATE", r"(?<![\w-])[A-Z]{2,4}-\d{3,5}(?![\w-])"),
    ("ADDRESS", r"(?<![\w-])\d{1,5}[A-Za-z]? (?:[A-Z][A-Za-z']{0,30} ){1,4}(?:" + "|".join(STREETS) + r")(?![\w-])"),
    ("NAME", r"(?<![\w-])(?:" + "|".join(TITLES) + r")\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?(?![\w-])"),
)
#: Kinds whose digits have to end in their check digit.
CHECKED = ("CREDIT_DEBIT_NUMBER",)
ENTITIES = (("QUANTITY", r"\b\d+(?:\.\d+)? ?(?:days?|weeks?|months?|years?|hours?|minutes?|seconds?|%|percent)\b"), ("DATE", r"\b\d{4}-\d{2}-\d{2}\b"))


SPANS = "array<struct<Type:string,BeginOffset:int,EndOffset:int>>"


def pattern_spans(text: Column, kinds=PII) -> Column:
    """Spans (Type, BeginOffset, EndOffset) of the patterns' matches, from the left; they never overlap, and of patterns
    that match at one place the kind named first wins. The text is looked through twice, for the matches and for what lies
    between them; offsets are the running sums of their lengths, so the time grows with the text and not with the square of
    its matches. A number of a CHECKED kind without its check digit is passed over, whole. Null has no spans."""
    every = "|".join(f"(?:{pattern})" for _, pattern in kinds)
    found = F.regexp_extract_all(text, F.lit(f"({every})"), F.lit(1))
    named = lambda own: F.coalesce(*(F.when(own.rlike(f"^(?:{pattern})$"), name) for name, pattern in kinds[:-1]), F.lit(kinds[-1][0]))

    def spans(own: Column) -> Column:
        before = F.transform(F.slice(F.split(text, every, -1), F.lit(1), F.size(own)), F.length)
        sizes = F.transform(own, F.length)

        def told(ends: Column) -> Column:
            begins = F.zip_with(ends, sizes, lambda end, size: end - size)
            typed = F.zip_with(F.transform(own, named), begins, lambda kind, begin: F.struct(kind.alias("Type"), begin.cast("int").alias("BeginOffset")))
            return F.zip_with(typed, ends, lambda s, end: F.struct(s["Type"].alias("Type"), s["BeginOffset"].alias("BeginOffset"), end.cast("int").alias("EndOffset")))

        return let(running_sum(F.zip_with(before, sizes, lambda a, b: a + b)), told)

    def sound(own: Column) -> Column:
        wrong = lambda s, i: s["Type"].isin(*CHECKED) & ~F.call_function("luhn_check", F.regexp_replace(F.get(own, i), "[^0-9]", ""))
        return F.filter(spans(own), lambda s, i: ~wrong(s, i)) if {name for name, _ in kinds} & set(CHECKED) else spans(own)

    none = F.array().cast(SPANS)
    return let(found, lambda own: F.when(F.size(own) > 0, sound(own)).otherwise(none))


def key_phrases(text: Column) -> Column:
    """Runs of two to four words of five letters or more: a plain stand-in."""
    return F.regexp_extract_all(text, F.lit(r"[A-Za-z]{5,}(?: [A-Za-z]{5,}){1,3}"), F.lit(0))


def replay(items: DataFrame, captured: DataFrame, on: list[str]) -> DataFrame:
    """Items with the answers captured for them; null where there is none."""
    return items.join(captured, on, "left")


def call_out(items: DataFrame, answer: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Items answered batch by batch by a Python callable that returns a frame of `schema`."""

    def run(frames):
        for frame in frames:
            yield answer(frame)

    return items.mapInPandas(run, schema)


def process_reviews(reviews: DataFrame, sentiment=lexicon_sentiment, limit: int | None = None) -> DataFrame:
    """Processed reviews of admitted ones: original_text, entities, sentiment, sentiment_scores, key_phrases, metadata. The
    providers here read texts whole; `limit` is for a service that takes so many bytes."""
    from ..functions.text import truncate_bytes

    text = F.col("review_text")
    asked = reviews.withColumn("_text", text if limit is None else truncate_bytes(text, limit)).withColumn("_s", sentiment(F.col("_text")))
    keep = [c for c in reviews.columns if c in ("file_name", "source_key")]
    return asked.select(
        *keep, F.col("review_text").alias("original_text"), pattern_spans(F.col("_text"), ENTITIES).alias("entities"), F.col("_s.sentiment").alias("sentiment"), F.col("_s.scores").alias("sentiment_scores"),
        key_phrases(F.col("_text")).alias("key_phrases"), F.struct("product_id", "customer_id", "review_date", F.col("rating").cast("int").alias("rating")).alias("metadata"),
    )
