"""One feedback document shape for all sources: four adapters, their union, the batch to analyse, its manifest, and links
to products and between channels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, document_stem, order_ref, strip, top_score
from .containment import matched

SCHEMA = """doc_id string, source_type string, source_key string, customer_id string, product_id string, occurred_on string,
order_ref string, text string,
signals struct<sentiment:string,sentiment_confidence:double,sentiment_source:string,rating:int,rating_satisfaction_gap:double>,
provenance struct<admissible:boolean,truncated:boolean,trust_notes:array<string>>"""

# Notes that travel with documents. Fixed values.
POSITIONAL = "speaker roles are a POSITIONAL GUESS (first speaker assumed to be the agent), not channel-verified -- treat attribution as uncertain"
UNKNOWN_ROLES = "speaker roles could not be inferred; attribution is unknown"
SELF_REPORTED = "ratings and the stated satisfaction label are self-reported"
OCR_NOTES = (
    "text is OCR output and may contain recognition errors",
    "no key/value structure is provided: Textract FORMS output was tested and found unreliable on these documents",
)


def document(df: DataFrame, doc_id: Column, source_type: str, source_key: Column, text: Column, *, customer_id=None, product_id=None, occurred_on=None, sentiment=None, confidence=None, sentiment_source: str | None = None, rating=None, gap=None, admissible=None, truncated=None, notes=None) -> DataFrame:
    """The one constructor: every source has the same fields; blanks are null, texts are stripped and never null."""
    null = F.lit(None)
    held = lambda c, kind: (null if c is None else c).cast(kind)
    tidy = lambda c: blank_to_null(held(c, "string"))
    return df.select(
        doc_id.alias("doc_id"),
        F.lit(source_type).alias("source_type"),
        source_key.alias("source_key"),
        tidy(customer_id).alias("customer_id"),
        tidy(product_id).alias("product_id"),
        tidy(occurred_on).alias("occurred_on"),
        order_ref(text).alias("order_ref"),
        strip(F.coalesce(text, F.lit(""))).alias("text"),
        F.struct(held(sentiment, "string").alias("sentiment"), held(confidence, "double").alias("sentiment_confidence"), F.lit(sentiment_source).cast("string").alias("sentiment_source"), held(rating, "int").alias("rating"), held(gap, "double").alias("rating_satisfaction_gap")).alias("signals"),
        F.struct(F.coalesce(admissible if admissible is not None else F.lit(True), F.lit(False)).alias("admissible"), F.coalesce(truncated if truncated is not None else F.lit(False), F.lit(False)).alias("truncated"), (notes if notes is not None else F.array().cast("array<string>")).alias("trust_notes")).alias("provenance"),
    )


def from_reviews(processed: DataFrame) -> DataFrame:
    """Processed reviews (source_key, original_text, sentiment, sentiment_scores, metadata): only admitted ones get here."""
    meta = lambda c: F.col(f"metadata.{c}")
    return document(processed, F.concat(F.lit("review:"), document_stem(F.col("source_key"))), "review", F.col("source_key"), F.col("original_text"), customer_id=meta("customer_id"), product_id=meta("product_id"), occurred_on=meta("review_date"), sentiment=F.col("sentiment"), confidence=top_score(F.col("sentiment_scores"), F.col("sentiment")), sentiment_source="comprehend", rating=meta("rating"))


def from_calls(processed: DataFrame) -> DataFrame:
    """Processed calls (source_key, source_audio, status, turns, speakers, sentiment). The customer's sentiment alone counts."""
    roles = F.coalesce("speakers", F.create_map().cast("map<string,struct<role_guess:string,role_method:string>>"))
    line = lambda t: F.concat(F.coalesce(F.try_element_at(roles, t["speaker"])["role_guess"], F.lit("unknown")), F.lit(": "), strip(F.coalesce(t["text"], F.lit(""))))
    text = F.array_join(F.transform(F.col("turns"), line), "\n")
    has = lambda field, value: F.exists(F.map_values(roles), lambda r: F.coalesce(r[field] == value, F.lit(False)))
    notes = F.array_compact(F.array(F.when(has("role_method", "first_speaker"), F.lit(POSITIONAL)), F.when(has("role_guess", "unknown"), F.lit(UNKNOWN_ROLES))))
    customer = F.try_element_at(F.col("sentiment"), F.lit("customer_overall"))
    cut = F.exists(F.map_values("sentiment"), lambda s: F.coalesce(s["truncated"], F.lit(False)))
    return document(processed, F.concat(F.lit("call:"), document_stem(F.coalesce("source_audio", "source_key"))), "call", F.col("source_key"), text, sentiment=customer["sentiment"], confidence=top_score(customer["scores"], customer["sentiment"]), sentiment_source="comprehend/customer_turns", admissible=F.col("status") == "COMPLETED", truncated=cut, notes=notes)


def survey_notes(issues: Column) -> Column:
    named = lambda severity: F.array_join(F.transform(F.filter(issues, lambda i: i["severity"] == severity), lambda i: i["check"]), ", ")
    fatal, advisory = named("FATAL"), named("ADVISORY")
    return F.array_compact(F.array(F.when(fatal != "", F.concat(F.lit("failed validation: "), fatal)), F.when(advisory != "", F.concat(F.lit("incomplete fields: "), advisory)), F.lit(SELF_REPORTED)))


def from_surveys(records: DataFrame, several_files: bool = False) -> DataFrame:
    """Survey records (source_key and the record's fields). Row numbers count within a file, so ids name the file if there
    are several."""
    row = F.concat(F.lit("row_"), F.col("row_number"))
    name = F.concat(F.lit("survey:"), document_stem(F.col("source_key")), F.lit("/"), row) if several_files else F.concat(F.lit("survey:"), row)
    return document(records, name, "survey", F.col("source_key"), F.col("comments"), customer_id=F.col("customer_id"), product_id=F.col("product_id"), occurred_on=F.col("survey_date"), sentiment=F.col("overall_satisfaction"), sentiment_source="self_reported_label", rating=F.col("product_rating"), gap=F.col("rating_satisfaction_gap"), admissible=F.col("admissible"), notes=survey_notes(F.col("issues")))


def from_images(records: DataFrame) -> DataFrame:
    """Processed images (source_key, image_key, full_text, metadata). No sentiment was ever computed for them."""
    return document(records, F.concat(F.lit("image:"), document_stem(F.coalesce("image_key", "source_key"))), "image", F.col("source_key"), F.col("full_text"), customer_id=F.col("metadata.customer_id"), product_id=F.col("metadata.product_id"), notes=F.array(*map(F.lit, OCR_NOTES)))


ADAPTERS = {"/reviews/": from_reviews, "/calls/": from_calls, "/surveys/": from_surveys, "/images/": from_images}


def normalise(records: DataFrame, prefix: str) -> DataFrame:
    """Dispatch by where records lie, not by what they look like."""
    for part, adapter in ADAPTERS.items():
        if part in f"/{prefix.strip('/')}/":
            return adapter(records)
    raise ValueError(f"unrecognised source prefix: {prefix}")


def unified(*sources: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def admissible_batch(docs: DataFrame) -> DataFrame:
    """What is analysed: admissible documents with a text."""
    return docs.where("provenance.admissible and text <> ''")


def manifest(docs: DataFrame) -> DataFrame:
    """One row of totals over all documents; what is left out of the batch is counted."""
    sent = F.col("provenance.admissible") & (F.col("text") != "")
    size = F.length(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}))
    per = docs.groupBy("source_type").agg(F.count("*").alias("n"), F.count_if(sent).alias("sent"), F.coalesce(F.sum(F.when(sent, size)), F.lit(0)).alias("chars"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents_total"), F.coalesce(F.sum("sent"), F.lit(0)).alias("documents_sent"), F.coalesce(F.sum(F.col("n") - F.col("sent")), F.lit(0)).alias("excluded"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_type", "n")))).alias("by_source"), F.coalesce(F.sum("chars"), F.lit(0)).alias("approx_chars"))


def order_stars(docs: DataFrame, left: str = "call", right: str = "image") -> DataFrame:
    """order_ref, source_type, doc_id, n_left, n_right: the documents of two channels that name one order are a star around
    it, a row for each document, with how many of either channel the order has. An order that very many name, such as one
    that is often misread, makes no more rows than it has documents."""
    sides = docs.where(F.col("source_type").isin(left, right) & F.col("order_ref").isNotNull())
    sides = sides.select("order_ref", "source_type", "doc_id")
    both = (F.count_if(F.col("source_type") == kind).alias(name) for kind, name in ((left, "n_left"), (right, "n_right")))
    size = sides.groupBy("order_ref").agg(*both)
    return sides.join(size.where("n_left > 0 and n_right > 0"), "order_ref")


def order_links(docs: DataFrame, left: str = "call", right: str = "image", most: int | None = None) -> DataFrame:
    """order_ref, left_id, right_id: each pair of documents of two channels that name one order; with `most`, those of orders
    that have at most `most` pairs, while `order_stars` tells all orders without pairs."""
    star = order_stars(docs, left, right)
    star = star if most is None else star.where(F.col("n_left") * F.col("n_right") <= most)
    side = lambda kind, name: star.where(F.col("source_type") == kind).select("order_ref", F.col("doc_id").alias(name))
    return side(left, "left_id").join(side(right, "right_id"), "order_ref")


def link_products(docs: DataFrame, catalogue: DataFrame, most: int | None = None) -> DataFrame:
    """doc_id, linked_product, product_link_basis: a document's own product; else that of a document with its order (the
    first in the alphabet); else the first product of the catalogue (product_id, name) whose name its text has; else none.
    Names are found by a substring join, so that the catalogue may be of any size, unless the caller refuses one of over
    `most` names; texts whose product is known are not looked through."""
    if most is not None and catalogue.limit(most + 1).count() > most:
        raise ValueError(f"the catalogue has over {most} names")
    by_order = docs.where("order_ref is not null and product_id is not null").groupBy("order_ref").agg(F.min("product_id").alias("ordered"))
    names = catalogue.where("product_id is not null").groupBy(F.lower("name").alias("needle")).agg(F.min("product_id").alias("named"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "product_id", "order_ref", "text").join(by_order, "order_ref", "left")
    open_ = rows.select("row", "doc_id", F.coalesce("product_id", "ordered").alias("known"), F.col("product_id").isNotNull().alias("stated"), F.lower("text").alias("text"))
    open_ = open_.withColumn("text", F.when(F.col("known").isNull(), F.col("text")))
    looked = matched(open_, "text", names, "left").join(names, "needle", "left")
    told = looked.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("known").alias("known"), F.first("stated").alias("stated"), F.min("named").alias("named"))
    basis = F.when(F.col("stated"), "stated_id").when(F.col("known").isNotNull(), "order_reference").when(F.col("named").isNotNull(), "inferred_from_text").otherwise("none")
    return told.select("doc_id", F.coalesce("known", "named").alias("linked_product"), basis.alias("product_link_basis"))


def unique_ids(docs: DataFrame) -> DataFrame:
    """doc_id, n of ids that stand for more than one document; none, if all is well."""
    return docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")


def latest(docs: DataFrame, order: str) -> DataFrame:
    """Of documents that were delivered more than once, the last; of those of one time, that of the greatest hash of all
    its columns, so that the choice does not depend on where rows lie."""
    last = Window.partitionBy("doc_id").orderBy(F.desc(order), F.desc(F.xxhash64(F.to_json(F.struct(*docs.columns)))))
    return docs.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
