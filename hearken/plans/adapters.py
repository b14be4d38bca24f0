"""The driver's tables in the shapes of feedback sources; SQL has the same as common table expressions.

Every mapping is a function of a row alone, so an adapter is a projection that the scan prunes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import SATISFACTION_SCALE

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    text = lambda c: F.col(c).cast("string")
    return d.select(
        F.concat(F.lit("review_"), text("doc_id")).alias("file_name"), "doc_id", F.col("text").alias("review_text"),
        F.when(F.col("doc_id") % 11 != 0, F.concat(F.lit("PRD-"), (F.col("doc_id") % 50 + 100).cast("string"))).alias("product_id"),
        F.when(F.col("doc_id") % 17 != 0, F.concat(F.lit("CUST-"), text("doc_id"))).alias("customer_id"),
        (F.col("doc_id") % 7).cast("int").alias("rating"),
        F.when(F.col("doc_id") % 13 == 0, "05/01/2026").otherwise("2026-01-05").alias("review_date"),
    )


REVIEWS = """reviews AS (SELECT 'review_' || doc_id AS file_name, doc_id, text AS review_text,
    CASE WHEN doc_id % 11 <> 0 THEN 'PRD-' || (doc_id % 50 + 100) END AS product_id,
    CASE WHEN doc_id % 17 <> 0 THEN 'CUST-' || doc_id END AS customer_id, (doc_id % 7)::INT AS rating,
    CASE WHEN doc_id % 13 = 0 THEN '05/01/2026' ELSE '2026-01-05' END AS review_date FROM documents),
judged AS (SELECT *, coalesce(review_text <> '', false) AS has_review_text, coalesce(product_id <> '', false) AS has_product_id,
    coalesce(customer_id <> '', false) AS has_customer_id, rating IS NOT NULL AS has_rating, coalesce(review_date <> '', false) AS has_review_date,
    coalesce(length(review_text) >= 10, false) AS min_length, coalesce(rating BETWEEN 1 AND 5, false) AS rating_in_range,
    coalesce(regexp_full_match(review_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}'), false) AS valid_date_format FROM reviews),
scored AS (SELECT *, (has_review_text::INT + has_product_id::INT + has_customer_id::INT + has_rating::INT + has_review_date::INT
    + min_length::INT + rating_in_range::INT + valid_date_format::INT) / 8.0::DOUBLE AS quality_score,
    has_review_text AND has_product_id AND min_length AND rating_in_range AS admissible FROM judged)"""


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    blank = lambda n, other: F.when(key % n == 0, "").otherwise(other)
    label = F.element_at(F.array(*map(F.lit, SATISFACTION_SCALE)), F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, PRIORITIES)), F.col("o_orderpriority")).cast("int"), F.lit(0)), F.lit(3)))
    return o.select(
        F.lit("orders.csv").alias("source_key"), (key + 1).cast("int").alias("row_number"),
        blank(29, F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string"))).alias("customer_id"),
        blank(19, F.concat(F.lit("PRD-"), (key % 50 + 100).cast("string"))).alias("product_id"),
        blank(23, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("survey_date"),
        (key % 6).cast("string").alias("product_rating"), (key % 5 + 1).cast("string").alias("service_rating"), label.alias("overall_satisfaction"),
        blank(7, F.concat(F.lit("Area "), (key % 4).cast("string"))).alias("improvement_area"), blank(5, F.concat(F.lit(" priority "), F.col("o_orderpriority"))).alias("comments"),
    )


SURVEYS = """raw AS (SELECT 'orders.csv' AS source_key, (o_orderkey + 1)::INT AS row_number,
    CASE WHEN o_orderkey % 29 <> 0 THEN 'CUST-' || o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 19 <> 0 THEN 'PRD-' || (o_orderkey % 50 + 100) END AS product_id,
    CASE WHEN o_orderkey % 23 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS survey_date,
    CASE WHEN o_orderkey % 6 > 0 THEN (o_orderkey % 6)::INT END AS product_rating, (o_orderkey % 5 + 1)::INT AS service_rating,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 ELSE 3 END::INT AS satisfaction_ordinal,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'Area ' || (o_orderkey % 4) END AS improvement_area,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'priority ' || o_orderpriority END AS comments FROM orders),
records AS (SELECT *, ['Very Dissatisfied', 'Dissatisfied', 'Neutral', 'Satisfied', 'Very Satisfied'][satisfaction_ordinal] AS overall_satisfaction,
    satisfaction_ordinal - CASE WHEN product_rating IS NULL THEN service_rating ELSE (product_rating + service_rating) / 2.0::DOUBLE END AS rating_satisfaction_gap,
    comments IS NOT NULL AS has_comment, customer_id IS NOT NULL AND survey_date IS NOT NULL AND product_rating IS NOT NULL AS admissible,
    list_filter([CASE WHEN customer_id IS NULL THEN 'customer_id_present' END, CASE WHEN survey_date IS NULL THEN 'survey_date_valid' END,
        CASE WHEN product_rating IS NULL THEN 'product_rating_in_1_5' END], lambda x: x IS NOT NULL) AS fatal,
    list_filter([CASE WHEN product_id IS NULL THEN 'product_id_present' END, CASE WHEN comments IS NULL THEN 'comments_present' END,
        CASE WHEN improvement_area IS NULL THEN 'improvement_area_present' END], lambda x: x IS NOT NULL) AS advisory FROM raw)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    start = (F.col("turn") * 10).cast("string")
    return c.select(F.col("conv_id").alias("call_id"), F.col("turn").alias("pos"), F.concat(F.lit("spk_"), (F.floor(F.col("turn") / 2) % 2).cast("string")).alias("speaker"), "text", start.alias("start_time"), (F.col("turn") * 10 + 9).cast("string").alias("end_time"))


SEGMENTS = r"""segments AS (SELECT conv_id AS call_id, turn AS pos, 'spk_' || ((turn // 2) % 2) AS speaker,
    regexp_replace(text, '^\s+|\s+$', '', 'g') AS text, turn * 10 AS s, turn * 10 + 9 AS e FROM conversations),
kept AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY call_id ORDER BY pos) THEN 0 ELSE 1 END AS change FROM segments WHERE text <> ''),
islands AS (SELECT *, (sum(change) OVER (PARTITION BY call_id ORDER BY pos) - 1)::INT AS turn FROM kept),
turns AS (SELECT call_id, turn, any_value(speaker) AS speaker, min(s)::DOUBLE AS start_time, max(e)::DOUBLE AS end_time,
    string_agg(text, ' ' ORDER BY pos) AS text FROM islands GROUP BY call_id, turn),
speakers AS (SELECT call_id, speaker, min(turn) AS f FROM turns GROUP BY ALL),
roles AS (SELECT call_id, speaker, CASE WHEN n <> 2 THEN 'unknown' WHEN r = 1 THEN 'agent' ELSE 'customer' END AS role_guess,
    CASE WHEN n = 2 THEN 'first_speaker' ELSE 'not_inferred:speaker_count=' || n END AS role_method
    FROM (SELECT *, count(*) OVER (PARTITION BY call_id) AS n, row_number() OVER (PARTITION BY call_id ORDER BY f) AS r FROM speakers)),
named AS (SELECT t.*, role_guess FROM turns t JOIN roles USING (call_id, speaker))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's visible pieces are lines; its words "key: value" of url and size make a graph of a pair each."""
    p = table(spark, sf_dir, "pages")
    key = F.concat(F.lit("page_"), F.col("page_id").cast("string"))
    pieces = F.filter(F.transform(F.split("html", "<[^>]*>"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    none = F.array().cast("array<string>")
    links = "array<struct<Type:string,Ids:array<string>>>"
    block = lambda id_, kind, text, kinds, related: F.struct(id_.alias("Id"), F.lit(kind).alias("BlockType"), text.cast("string").alias("Text"), kinds.alias("EntityTypes"), related.cast(links).alias("Relationships"))
    rel = lambda kind, *ids: F.struct(F.lit(kind).alias("Type"), F.array(*map(F.lit, ids)).alias("Ids"))
    null, nothing = F.lit(None), F.array()
    lines = F.transform(pieces, lambda t, i: block(F.concat(F.lit("l"), i.cast("string")), "LINE", t, none, nothing))
    graph = F.array(
        block(F.lit("k1"), "KEY_VALUE_SET", null, F.array(F.lit("KEY")), F.array(rel("CHILD", "w1", "w2"), rel("VALUE", "v1"))),
        block(F.lit("v1"), "KEY_VALUE_SET", null, F.array(F.lit("VALUE")), F.array(rel("CHILD", "w3"))),
        block(F.lit("w1"), "WORD", F.lit("Page"), none, nothing),
        block(F.lit("w2"), "WORD", F.lit("url:"), none, nothing),
        block(F.lit("w3"), "WORD", F.col("url"), none, nothing),
        block(F.lit("k2"), "KEY_VALUE_SET", null, F.array(F.lit("KEY")), F.array(rel("CHILD", "w4"), rel("VALUE", "missing"))),
        block(F.lit("w4"), "WORD", F.lit("Size:"), none, nothing),
    )
    return p.select(key.alias("image_key"), F.posexplode(F.concat(lines, graph)).alias("pos", "b")).select("image_key", "pos", "b.*")


LINES = r"""lines AS (SELECT 'page_' || page_id AS image_key, i, trimmed AS text FROM (SELECT page_id, unnest(ls) AS trimmed, generate_subscripts(ls, 1) AS i FROM
    (SELECT page_id, list_filter(list_transform(regexp_split_to_array(html, '<[^>]*>'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ls FROM pages)))"""


def processed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted reviews as a provider would return them; labels take the place of its sentiment."""
    from ..operators.checks import gate, validate_reviews

    admitted = gate(validate_reviews(reviews(spark, sf_dir)))
    label = F.element_at(F.array(*map(F.lit, ("POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED"))), (F.col("doc_id") % 4 + 1).cast("int"))
    scores = F.create_map(F.lit("Positive"), F.lit(0.7), F.lit("Negative"), F.lit(0.65), F.lit("Neutral"), F.lit(0.55), F.lit("Mixed"), F.lit(0.45))
    return admitted.select(F.concat(F.lit("processed-data/reviews/"), F.col("file_name"), F.lit("_processed.json")).alias("source_key"), F.col("review_text").alias("original_text"), label.alias("sentiment"), scores.alias("sentiment_scores"), F.struct("product_id", "customer_id", "review_date", "rating").alias("metadata"))


REVIEW_DOCS = r"""review_docs AS (SELECT 'review:' || file_name AS doc_id, 'review' AS source_type, product_id, regexp_replace(review_text, '^\s+|\s+$', '', 'g') AS text,
    ['POSITIVE', 'NEGATIVE', 'NEUTRAL', 'MIXED'][doc_id % 4 + 1] AS sentiment, [0.7, 0.65, 0.55, 0.45][doc_id % 4 + 1]::DOUBLE AS sentiment_confidence,
    rating, NULL::DOUBLE AS rating_satisfaction_gap, true AS admissible, NULL::VARCHAR[] AS fatal, NULL::VARCHAR[] AS advisory FROM scored WHERE admissible)"""
SURVEY_DOCS = """survey_docs AS (SELECT 'survey:row_' || row_number AS doc_id, 'survey' AS source_type, product_id, coalesce(comments, '') AS text,
    overall_satisfaction AS sentiment, NULL::DOUBLE AS sentiment_confidence, product_rating AS rating, rating_satisfaction_gap, admissible, fatal, advisory FROM records)"""
IMAGE_DOCS = """image_docs AS (SELECT 'image:' || image_key AS doc_id, 'image' AS source_type, NULL::VARCHAR AS product_id, string_agg(text, chr(10) ORDER BY i) AS text,
    NULL::VARCHAR AS sentiment, NULL::DOUBLE AS sentiment_confidence, NULL::INT AS rating, NULL::DOUBLE AS rating_satisfaction_gap, true AS admissible, NULL::VARCHAR[] AS fatal, NULL::VARCHAR[] AS advisory FROM lines GROUP BY image_key)"""
CALL_DOCS = """call_docs AS (SELECT 'call:call_' || call_id AS doc_id, 'call' AS source_type, NULL::VARCHAR AS product_id, string_agg(role_guess || ': ' || text, chr(10) ORDER BY turn) AS text,
    CASE WHEN call_id % 3 > 0 THEN ['POSITIVE', 'NEGATIVE'][call_id % 3] END AS sentiment, CASE WHEN call_id % 3 > 0 THEN 0.625::DOUBLE END AS sentiment_confidence, NULL::INT AS rating,
    NULL::DOUBLE AS rating_satisfaction_gap, call_id % 5 <> 0 AS admissible, NULL::VARCHAR[] AS fatal, NULL::VARCHAR[] AS advisory FROM named GROUP BY call_id)"""
DOCS = ", ".join((REVIEWS, SURVEYS, LINES, SEGMENTS, REVIEW_DOCS, SURVEY_DOCS, IMAGE_DOCS, CALL_DOCS)) + ", docs AS (SELECT * FROM review_docs UNION ALL SELECT * FROM survey_docs UNION ALL SELECT * FROM image_docs UNION ALL SELECT * FROM call_docs)"


def processed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records of calls that were transcribed, some of them failed, some without a sentiment."""
    from ..operators import calls

    turns = calls.merge_turns(segments(spark, sf_dir))
    said = turns.groupBy("call_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.struct("speaker", "start_time", "end_time", "text").alias("own")))), lambda t: t["own"]).alias("turns"))
    who = calls.infer_roles(turns).groupBy("call_id").agg(F.map_from_entries(F.collect_list(F.struct("speaker", F.struct("role_guess", "role_method").alias("role")))).alias("speakers"))
    label = F.when(F.col("call_id") % 3 == 1, "POSITIVE").when(F.col("call_id") % 3 == 2, "NEGATIVE")
    scores = F.create_map(F.lit("Positive"), F.lit(0.625), F.lit("Negative"), F.lit(0.625))
    own = F.when(label.isNotNull(), F.struct(label.alias("sentiment"), scores.alias("scores"), F.lit(False).alias("truncated")))
    name = F.concat(F.lit("call_"), F.col("call_id").cast("string"))
    return said.join(who, "call_id").select(
        F.concat(F.lit("processed-data/calls/"), name, F.lit("_processed.json")).alias("source_key"), F.concat(F.lit("raw-data/calls/"), name, F.lit(".mp3")).alias("source_audio"),
        F.when(F.col("call_id") % 5 == 0, "FAILED").otherwise("COMPLETED").alias("status"), "turns", "speakers", F.create_map(F.lit("customer_overall"), own).alias("sentiment"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews, surveys, calls and images in one shape."""
    from ..operators import documents as d
    from ..operators.images import lines
    from ..operators.surveys import survey_records
    from ..functions.text import image_ids

    told = lines(blocks(spark, sf_dir)).select(F.concat(F.lit("processed-data/images/"), F.col("image_key")).alias("source_key"), "image_key", "full_text", image_ids(F.col("image_key")).alias("metadata"))
    return d.unified(d.from_reviews(processed_reviews(spark, sf_dir)), d.from_surveys(survey_records(surveys(spark, sf_dir))), d.from_calls(processed_calls(spark, sf_dir)), d.from_images(told))
