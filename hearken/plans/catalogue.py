"""The queries of the engine's own operators over the driver's tables, each beside the SQL that tells the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import calls, checks, documents, images, insight, metrics, providers, quality_rules, redaction, review, surveys
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def joined(array) -> Column:
    return F.array_join(array, ",")


# --- surveys

SURVEY_FIELDS = "row_number::BIGINT AS row_number, customer_id, product_id, survey_date, product_rating, service_rating, overall_satisfaction, satisfaction_ordinal, rating_satisfaction_gap, improvement_area, comments, has_comment, admissible"


def _records(spark, sf):
    return surveys.survey_records(A.surveys(spark, sf))


@query(f"WITH {A.SURVEYS} SELECT {SURVEY_FIELDS}, array_to_string(list_concat(fatal, advisory), ',') AS issues FROM records")
def survey_records(spark, sf):
    return _records(spark, sf).withColumns({"issues": F.array_join("issues.check", ","), "row_number": F.col("row_number").cast("long")}).drop("source_key")


SUMMARY = f"""WITH {A.SURVEYS} SELECT count(*) AS rows_read, count(*) FILTER (admissible) AS admissible, count(*) FILTER (NOT admissible) AS rejected,
    round_even(count(*) FILTER (admissible)::DOUBLE / count(*), 3) AS admission_rate, round_even(avg(product_rating) FILTER (admissible), 2) AS mean_product_rating,
    round_even(avg(service_rating) FILTER (admissible), 2) AS mean_service_rating, round_even(avg(satisfaction_ordinal) FILTER (admissible), 2) AS mean_satisfaction_ordinal,
    count(*) FILTER (admissible AND has_comment) AS with_comment FROM records"""


@query(SUMMARY)
def survey_summary(spark, sf):
    return surveys.survey_summary(_records(spark, sf))


@query(f"WITH {A.SURVEYS} SELECT improvement_area, count(*) AS n FROM records WHERE admissible AND improvement_area IS NOT NULL GROUP BY ALL")
def survey_improvement_counts(spark, sf):
    return surveys.improvement_counts(_records(spark, sf))


@query(f'WITH {A.SURVEYS} SELECT "check", count(*) AS n FROM (SELECT unnest(list_concat(fatal, advisory)) AS "check" FROM records) GROUP BY ALL')
def survey_issue_counts(spark, sf):
    return surveys.issue_counts(_records(spark, sf))


@query("SELECT o_orderkey, CASE WHEN m < 1.5 THEN 'Very Dissatisfied' WHEN m < 2.5 THEN 'Dissatisfied' WHEN m < 3.5 THEN 'Neutral' WHEN m < 4.5 THEN 'Satisfied' ELSE 'Very Satisfied' END AS label FROM (SELECT o_orderkey, (o_orderkey % 5 + 1 + o_orderkey % 4 + 1) / 2.0 AS m FROM orders)")
def satisfaction_bucket(spark, sf):
    o = A.table(spark, sf, "orders")
    return o.select("o_orderkey", V.satisfaction_for(F.col("o_orderkey") % 5 + 1, F.col("o_orderkey") % 4 + 1).alias("label"))


# --- reviews

CHECKS = "has_review_text, has_product_id, has_customer_id, has_rating, has_review_date, min_length, rating_in_range, valid_date_format"


def _verdicts(spark, sf):
    return checks.validate_reviews(A.reviews(spark, sf))


@query(f"WITH {A.REVIEWS} SELECT file_name, {CHECKS}, quality_score, admissible FROM scored")
def review_checks(spark, sf):
    v = _verdicts(spark, sf)
    return v.select("file_name", *(F.col("checks")[c].alias(c) for c in CHECKS.split(", ")), "quality_score", "admissible")


@query(f"""WITH {A.REVIEWS} SELECT file_name, array_to_string(list_filter([CASE WHEN NOT has_review_text THEN 'has_review_text' END, CASE WHEN NOT has_product_id THEN 'has_product_id' END,
    CASE WHEN NOT min_length THEN 'min_length' END, CASE WHEN NOT rating_in_range THEN 'rating_in_range' END], lambda x: x IS NOT NULL), ',') AS fatal,
    array_to_string(list_filter([CASE WHEN NOT has_customer_id THEN 'has_customer_id' END, CASE WHEN NOT valid_date_format THEN 'valid_date_format' END], lambda x: x IS NOT NULL), ',') AS advisory FROM scored""")
def review_failures(spark, sf):
    return _verdicts(spark, sf).select("file_name", joined("fatal_failures").alias("fatal"), joined("advisory_failures").alias("advisory"))


@query(f"WITH {A.REVIEWS} SELECT admissible, count(*) AS n, avg(quality_score) AS mean_score FROM scored GROUP BY ALL")
def review_admission(spark, sf):
    return _verdicts(spark, sf).groupBy("admissible").agg(F.count("*").alias("n"), F.avg("quality_score").alias("mean_score"))


@query(f"WITH {A.REVIEWS} SELECT quality_score, count(*) AS n FROM scored GROUP BY ALL")
def review_score_distribution(spark, sf):
    return _verdicts(spark, sf).groupBy("quality_score").agg(F.count("*").alias("n"))


@query(f"WITH {A.REVIEWS} SELECT file_name, product_id, rating FROM scored WHERE admissible AND review_text <> ''")
def review_gate_join(spark, sf):
    return checks.admitted_reviews(_verdicts(spark, sf), A.reviews(spark, sf)).select("file_name", "product_id", "rating")


@query(f"WITH {A.REVIEWS} SELECT r.doc_id FROM reviews r JOIN scored s USING (doc_id) WHERE s.admissible AND r.doc_id % 3 <> 0")
def fail_closed_gate(spark, sf):
    known = _verdicts(spark, sf).where("doc_id % 3 <> 0").select("doc_id", "admissible")
    return checks.gate(A.reviews(spark, sf).select("doc_id").join(known, "doc_id", "left")).select("doc_id")


# --- text functions

@query("""WITH c AS (SELECT doc_id, i, substr(t, i, 1) AS ch FROM (SELECT doc_id, left(text, 5000) AS t, unnest(range(1, length(left(text, 5000)) + 1)) AS i FROM documents WHERE strlen(text) > 5000)),
    kept AS (SELECT doc_id, string_agg(ch, '' ORDER BY i) AS t FROM (SELECT *, sum(strlen(ch)) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM c) WHERE b <= 5000 GROUP BY doc_id)
    SELECT doc_id, strlen(coalesce(k.t, d.text))::BIGINT AS bytes, md5(coalesce(k.t, d.text)) AS digest FROM documents d LEFT JOIN kept k USING (doc_id)""")
def byte_truncate(spark, sf):
    d = A.table(spark, sf, "documents")
    cut = T.truncate_bytes(F.col("text"))
    return d.select("doc_id", F.octet_length(cut).cast("long").alias("bytes"), F.md5(cut).alias("digest"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ORD-' || (doc_id + 1000) WHEN 1 THEN 'ORD-' || (doc_id + 500) WHEN 2 THEN 'ORD-' || (doc_id + 100) END AS order_ref FROM documents")
def order_ref_extract(spark, sf):
    d = A.table(spark, sf, "documents")
    n = lambda k: (F.col("doc_id") + k).cast("string")
    said = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Order #ORD-"), n(1000))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("about order number "), n(500))).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("ord "), n(100), F.lit(" then order 77777"))).otherwise("no order 12")
    return d.select("doc_id", T.order_ref(said).alias("order_ref"))


@query("SELECT page_id, 'page-' || page_id AS stem, 'raw-data/images/page-' || page_id || '.v2.PNG' AS key, 'png' AS extension, 'processed-data/images/page-' || page_id || '.v2_processed.json' AS processed_key FROM pages")
def stem_keys(spark, sf):
    p = A.table(spark, sf, "pages")
    name = F.concat(F.lit("page-"), F.col("page_id").cast("string"))
    key = F.concat(F.lit("raw-data/images/"), name, F.lit(".v2.PNG"))
    return p.select("page_id", T.stem(F.concat(F.lit("a.b/"), name, F.lit(".html"))).alias("stem"), key.alias("key"), T.extension(key).alias("extension"), T.image_to_processed_key(key).alias("processed_key"))


@query("SELECT event_id, 'feedback-my-call--' || event_id || '--' || strftime(ts, '%Y%m%dT%H%M%S') AS job_name, CASE WHEN event_id % 3 > 0 THEN (CASE event_id % 3 WHEN 1 THEN 'mp3' ELSE 'wav' END) END AS format FROM events")
def job_names(spark, sf):
    e = A.table(spark, sf, "events")
    ext = F.element_at(F.array(F.lit("txt"), F.lit("MP3"), F.lit("wav")), (F.col("event_id") % 3 + 1).cast("int"))
    key = F.concat(F.lit("raw-data/calls/my call #"), F.col("event_id").cast("string"), F.lit("!."), ext)
    return e.select("event_id", T.job_name(key, F.col("ts")).alias("job_name"), T.media_format(key).alias("format"))


@query("SELECT event_id, 'my_bucket' AS bucket, 'calls/a+b ' || event_id || '.mp3' AS key FROM events")
def s3_uri_parse(spark, sf):
    e = A.table(spark, sf, "events")
    path = F.concat(F.lit("calls/a+b%20"), F.col("event_id").cast("string"), F.lit(".mp3"))
    uri = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("s3://my_bucket/"), path)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("https://s3.us-east-1.amazonaws.com/my_bucket/"), path)).otherwise(F.concat(F.lit("https://my_bucket.s3.us-east-1.amazonaws.com/"), path))
    return e.select("event_id", T.object_address(uri).alias("a")).select("event_id", "a.*")


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'PRD-' || page_id ELSE '' END AS product_id, CASE WHEN page_id % 2 = 0 THEN 'CUST-' || (page_id + 7) ELSE '' END AS customer_id FROM pages")
def image_name_ids(spark, sf):
    p, n = A.table(spark, sf, "pages"), F.col("page_id").cast("string")
    key = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("raw-data/images/PRD-"), n, F.lit("_CUST-"), (F.col("page_id") + 7).cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("raw-data/images/photo "), n, F.lit(".jpg")))
    return p.select("page_id", T.image_ids(key).alias("i")).select("page_id", "i.*")


@query("SELECT event_id, 'raw-data/calls/a b&' || event_id || '+é.mp3' AS key FROM events")
def event_keys(spark, sf):
    e = A.table(spark, sf, "events")
    return e.select("event_id", T.decode_event_key(F.concat(F.lit("raw-data/calls/a+b%26"), F.col("event_id").cast("string"), F.lit("%2B%C3%A9.mp3"))).alias("key"))


@query("SELECT event_id, 'part ' || event_id || CASE WHEN event_id % 2 = 0 THEN ' and more' ELSE '' END AS text FROM events")
def content_blocks(spark, sf):
    e = A.table(spark, sf, "events")
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"))
    blocks = F.array(block("text", F.concat(F.lit("part "), F.col("event_id").cast("string"))), block("tool", F.lit(None)), block("text", F.when(F.col("event_id") % 2 == 0, " and more")))
    return e.select("event_id", V.content_text(blocks).alias("text"))


@query("SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1)::INT AS row_number FROM orders")
def row_numbers(spark, sf):
    return surveys.numbered(A.table(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_recover(spark, sf):
    e = A.table(spark, sf, "events")
    reply = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("Sure, here it is: "), F.col("props"), F.lit(" Anything else?")))
    return e.select("event_id", F.variant_get(V.recovered_json(reply), "$.k", "bigint").alias("k"))


# --- calls

def _turns(spark, sf):
    return calls.merge_turns(A.segments(spark, sf))


def _named(spark, sf):
    return calls.named_turns(_turns(spark, sf))


@query(f"WITH {A.SEGMENTS} SELECT call_id, turn, speaker, start_time, end_time, text FROM turns")
def turn_merge(spark, sf):
    return _turns(spark, sf)


@query(f"WITH {A.SEGMENTS} SELECT * FROM roles")
def role_inference(spark, sf):
    return calls.infer_roles(_turns(spark, sf))


@query(f"WITH {A.SEGMENTS} SELECT call_id, max(turn) AS turn, arg_max(text, turn) AS text FROM named WHERE role_guess = 'customer' GROUP BY call_id")
def last_customer_turn(spark, sf):
    return calls.last_customer_turn(_named(spark, sf))


@query(f"WITH {A.SEGMENTS} SELECT call_id, string_agg(role_guess || ': ' || text, chr(10) ORDER BY turn) AS text FROM named GROUP BY call_id")
def dialogue_render(spark, sf):
    return calls.render_dialogue(_named(spark, sf))


@query("SELECT conv_id AS call_id, turn AS item, (turn // 3)::INT AS batch, (turn % 3)::INT AS index FROM conversations")
def turn_batches(spark, sf):
    c = A.table(spark, sf, "conversations")
    return calls.batched(c.select(F.col("conv_id").alias("call_id"), F.col("turn").alias("item")), 3)


PACKED = f"""WITH RECURSIVE {A.SEGMENTS}, slots AS (SELECT call_id, 'customer_all' AS slot, text, turn FROM named WHERE role_guess = 'customer' UNION ALL
      SELECT call_id, 'agent_all', text, turn FROM named WHERE role_guess = 'agent' UNION ALL
      SELECT call_id, 'customer_end', arg_max(text, turn), max(turn) FROM named WHERE role_guess = 'customer' GROUP BY call_id),
    items AS (SELECT *, row_number() OVER (PARTITION BY call_id, slot ORDER BY turn) AS i, strlen(text) AS b FROM slots),
    packed AS (SELECT call_id, slot, i, b AS size, 0 AS part, b > 5000 AS cut FROM items WHERE i = 1 UNION ALL
      SELECT n.call_id, n.slot, n.i, CASE WHEN NOT p.cut AND n.b <= 5000 AND p.size + 1 + n.b <= 5000 THEN p.size + 1 + n.b ELSE n.b END,
             CASE WHEN NOT p.cut AND n.b <= 5000 AND p.size + 1 + n.b <= 5000 THEN p.part ELSE p.part + 1 END, n.b > 5000
      FROM packed p JOIN items n ON n.call_id = p.call_id AND n.slot = p.slot AND n.i = p.i + 1)"""


@query(f"{PACKED} SELECT call_id, slot, part::INT AS part, count(*)::INT AS n_turns, bool_or(cut) AS truncated FROM packed GROUP BY ALL")
def slot_docs(spark, sf):
    return calls.slot_documents(_named(spark, sf)).select("call_id", "slot", "part", "n_turns", "truncated")


@query(f"""WITH RECURSIVE {A.SEGMENTS}, items AS (SELECT call_id, text, row_number() OVER (PARTITION BY call_id ORDER BY turn) AS i FROM turns),
    packed AS (SELECT call_id, i, text AS t, 1 AS n, 0 AS part FROM items WHERE i = 1 UNION ALL
      SELECT x.call_id, x.i, CASE WHEN strlen(p.t) + 1 + strlen(x.text) <= 600 THEN p.t || ' ' || x.text ELSE x.text END,
             CASE WHEN strlen(p.t) + 1 + strlen(x.text) <= 600 THEN p.n + 1 ELSE 1 END, CASE WHEN strlen(p.t) + 1 + strlen(x.text) <= 600 THEN p.part ELSE p.part + 1 END
      FROM packed p JOIN items x ON x.call_id = p.call_id AND x.i = p.i + 1)
    SELECT call_id, part::INT AS part, left(arg_max(t, i), list_max(list_filter(range(1, 601), lambda n: strlen(left(arg_max(t, i), n)) <= 600))) AS text, max(n)::INT AS n_turns, max(strlen(t)) > 600 AS truncated FROM packed GROUP BY call_id, part""")
def pack_turns(spark, sf):
    said = _turns(spark, sf).groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    packed = calls.pack_turns(F.transform("t", lambda x: x["text"]), 600)
    return said.select("call_id", F.posexplode(packed).alias("part", "c")).select("call_id", "part", "c.*")


def _scored(spark, sf):
    items = calls.batched(calls.slot_documents(_named(spark, sf)), 2)
    answer = items.where("index = 0 or item % 5 > 0").select("call_id", "batch", "index", F.lit("POSITIVE").alias("sentiment"), F.create_map(*(x for k, v in zip(calls.SCORE_KEYS, (0.5, 0.25, 0.125, 0.125), strict=True) for x in (F.lit(k), F.lit(v) + F.col("item") % 2 * (0.25 if k == "Negative" else -0.25 if k == "Positive" else 0)))).alias("sentiment_scores"))
    failed = items.where("not (index = 0 or item % 5 > 0)").select("call_id", "batch", "index", F.lit("INTERNAL_SERVER_ERROR").alias("error"))
    return calls.apply_results(items, answer, failed)


ITEMS = f"""{PACKED}, docs0 AS (SELECT call_id, slot, part, count(*)::INT AS n_turns, bool_or(cut) AS truncated, max(least(size, 5000)) AS bytes FROM packed GROUP BY ALL),
    items2 AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY CASE slot WHEN 'customer_all' THEN 0 WHEN 'agent_all' THEN 1 ELSE 2 END, part) - 1 AS item FROM docs0),
    answered AS (SELECT *, item % 2 = 0 OR item % 5 > 0 AS ok FROM items2)"""


@query(f"{ITEMS} SELECT call_id, item::INT AS item, CASE WHEN ok THEN 'POSITIVE' END AS sentiment, CASE WHEN NOT ok THEN 'INTERNAL_SERVER_ERROR' END AS sentiment_error FROM answered")
def batch_result_join(spark, sf):
    return _scored(spark, sf).select("call_id", "item", "sentiment", "sentiment_error")


@query(f"""{ITEMS}, per AS (SELECT call_id, slot, count(*)::INT AS parts, count(*) FILTER (ok)::INT AS parts_scored, sum(n_turns) FILTER (ok)::INT AS turns_used, bool_or(truncated) AS truncated,
      sum((0.5 - 0.25 * (item % 2)) * bytes) FILTER (ok)::DOUBLE / sum(bytes) FILTER (ok) AS pos, sum((0.25 + 0.25 * (item % 2)) * bytes) FILTER (ok)::DOUBLE / sum(bytes) FILTER (ok) AS neg FROM answered GROUP BY ALL),
    every AS (SELECT DISTINCT call_id, unnest(['customer_all', 'agent_all', 'customer_end']) AS slot FROM segments)
    SELECT call_id, CASE e.slot WHEN 'customer_all' THEN 'customer_overall' WHEN 'agent_all' THEN 'agent_overall' ELSE 'customer_end_state' END AS slot,
      CASE WHEN parts_scored > 0 THEN CASE WHEN pos >= neg THEN 'POSITIVE' ELSE 'NEGATIVE' END END AS sentiment, CASE WHEN parts_scored > 0 THEN parts END AS parts,
      CASE WHEN parts_scored > 0 THEN parts_scored END AS parts_scored, CASE WHEN parts_scored > 0 THEN turns_used END AS turns_used, CASE WHEN parts_scored > 0 THEN truncated END AS truncated,
      CASE WHEN parts_scored > 0 THEN round(pos, 9) END AS positive, CASE WHEN parts_scored > 0 THEN round(neg, 9) END AS negative,
      CASE WHEN parts IS NULL THEN 'no_text_for_role' WHEN parts_scored = 0 THEN 'comprehend_error' END AS reason FROM every e LEFT JOIN per p USING (call_id, slot)""")
def slot_sentiment_summary(spark, sf):
    told = calls.slot_summary(_scored(spark, sf), A.segments(spark, sf))
    return told.withColumns({"positive": F.round(F.col("scores")["Positive"], 9), "negative": F.round(F.col("scores")["Negative"], 9)}).drop("scores", "method")


@query(f"""WITH {A.SEGMENTS}, a AS (SELECT call_id, 'a' AS design, sum(greatest(300, length(text)))::BIGINT AS units FROM named GROUP BY call_id),
    b AS (SELECT call_id, 'b' AS design, (coalesce(CASE WHEN max(cl) IS NOT NULL THEN greatest(300, max(cl)) END, 0) + coalesce(CASE WHEN max(al) IS NOT NULL THEN greatest(300, max(al)) END, 0)
      + coalesce(CASE WHEN max(el) IS NOT NULL THEN greatest(300, max(el)) END, 0))::BIGINT AS units FROM (SELECT call_id,
        length(string_agg(text, ' ' ORDER BY turn) FILTER (role_guess = 'customer')) AS cl, length(string_agg(text, ' ' ORDER BY turn) FILTER (role_guess = 'agent')) AS al,
        length(arg_max(text, turn) FILTER (role_guess = 'customer')) AS el FROM named GROUP BY call_id) GROUP BY call_id)
    SELECT * FROM a UNION ALL SELECT * FROM b""")
def billed_units(spark, sf):
    return calls.billed_units(calls.request_designs(_named(spark, sf)))


# --- images

@query(f"WITH {A.LINES} SELECT image_key, count(*) AS n_lines, string_agg(text, chr(10) ORDER BY i) AS full_text FROM lines GROUP BY image_key")
def block_lines(spark, sf):
    return images.lines(A.blocks(spark, sf)).select("image_key", F.size("lines").cast("long").alias("n_lines"), "full_text")


@query("SELECT 'page_' || page_id AS image_key, 'Page url' AS key, coalesce(url, '') AS value FROM pages UNION ALL SELECT 'page_' || page_id, 'Size', '' FROM pages")
def block_key_values(spark, sf):
    return images.key_values(A.blocks(spark, sf))


@query(f"WITH {A.LINES} SELECT image_key, 'LINE' AS BlockType, count(*) AS n FROM lines GROUP BY image_key UNION ALL SELECT 'page_' || page_id, 'KEY_VALUE_SET', 3 FROM pages UNION ALL SELECT 'page_' || page_id, 'WORD', 4 FROM pages")
def block_counts(spark, sf):
    return images.block_counts(A.blocks(spark, sf))


# --- documents

@query(f"WITH {A.DOCS} SELECT doc_id, source_type, product_id, text, sentiment, sentiment_confidence, rating, rating_satisfaction_gap, admissible FROM docs")
def feedback_documents(spark, sf):
    return A.documents(spark, sf).select("doc_id", "source_type", "product_id", "text", "signals.sentiment", "signals.sentiment_confidence", "signals.rating", "signals.rating_satisfaction_gap", "provenance.admissible")


@query(f"WITH {A.DOCS} SELECT doc_id, source_type FROM docs WHERE admissible AND text <> ''")
def admissible_batch(spark, sf):
    return documents.admissible_batch(A.documents(spark, sf)).select("doc_id", "source_type")


@query(f"WITH {A.DOCS} SELECT count(*) AS documents_total, count(*) FILTER (admissible AND text <> '') AS documents_sent, count(*) FILTER (NOT (admissible AND text <> '')) AS excluded, count(*) FILTER (source_type = 'review') AS reviews, count(*) FILTER (source_type = 'survey') AS surveys, count(*) FILTER (source_type = 'call') AS calls, count(*) FILTER (source_type = 'image') AS images FROM docs")
def manifest(spark, sf):
    m = documents.manifest(A.documents(spark, sf))
    return m.select("documents_total", "documents_sent", "excluded", *(F.col("by_source")[k].alias(k + "s") for k in ("review", "survey", "call", "image")))


def _channels(spark, sf):
    d = A.table(spark, sf, "documents")
    ref = F.concat(F.lit("order "), (F.floor(F.col("doc_id") / 2) + 1000).cast("string"))
    text = F.when(F.col("doc_id") % 3 == 2, F.concat(F.lit("the Item "), (F.col("doc_id") % 7).cast("string"), F.lit(" broke"))).otherwise(ref)
    kind = F.when(F.col("doc_id") % 2 == 0, "call").otherwise("image")
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), kind.alias("source_type"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("PRD-"), (F.col("doc_id") % 50).cast("string"))).alias("product_id"), T.order_ref(text).alias("order_ref"), text.alias("text"))


CHANNELS = """channels AS (SELECT doc_id::VARCHAR AS doc_id, CASE WHEN doc_id % 2 = 0 THEN 'call' ELSE 'image' END AS source_type, CASE WHEN doc_id % 5 = 0 THEN 'PRD-' || (doc_id % 50) END AS product_id,
    CASE WHEN doc_id % 3 <> 2 THEN 'ORD-' || (doc_id // 2 + 1000) END AS order_ref, CASE WHEN doc_id % 3 = 2 THEN doc_id % 7 END AS item FROM documents)"""


@query(f"WITH {CHANNELS} SELECT order_ref, a.doc_id AS left_id, b.doc_id AS right_id FROM channels a JOIN channels b USING (order_ref) WHERE a.source_type = 'call' AND b.source_type = 'image'")
def order_ref_join(spark, sf):
    return documents.order_links(_channels(spark, sf))


@query(f"""WITH {CHANNELS}, o AS (SELECT order_ref, min(product_id) AS p FROM channels WHERE order_ref IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL)
    SELECT doc_id, coalesce(product_id, p, CASE WHEN item < 5 THEN 'SKU-' || item END) AS linked_product,
    CASE WHEN product_id IS NOT NULL THEN 'stated_id' WHEN p IS NOT NULL THEN 'order_reference' WHEN item < 5 THEN 'inferred_from_text' ELSE 'none' END AS product_link_basis FROM channels LEFT JOIN o USING (order_ref)""")
def product_link(spark, sf):
    catalogue = spark.createDataFrame([(f"SKU-{i}", f"item {i}") for i in range(5)], "product_id string, name string")
    return documents.link_products(_channels(spark, sf), catalogue)


# --- redaction

def _personal(spark, sf):
    d = A.table(spark, sf, "documents")
    n = F.col("doc_id").cast("string")
    text = F.concat(F.lit("Mail user"), n, F.lit("@mail.example or 555-123-4567 about ABC-"), (F.col("doc_id") % 900 + 100).cast("string"), F.when(F.col("doc_id") % 2 == 0, " and 4111 1111 1111 1111").otherwise(""))
    base = documents.document(d, F.col("doc_id").cast("string"), "review", F.lit("k"), text)
    return redaction.redact_documents(base, providers.pattern_spans)


@query("SELECT doc_id::VARCHAR AS doc_id, 'Mail [EMAIL] or [PHONE] about ABC-' || (doc_id % 900 + 100) || CASE WHEN doc_id % 2 = 0 THEN ' and [CREDIT_DEBIT_NUMBER]' ELSE '' END AS text, CASE WHEN doc_id % 2 = 0 THEN 'CREDIT_DEBIT_NUMBER,EMAIL,PHONE' ELSE 'EMAIL,PHONE' END AS types, 'ABC-' || (doc_id % 900 + 100) AS kept FROM documents")
def pii_redact(spark, sf):
    return _personal(spark, sf).select("doc_id", "text", joined("pii_redacted").alias("types"), joined("pii_allowlisted").alias("kept"))


@query("SELECT 'redacted' AS kind, 'EMAIL' AS name, count(*) AS n FROM documents UNION ALL SELECT 'redacted', 'PHONE', count(*) FROM documents UNION ALL SELECT 'redacted', 'CREDIT_DEBIT_NUMBER', count(*) FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'allowlisted', 'ABC-' || (doc_id % 900 + 100), count(*) FROM documents GROUP BY doc_id % 900")
def pii_tally(spark, sf):
    return redaction.tally(_personal(spark, sf))


@query(r"SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+').len()::BIGINT AS emails FROM documents")
def pii_detect_email(spark, sf):
    d = A.table(spark, sf, "documents")
    spans = providers.pattern_spans(F.col("text"), providers.PII[:1])
    return d.select("doc_id", F.size(spans).cast("long").alias("emails"))


@query("SELECT p_partkey, p_partkey % 4 IN (0, 1, 2) AS safe FROM part")
def safe_identifier_split(spark, sf):
    p, n = A.table(spark, sf, "part"), (F.col("p_partkey") + 1000).cast("string")
    span = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit(" AB-"), F.right(n, F.lit(4)))).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("cust-"), n)).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("Ord-"), n)).otherwise(F.concat(F.lit("ab-"), n))
    return p.select("p_partkey", T.is_safe_identifier(span).alias("safe"))


# The same operators over the texts of documents, whole. SQL has no look-around, so none tells what is redacted;
# tests/test_catalogue.py has a plain version.
def _real(spark, sf):
    d = A.table(spark, sf, "documents")
    base = documents.document(d, F.col("doc_id").cast("string"), "review", F.lit("k"), F.col("text"))
    return redaction.redact_documents(base, providers.pattern_spans, None)


@query()
def pii_redact_documents(spark, sf):
    return _real(spark, sf).select("doc_id", "text", joined("pii_redacted").alias("types"), joined("pii_allowlisted").alias("kept"))


@query()
def pii_tally_documents(spark, sf):
    return redaction.tally(_real(spark, sf))


ORDER_SQL = ", ".join(f"nullif(regexp_extract(coalesce(text, ''), '{p}', 1), '')" for p in T.ORDER_PATTERNS)


@query(f"SELECT doc_id, 'ORD-' || coalesce({ORDER_SQL}) AS order_ref FROM documents")
def order_ref_documents(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", T.order_ref(F.col("text")).alias("order_ref"))


# --- review

@query(f"""WITH {A.DOCS} SELECT doc_id, CASE WHEN sentiment = 'POSITIVE' AND rating <= 2 THEN 4 - rating WHEN sentiment = 'NEGATIVE' AND rating >= 4 THEN rating - 2 ELSE 0 END::INT AS divergence FROM review_docs""")
def rating_sentiment_mismatch(spark, sf):
    d = documents.from_reviews(A.processed_reviews(spark, sf))
    return d.select("doc_id", review.rating_divergence(F.col("signals.sentiment"), F.col("signals.rating")).alias("divergence"))


@query(f"WITH {A.SURVEYS} SELECT row_number, CASE WHEN abs(rating_satisfaction_gap) >= 2 THEN abs(rating_satisfaction_gap) ELSE 0 END::DOUBLE AS divergence FROM records")
def survey_gap_mismatch(spark, sf):
    return _records(spark, sf).select("row_number", review.survey_divergence(F.col("rating_satisfaction_gap")).alias("divergence"))


ROUTED = f"""WITH {A.DOCS}, routed AS (SELECT *, (sentiment = 'POSITIVE' AND rating <= 2) OR (sentiment = 'NEGATIVE' AND rating >= 4) AS apart, abs(rating_satisfaction_gap) >= 2 AS own FROM docs),
    verdicts AS (SELECT *, CASE WHEN NOT admissible THEN 'rejected' WHEN coalesce(apart, false) OR coalesce(own, false) THEN 'review_queue' WHEN sentiment IS NULL AND text <> '' THEN 'escalate_to_fm' ELSE 'auto_accept' END AS route FROM routed)"""


@query(f"{ROUTED} SELECT doc_id, source_type, product_id, route, array_to_string(list_filter([CASE WHEN apart THEN 'sentiment_vs_rating' END, CASE WHEN own THEN 'survey_label_vs_ratings' END], lambda x: x IS NOT NULL), ',') AS flags, left(text, 160) AS text_excerpt FROM verdicts")
def route_documents(spark, sf):
    return review.verdicts(A.documents(spark, sf)).select("doc_id", "source_type", "product_id", "route", F.array_join("flags.rule", ",").alias("flags"), "text_excerpt")


@query(f"{ROUTED} SELECT count(*) AS documents, count(*) FILTER (route = 'rejected') AS rejected, count(*) FILTER (route = 'review_queue') AS review_queue, count(*) FILTER (route = 'escalate_to_fm') AS escalate_to_fm, count(*) FILTER (route = 'auto_accept') AS auto_accept, count(*) FILTER (route IN ('review_queue', 'auto_accept')) AS judged, count(*) FILTER (route = 'review_queue') AS flagged, round_even(count(*) FILTER (route = 'review_queue')::DOUBLE / count(*) FILTER (route IN ('review_queue', 'auto_accept')), 4) AS mismatch_rate FROM verdicts")
def route_summary(spark, sf):
    return review.review_summary(review.verdicts(A.documents(spark, sf)))


@query(f"""{ROUTED} SELECT doc_id, 'sentiment_vs_rating' AS rule, 'text scored ' || sentiment || ' but the customer rated it ' || rating || '/5' AS detail,
      CASE WHEN sentiment = 'POSITIVE' THEN 4 - rating ELSE rating - 2 END::DOUBLE AS divergence FROM verdicts WHERE apart UNION ALL
    SELECT doc_id, 'survey_label_vs_ratings', 'stated satisfaction differs from own ratings by ' || abs(rating_satisfaction_gap) || ' points', abs(rating_satisfaction_gap) FROM verdicts WHERE own""")
def flag_details(spark, sf):
    return review.verdicts(A.documents(spark, sf)).select("doc_id", F.inline("flags"))


@query(f"""WITH {A.DOCS} SELECT doc_id, CASE source_type WHEN 'image' THEN 2 WHEN 'review' THEN 0 WHEN 'call' THEN 1 ELSE 1 + (array_length(fatal) > 0)::INT + (array_length(advisory) > 0)::INT END::INT AS notes,
    CASE WHEN source_type = 'survey' AND array_length(fatal) > 0 THEN 'failed validation: ' || array_to_string(fatal, ', ') END AS failed FROM docs""")
def trust_notes(spark, sf):
    notes = F.col("provenance.trust_notes")
    return A.documents(spark, sf).select("doc_id", F.size(notes).alias("notes"), F.try_element_at(F.filter(notes, lambda n: F.startswith(n, F.lit("failed validation"))), F.lit(1)).alias("failed"))


def _planted(spark, sf):
    labels = A.table(spark, sf, "labels")
    return labels.where("quality = 1 and doc_id % 5 > 0 or doc_id % 7 = 0").select("doc_id"), labels.where("quality = 1").select("doc_id")


PLANTED = "f AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id % 5 > 0 OR doc_id % 7 = 0), p AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1)"


@query(f"WITH {PLANTED}, c AS (SELECT count(p.doc_id) AS planted, count(f.doc_id) AS flagged, count(*) FILTER (p.doc_id IS NOT NULL AND f.doc_id IS NOT NULL) AS tp FROM f FULL JOIN p ON f.doc_id = p.doc_id) SELECT planted, flagged, tp AS true_positives, planted - tp AS missed, flagged - tp AS false_positives, round_even(tp / flagged, 3) AS precision, round_even(tp / planted, 3) AS recall, round_even(2 * (tp / flagged) * (tp / planted) / (tp / flagged + tp / planted), 3) AS f1 FROM c")
def precision_recall_f1(spark, sf):
    return review.truth_score(*_planted(spark, sf))


@query(f"WITH {PLANTED} SELECT coalesce(f.doc_id, p.doc_id) AS doc_id, CASE WHEN f.doc_id IS NULL THEN 'miss' WHEN p.doc_id IS NULL THEN 'other' ELSE 'hit' END AS outcome FROM f FULL JOIN p ON f.doc_id = p.doc_id")
def set_ops_planted(spark, sf):
    return review.truth_sets(*_planted(spark, sf))


# --- insight

def _reports(spark, sf):
    labels = A.table(spark, sf, "labels")
    ids = lambda c: F.array(c.cast("string"))
    typed = "struct<" + insight.REPORT.replace("\n", " ").replace("themes array", "themes:array").replace(" call_outcomes ", " call_outcomes:").replace(" contradictions ", " contradictions:").replace("recommended_actions ", "recommended_actions:").replace("coverage_note string", "coverage_note:string") + ">"
    shown = F.to_json(F.struct(
        F.array(F.struct(F.lit("t").alias("theme"), ids(F.col("doc_id")).alias("doc_ids"))).alias("themes"),
        F.array(F.struct(F.when(F.col("doc_id") % 2 == 0, (F.col("doc_id") * 3).cast("string")).otherwise("").alias("doc_id"))).alias("call_outcomes"),
        F.array(F.struct(ids(F.col("doc_id") + 5).alias("doc_ids"))).alias("contradictions"),
        F.array(F.struct(ids(F.col("doc_id") + 100000).alias("doc_ids"))).alias("recommended_actions"),
    ))
    return labels.select(F.from_json(shown, typed).alias("r")).select("r.*")


@query("WITH c AS (SELECT doc_id FROM labels UNION SELECT doc_id * 3 FROM labels WHERE doc_id % 2 = 0 UNION SELECT doc_id + 5 FROM labels UNION SELECT doc_id + 100000 FROM labels) SELECT doc_id::VARCHAR AS doc_id FROM c ANTI JOIN documents USING (doc_id)")
def hallucinated_citations(spark, sf):
    known = A.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"))
    return insight.hallucinated(insight.cited_ids(_reports(spark, sf)), known)


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'missing key: recommended_actions,missing key: coverage_note,themes[0] missing evidence_strength,themes[0] missing product_link_basis,themes[0] cites no doc_ids' WHEN 1 THEN 'missing key: themes,missing key: call_outcomes,missing key: contradictions,missing key: recommended_actions,missing key: coverage_note' ELSE '' END AS problems FROM events")
def report_validation(spark, sf):
    e = A.table(spark, sf, "events")
    said = F.when(F.col("event_id") % 3 == 0, '{"themes":[{"theme":"x","doc_ids":[]}],"call_outcomes":[],"contradictions":null}').when(F.col("event_id") % 3 == 1, "{}").otherwise('{"themes":[{"theme":"x","doc_ids":["a"],"evidence_strength":"s","product_link_basis":null}],"call_outcomes":[],"contradictions":[],"recommended_actions":[],"coverage_note":""}')
    return e.select("event_id", joined(insight.report_problems(F.parse_json(said))).alias("problems"))


@query("""WITH t AS (SELECT 'Keyword' || doc_id % 2 || ' ' || coalesce(lang, 'none') AS theme, coalesce(lang, 'none') AS channel, (doc_id % 5 + 1)::INT AS docs FROM documents),
    e AS (SELECT 'P' || k AS product_id, 'keyword' || k AS keyword FROM (SELECT unnest([0, 1, 2]) AS k)),
    hits AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY docs DESC, theme DESC) AS r FROM e JOIN t ON contains(lower(theme), keyword))
    SELECT e.product_id, 'issue' AS issue, theme IS NOT NULL AS found, theme, CASE WHEN theme IS NULL THEN '' ELSE array_to_string(list_sort([channel, 'review']), ',') END AS channels, docs
    FROM e LEFT JOIN hits ON hits.product_id = e.product_id AND r = 1""")
def theme_keyword_recall(spark, sf):
    lang = F.coalesce("lang", F.lit("none"))
    name = F.concat(F.lit("Keyword"), (F.col("doc_id") % 2).cast("string"), F.lit(" "), lang)
    ids = F.transform(F.sequence(F.lit(0).cast("long"), F.col("doc_id") % 5), lambda i: (F.col("doc_id") + i).cast("string"))
    themes = A.table(spark, sf, "documents").select(name.alias("theme"), F.lit("q").alias("quote"), F.array(F.lit("review"), lang).alias("channels"), ids.alias("doc_ids"))
    expected = spark.createDataFrame([(f"P{k}", "issue") for k in range(3)], "product_id string, issue string")
    words = spark.createDataFrame([(f"P{k}", f"keyword{k}") for k in range(3)], "product_id string, keyword string")
    told = insight.theme_recall(expected, themes, words)
    return told.select("product_id", "issue", "found", "theme", F.coalesce(joined("channels"), F.lit("")).alias("channels"), "docs")


@query("SELECT p_partkey, p_brand AS product_id FROM part WHERE p_size <= 20 AND p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING min(p_size) > 0 AND p_brand < 'Brand#3')")
def control_semi(spark, sf):
    part = A.table(spark, sf, "part")
    themes = part.select("p_partkey", F.col("p_brand").alias("product_id"), F.when(F.col("p_size") <= 10, "high").when(F.col("p_size") <= 20, "medium").otherwise("low").alias("severity"))
    controls = part.groupBy(F.col("p_brand").alias("product_id")).agg(F.min("p_size").alias("m")).where("m > 0 and product_id < 'Brand#3'")
    return insight.invented_issues(themes, controls).select("p_partkey", "product_id")


@query("SELECT p_partkey FROM part WHERE p_size % 3 = 0")
def uncited_themes(spark, sf):
    part = A.table(spark, sf, "part")
    ids = F.when(F.col("p_size") % 3 == 1, F.array(F.lit("a"))).when(F.col("p_size") % 3 == 2, F.array(F.lit("a"), F.lit("b"))).when(F.col("p_size") % 2 == 0, F.array().cast("array<string>"))
    return insight.uncited_themes(part.select("p_partkey", ids.alias("doc_ids"))).select("p_partkey")


@query("""SELECT count(*) FILTER (quality = 1) AS found, count(*) AS expected, count(*) FILTER (toxic = 1) AS invented, count(*) FILTER (doc_id % 3 = 0) AS hallucinated,
    CASE WHEN count(*) FILTER (quality = 1) = count(*) AND count(*) FILTER (toxic = 1) = 0 AND count(*) FILTER (doc_id % 3 = 0) = 0 THEN 'PASS' ELSE 'REVIEW NEEDED' END AS verdict FROM labels""")
def report_verdict(spark, sf):
    labels = A.table(spark, sf, "labels")
    return insight.verdict(labels.select((F.col("quality") == 1).alias("found")), labels.where("toxic = 1"), labels.where("doc_id % 3 = 0"))


@query(f"""WITH {A.DOCS}, per AS (SELECT product_id, list(doc_id ORDER BY doc_id) FILTER (source_type = 'review' AND rating <= 2) AS ids, count(*) FILTER (source_type = 'survey') AS survey_rows FROM docs GROUP BY ALL)
    SELECT product_id, 'issue ' || product_id AS issue, md5(array_to_string(coalesce(ids, []), ',')) AS review_docs, survey_rows FROM per WHERE product_id IS NOT NULL""")
def expected_themes(spark, sf):
    docs = A.documents(spark, sf).select("doc_id", "source_type", "product_id", F.col("signals.rating").alias("rating"))
    issues = docs.select("product_id").where("product_id is not null").distinct().withColumn("issue", F.concat(F.lit("issue "), F.col("product_id")))
    return insight.expected_themes(docs, issues).select("product_id", "issue", F.md5(joined("review_docs")).alias("review_docs"), "survey_rows")


@query("SELECT coalesce(CASE p_size % 3 WHEN 0 THEN 'stated_id' WHEN 1 THEN 'order_reference' END, 'unset') AS product_link_basis, count(*) AS n FROM part GROUP BY ALL")
def link_basis_histogram(spark, sf):
    part = A.table(spark, sf, "part")
    return insight.link_bases(part.select(F.when(F.col("p_size") % 3 == 0, "stated_id").when(F.col("p_size") % 3 == 1, "order_reference").alias("product_link_basis")))


# --- dataset rules and metrics

RULES = """Rules = [ IsComplete "o_custkey", ColumnLength "o_orderpriority" > 0, ColumnValues "o_orderstatus" in ["F", "O", "P"],
    ColumnValues "o_totalprice" > 1000, ColumnLength "o_orderstatus" = 1, ColumnValues "o_orderpriority" in ["1-URGENT", "2-HIGH"] ]"""
RULE_SQL = """rules AS (SELECT 1 AS rule_no, bool_and(o_custkey IS NOT NULL) AS passed FROM orders UNION ALL SELECT 2, bool_and(coalesce(length(o_orderpriority) > 0, false)) FROM orders
    UNION ALL SELECT 3, bool_and(coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) FROM orders UNION ALL SELECT 4, bool_and(coalesce(o_totalprice > 1000, false)) FROM orders
    UNION ALL SELECT 5, bool_and(coalesce(length(o_orderstatus) = 1, false)) FROM orders UNION ALL SELECT 6, bool_and(coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)) FROM orders)"""


@query(f"WITH {RULE_SQL} SELECT * FROM rules")
def dq_rules(spark, sf):
    return quality_rules.evaluate_rules(A.table(spark, sf, "orders"), quality_rules.parse_rules(RULES)).select("rule_no", "passed")


@query(f"WITH {RULE_SQL} SELECT count(*) AS rules, count(*) FILTER (passed) AS passed, count(*) FILTER (passed) / count(*) AS score FROM rules")
def dq_score(spark, sf):
    return quality_rules.rules_score(quality_rules.evaluate_rules(A.table(spark, sf, "orders"), quality_rules.parse_rules(RULES)))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def metric_hourly_rates(spark, sf):
    e = A.table(spark, sf, "events")
    m = metrics.datum(e, "ns", "value", F.col("value"), F.col("ts"), event_type=F.col("event_type"))
    return metrics.windowed(m).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.get_json_object("tags", "$.event_type").alias("event_type"), "n", F.round("total", 4).alias("total"))


@query("SELECT CASE event_id % 3 WHEN 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status, count(*) AS n FROM events WHERE event_id % 3 < 2 GROUP BY ALL")
def job_status_counts(spark, sf):
    e = A.table(spark, sf, "events")
    status = F.element_at(F.array(F.lit("COMPLETED"), F.lit("FAILED"), F.lit("IN_PROGRESS")), (F.col("event_id") % 3 + 1).cast("int"))
    return metrics.job_metrics(e.select(status.alias("status"), "ts"), F.col("ts")).groupBy(F.col("dims")["Status"].alias("status")).agg(F.count("*").alias("n"))


@query("SELECT 'set_' || k AS ruleset, count(*) AS n, sum(event_id % 5) / 4.0::DOUBLE AS total FROM (SELECT event_id, unnest(range(event_id % 3)) AS k FROM events WHERE event_id % 4 > 0) GROUP BY ALL")
def ruleset_fanout(spark, sf):
    e = A.table(spark, sf, "events")
    names = F.when(F.col("event_id") % 3 > 0, F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3 - 1).cast("int")), lambda k: F.concat(F.lit("set_"), k.cast("string"))))
    detail = F.struct(names.alias("rulesetNames"), F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 5 / 4.0).alias("score"), F.lit("SUCCEEDED").alias("state"))
    m = metrics.ruleset_metrics(e.select(detail.alias("detail"), "ts"), F.col("ts"))
    return m.groupBy(F.col("dims")["Ruleset"].alias("ruleset")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


from . import texts  # noqa: E402, F401  registers its queries
