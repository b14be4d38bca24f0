"""Queries of the operators that learn from texts or look through them whole; registered with those of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..operators import calls, checks, documents, images, insight, providers, quality_rules, sentiment
from . import adapters as A
from .catalogue import RULES, joined, query

# --- sentiment


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as reviews: labels tell whether one is toxic, which takes the place of a rating; others have none."""
    labels = A.table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 5).alias("rating"))
    return A.table(spark, sf, "documents").select("doc_id", F.col("text").alias("review_text")).join(labels, "doc_id", "left")


_NEGATIONS = ", ".join(f"'{w}'" for w in sentiment.NEGATIONS)
_STOPS = ", ".join(f"'{w}'" for w in sentiment.STOPS)


def _turned(back: int) -> str:
    """SQL: a negation `back` tokens before token i, with no stop between."""
    said = f"(t[i - {back}] IN ({_NEGATIONS}) OR ends_with(t[i - {back}], 'n''t'))"
    return " AND ".join([f"i > {back}", said, *(f"t[i - {k}] NOT IN ({_STOPS})" for k in range(1, back))])


_TOKEN = sentiment.TOKEN.replace("'", "''")
WORDS = f"""rated AS (SELECT row_number() OVER () AS r, d.doc_id, text, CASE toxic WHEN 1 THEN -1 WHEN 0 THEN 1 ELSE 0 END AS side
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
    tokens AS (SELECT r, side, regexp_extract_all(lower(coalesce(text, '')), '{_TOKEN}') AS t FROM rated),
    places AS (SELECT r, side, t, unnest(range(1, len(t) + 1)) AS i FROM tokens),
    words AS (SELECT DISTINCT r, side, t[i] AS word, ({") OR (".join(_turned(k) for k in range(1, sentiment.SCOPE + 1))}) AS negated
        FROM places WHERE t[i] NOT IN ({_STOPS}))"""
MODEL = f"""{WORDS},
    counted AS (SELECT word, count(*) FILTER (own = 1) AS praise, count(*) FILTER (own = -1) AS complaint, count(*) AS n
        FROM (SELECT word, CASE WHEN negated THEN -side ELSE side END AS own FROM words) GROUP BY word),
    totals AS (SELECT sum(praise) AS p, sum(complaint) AS c, sum(n) AS m FROM counted),
    weighed AS (SELECT word, praise, complaint, n,
        ln((praise + {sentiment.PRIOR} * n) / (p + {sentiment.PRIOR} * m - praise - {sentiment.PRIOR} * n))
          - ln((complaint + {sentiment.PRIOR} * n) / (c + {sentiment.PRIOR} * m - complaint - {sentiment.PRIOR} * n)) AS log_odds,
        2 * (CASE WHEN praise > 0 THEN praise * ln(praise * (p + c) / ((praise + complaint) * p)) ELSE 0 END
          + CASE WHEN p > praise THEN (p - praise) * ln((p - praise) * (p + c) / ((p + c - praise - complaint) * p)) ELSE 0 END
          + CASE WHEN complaint > 0 THEN complaint * ln(complaint * (p + c) / ((praise + complaint) * c)) ELSE 0 END
          + CASE WHEN c > complaint THEN (c - complaint) * ln((c - complaint) * (p + c) / ((p + c - praise - complaint) * c)) ELSE 0 END) AS surety
        FROM counted, totals WHERE n >= {sentiment.LEAST} AND p > 0 AND c > 0),
    model AS (SELECT word, praise, complaint, n, round(log_odds * {sentiment.SCALE})::INT AS weight FROM weighed
        WHERE round(surety, 6) >= {sentiment.SURE} AND round(log_odds * {sentiment.SCALE}) <> 0
        ORDER BY round(surety, 6) DESC, word LIMIT {sentiment.MOST})"""


@query(f"WITH {MODEL} SELECT word, praise, complaint, n, weight FROM model")
def sentiment_log_odds(spark, sf):
    weighed = sentiment.log_odds(sentiment.counts(_rated(spark, sf)))
    return sentiment.surest(weighed).select("word", "praise", "complaint", "n", "weight")


@query(f"""WITH {MODEL}, sums AS (SELECT r, coalesce(sum(greatest(w, 0)), 0)::BIGINT AS good, coalesce(sum(greatest(-w, 0)), 0)::BIGINT AS bad
        FROM (SELECT r, CASE WHEN negated THEN -weight ELSE weight END AS w FROM words JOIN model USING (word)) GROUP BY r),
    every AS (SELECT doc_id, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM rated LEFT JOIN sums USING (r))
    SELECT doc_id, good, bad, CASE WHEN good + bad < 500 THEN 'NEUTRAL' WHEN 5 * least(good, bad) >= 4 * greatest(good, bad) THEN 'MIXED'
        WHEN good > bad THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment FROM every""")
def sentiment_documents(spark, sf):
    rated = _rated(spark, sf)
    model = sentiment.fit(rated)

    def judged(e):
        return F.struct(e["good"].alias("good"), e["bad"].alias("bad"), model.judged(e)["sentiment"].alias("sentiment"))

    return rated.select("doc_id", let(model.evidence(F.col("review_text")), judged).alias("t")).select("doc_id", "t.*")


# --- links

NAMES_EACH = 5  # names of each part


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    parts, key = A.table(spark, sf, "part"), F.col("p_partkey").cast("string")
    models = F.explode(F.sequence(F.lit(0), F.lit(NAMES_EACH - 1)))
    named = parts.select("p_name", key.alias("key"), models.alias("model"))
    model = F.col("model").cast("string")
    return named.select(F.concat_ws("-", F.lit("PRD"), "key", model).alias("product_id"), F.concat_ws(" ", F.initcap("p_name"), "key", F.lit("Model"), model).alias("name"))


CATALOGUE = f"""catalogue AS (SELECT 'PRD-' || p_partkey || '-' || k AS product_id, lower(p_name) || ' ' || p_partkey || ' model ' || k AS name
        FROM part, range({NAMES_EACH}) AS models(k))"""


@query(f"""WITH {CATALOGUE}, size AS (SELECT count(*) AS parts FROM part),
    texts AS (SELECT row_number() OVER () AS r, doc_id::VARCHAR AS doc_id, lower(coalesce(text, '') || CASE WHEN doc_id % 3 < 2 THEN
        ' about ' || p_name || ' ' || p_partkey || ' model ' || (doc_id % 7) || ' and ' || p_name || ' ' || p_partkey || ' model ' || (doc_id % 4) ELSE '' END) AS said
        FROM documents, size LEFT JOIN part ON p_partkey = doc_id * 31 % parts),
    found AS (SELECT r, min(product_id) AS product FROM texts JOIN catalogue ON contains(said, name) GROUP BY r)
    SELECT doc_id, product AS linked_product, CASE WHEN product IS NULL THEN 'none' ELSE 'inferred_from_text' END AS product_link_basis FROM texts LEFT JOIN found USING (r)""")
def product_names(spark, sf):
    """Each document's whole text, most with two names after it, against a catalogue of several names for each part."""
    parts = A.table(spark, sf, "part")
    named = parts.select("p_partkey", "p_name")
    docs = A.table(spark, sf, "documents").crossJoin(F.broadcast(parts.agg(F.count("*").alias("parts"))))
    docs = docs.withColumn("p_partkey", F.col("doc_id") * 31 % F.col("parts")).join(named, "p_partkey", "left")
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"), F.lit("model"))
    model = lambda n: (F.col("doc_id") % n).cast("string")
    more = F.concat(F.lit(" about "), name, F.lit(" "), model(7), F.lit(" and "), name, F.lit(" "), model(4))
    said = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 < 2, more).otherwise(""))
    null = F.lit(None).cast("string")
    told = docs.select(F.col("doc_id").cast("string").alias("doc_id"), null.alias("product_id"), null.alias("order_ref"), said.alias("text"))
    return documents.link_products(told, _catalogue(spark, sf))


@query("""WITH c AS (SELECT doc_id::VARCHAR AS doc_id, CASE WHEN doc_id % 2 = 0 THEN 'call' ELSE 'image' END AS source_type,
        CASE WHEN doc_id % 3 = 0 THEN 'ORD-1000' WHEN doc_id % 5 > 0 THEN 'ORD-' || (doc_id // 4 + 2000) END AS order_ref FROM documents),
    n AS (SELECT order_ref, count(*) FILTER (source_type = 'call') AS n_left, count(*) FILTER (source_type = 'image') AS n_right FROM c WHERE order_ref IS NOT NULL GROUP BY ALL)
    SELECT order_ref, source_type, doc_id, n_left, n_right FROM c JOIN n USING (order_ref) WHERE n_left > 0 AND n_right > 0""")
def order_stars(spark, sf):
    """A third of all documents name one order, a misread number: as many rows, no pairs."""
    d, key = A.table(spark, sf, "documents"), F.col("doc_id")
    ref = F.when(key % 3 == 0, "ORD-1000").when(key % 5 > 0, F.concat(F.lit("ORD-"), (F.floor(key / 4) + 2000).cast("string")))
    kind = F.when(key % 2 == 0, "call").otherwise("image")
    return documents.order_stars(d.select(key.cast("string").alias("doc_id"), kind.alias("source_type"), ref.alias("order_ref")))


# --- themes


@query("""WITH issues AS (SELECT DISTINCT 'P' || l.doc_id AS product_id, CASE WHEN length(text) >= 60 THEN lower(substr(text, 21, 40)) END AS keyword
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
    themes AS (SELECT 'doc ' || doc_id AS theme, source, doc_id % 5 + 1 AS docs, lower('doc ' || doc_id || ' ' || coalesce(text, '')) AS said FROM documents),
    hits AS (SELECT product_id, theme, source, docs, row_number() OVER (PARTITION BY product_id ORDER BY docs DESC, theme DESC) AS r
        FROM issues JOIN themes ON contains(said, keyword))
    SELECT DISTINCT i.product_id, 'passage' AS issue, theme IS NOT NULL AS found, theme, coalesce(source, '') AS channels, docs::INT AS docs
    FROM (SELECT DISTINCT product_id FROM issues) i LEFT JOIN hits h ON h.product_id = i.product_id AND r = 1""")
def theme_issue_recall(spark, sf):
    """An issue for each labelled document, whose keyword is a passage of its text; a theme for each document, whole."""
    d = A.table(spark, sf, "documents")
    ids = F.transform(F.sequence(F.lit(0).cast("long"), F.col("doc_id") % 5), lambda i: (F.col("doc_id") + i).cast("string"))
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    themes = d.select(name.alias("theme"), F.col("text").alias("quote"), F.array("source").alias("channels"), ids.alias("doc_ids"))
    product = F.concat(F.lit("P"), F.col("doc_id").cast("string"))
    keyword = F.when(F.length("text") >= 60, F.lower(F.substring("text", 21, 40)))
    issues = A.table(spark, sf, "labels").select("doc_id").join(d, "doc_id").select(product.alias("product_id"), F.lit("passage").alias("issue"), keyword.alias("keyword"))
    told = insight.theme_recall(issues.select("product_id", "issue").distinct(), themes, issues.select("product_id", "keyword"))
    return told.select("product_id", "issue", "found", "theme", F.coalesce(joined("channels"), F.lit("")).alias("channels"), "docs")


# --- dataset rules

UNIQUE = RULES.rstrip().removesuffix("]").rstrip() + ', IsUnique "o_orderkey", IsUnique "o_totalprice" ]'


@query("""WITH r AS (SELECT *, count(*) OVER (PARTITION BY o_totalprice) AS n FROM orders)
    SELECT o_orderkey, failed FROM (SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_custkey IS NULL THEN '1' END,
        CASE WHEN NOT coalesce(length(o_orderpriority) > 0, false) THEN '2' END, CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false) THEN '3' END,
        CASE WHEN NOT coalesce(o_totalprice > 1000, false) THEN '4' END, CASE WHEN NOT coalesce(length(o_orderstatus) = 1, false) THEN '5' END,
        CASE WHEN NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) THEN '6' END,
        CASE WHEN count(*) OVER (PARTITION BY o_orderkey) > 1 THEN '7' END, CASE WHEN n > 1 THEN '8' END], lambda x: x IS NOT NULL), ',') AS failed FROM r) WHERE failed <> ''""")
def dq_failing_rows(spark, sf):
    told = quality_rules.failing_rows(A.table(spark, sf, "orders"), quality_rules.parse_rules(UNIQUE))
    return told.select("o_orderkey", joined(F.col("failed").cast("array<string>")).alias("failed"))


@query("""SELECT 1 AS rule_no, count(*) = count(DISTINCT o_orderkey) AS passed FROM orders
    UNION ALL SELECT 2, count(o_totalprice) = count(DISTINCT o_totalprice) FROM orders UNION ALL SELECT 3, count(o_custkey) = count(DISTINCT o_custkey) FROM orders""")
def dq_unique(spark, sf):
    rules = quality_rules.parse_rules('IsUnique "o_orderkey", IsUnique "o_totalprice", IsUnique "o_custkey"')
    return quality_rules.evaluate_rules(A.table(spark, sf, "orders"), rules).select("rule_no", "passed")


# --- records that stages write

GOOD, BAD = (", ".join(f"'{w}'" for w in words) for words in (providers.POSITIVE, providers.NEGATIVE))


@query(f"""WITH {A.REVIEWS}, runs AS (SELECT *, regexp_extract_all(lower(review_text), '[a-z]+') AS t FROM scored WHERE admissible),
    hits AS (SELECT *, len(list_filter(t, lambda w: w IN ({GOOD})))::DOUBLE AS g, len(list_filter(t, lambda w: w IN ({BAD})))::DOUBLE AS b FROM runs)
    SELECT file_name, CASE WHEN g > 0 AND g = b THEN 'MIXED' WHEN g > b THEN 'POSITIVE' WHEN b > g THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment,
        round((g - least(g, b) / 2) / (g + b + 1), 9) AS positive, md5(review_text) AS original, product_id, rating FROM hits""")
def processed_reviews(spark, sf):
    done = providers.process_reviews(checks.gate(checks.validate_reviews(A.reviews(spark, sf))))
    return done.select("file_name", "sentiment", F.round(F.col("sentiment_scores")["Positive"], 9).alias("positive"), F.md5("original_text").alias("original"), "metadata.product_id", "metadata.rating")


@query(f"""WITH {A.LINES}, l AS (SELECT image_key, count(*)::INT AS n, string_agg(text, chr(10) ORDER BY i) AS t FROM lines GROUP BY image_key)
    SELECT 'page_' || page_id AS image_key, coalesce(n, 0)::INT AS n_lines, md5(coalesce(t, '')) AS full_text, coalesce(url, '') AS page_url, '' AS size,
        3::INT AS pairs, 4::INT AS words, n::INT AS lines FROM pages LEFT JOIN l ON image_key = 'page_' || page_id""")
def image_records(spark, sf):
    own, counts = images.image_records(A.blocks(spark, sf)), F.col("block_counts")
    value = lambda k: F.col("textract_key_values")[k]
    told = {"n_lines": F.size("lines"), "full_text": F.md5("full_text"), "page_url": value("Page url"), "size": value("Size"), "pairs": counts["KEY_VALUE_SET"], "words": counts["WORD"], "lines": F.try_element_at(counts, F.lit("LINE"))}
    return own.select("image_key", *(c.alias(k) for k, c in told.items()))


@query("""SELECT 'job_' || event_id AS job_name, CASE WHEN event_id % 2 = 0 THEN 'call_' || user_id || '.mp3' ELSE 'unknown' END AS source_audio,
    CASE WHEN event_id % 5 > 0 THEN 'reason ' || event_type ELSE 'not provided' END AS failure_reason FROM events WHERE event_id % 3 = 1""")
def failed_calls(spark, sf):
    key = F.col("event_id")
    status = F.element_at(F.array(F.lit("COMPLETED"), F.lit("FAILED"), F.lit("IN_PROGRESS")), (key % 3 + 1).cast("int"))
    audio = F.when(key % 2 == 0, F.concat(F.lit("call_"), F.col("user_id").cast("string"), F.lit(".mp3")))
    reason = F.when(key % 5 > 0, F.concat(F.lit("reason "), F.col("event_type")))
    ended = A.table(spark, sf, "events").select(F.concat(F.lit("job_"), key.cast("string")).alias("job_name"), status.alias("status"), audio.alias("source_audio"), reason.alias("failure_reason"))
    return calls.failure_records(ended, F.current_timestamp()).select("job_name", "source_audio", "failure_reason")


@query(f"""WITH {A.SEGMENTS}, said AS (SELECT call_id, count(*)::INT AS n_turns, string_agg(text, '|' ORDER BY turn) AS t FROM turns GROUP BY call_id),
    who AS (SELECT call_id, string_agg(speaker || '=' || role_guess, ',' ORDER BY speaker) AS w FROM roles GROUP BY call_id)
    SELECT call_id, n_turns, md5(t) AS said, w AS speakers FROM said JOIN who USING (call_id) WHERE call_id % 5 > 0""")
def call_records(spark, sf):
    """Records of completed calls: one for each conversation but each fifth, whose job failed."""
    rows = A.segments(spark, sf)
    turns, key = calls.merge_turns(rows), F.col("call_id")
    status = F.when(key % 5 > 0, "COMPLETED").otherwise("FAILED")
    every = rows.select("call_id").distinct()
    ended = every.select("call_id", F.concat(F.lit("job_"), key.cast("string")).alias("job_name"), status.alias("status"), F.lit("a.mp3").alias("source_audio"), F.lit("t.json").alias("transcript_key"))
    none = calls.slot_documents(calls.named_turns(turns)).where("false")
    scored = calls.apply_results(calls.batched(none), _no_results(spark), _no_results(spark, True))
    full = every.withColumn("full_transcript", F.lit(""))
    told = calls.call_records(ended, full, turns, calls.infer_roles(turns), scored, calls.slot_summary(scored, every))
    line = F.array_join(F.transform("turns", lambda t: t["text"]), "|")
    roles = F.array_join(F.transform(F.array_sort(F.map_entries("speakers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["role_guess"])), ",")
    return told.select("call_id", F.size("turns").alias("n_turns"), F.md5(line).alias("said"), roles.alias("speakers"))


def _no_results(spark: SparkSession, failed: bool = False) -> DataFrame:
    rest = "error string" if failed else "sentiment string, sentiment_scores map<string,double>"
    return spark.createDataFrame([], f"call_id long, batch int, index int, {rest}")
