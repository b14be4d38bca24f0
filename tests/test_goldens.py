"""The engine on the committed data set: counts, scores and routes that are known beforehand."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearken.operators import calls, checks, documents, images, insight, metrics, providers, quality_rules, redaction, review, surveys
from hearken.sources import readers, sinks, synthetic

DATA = Path(__file__).parent / "fixtures"


@pytest.fixture(scope="module")
def records(spark):
    raw = readers.read_surveys(spark, str(DATA / "surveys.csv"))
    return surveys.survey_records(surveys.numbered(raw, "source_key"))


@pytest.fixture(scope="module")
def verdicts(spark):
    return checks.validate_variant_reviews(readers.read_reviews(spark, str(DATA / "reviews")).withColumn("name", F.regexp_extract("source_key", r"(review_\d+)", 1)))


@pytest.fixture(scope="module")
def call_doc(spark):
    raw = spark.read.option("multiLine", True).json(str(DATA / "processed_call.json"))
    as_map = lambda c, kind: F.from_json(F.to_json(c), kind)
    return documents.from_calls(raw.withColumns({"speakers": as_map("speakers", "map<string,struct<role_guess:string,role_method:string>>"), "sentiment": as_map("sentiment", "map<string,struct<sentiment:string,scores:map<string,double>,truncated:boolean>>"), "source_key": F.lit("processed-data/calls/call_001_processed.json")}))


def test_survey_summary(records):
    s = surveys.survey_summary(records).first()
    assert (s.rows_read, s.admissible, s.rejected, s.admission_rate) == (30, 28, 2, 0.933)
    assert (s.mean_product_rating, s.mean_service_rating, s.mean_satisfaction_ordinal, s.with_comment) == (2.82, 3.43, 3.43, 24)
    assert sorted(r.row_number for r in records.collect()) == list(range(2, 32))


def test_survey_counts(records):
    assert sorted((r.improvement_area, r.n) for r in surveys.improvement_counts(records).collect()) == [("App reliability", 6), ("Battery life", 5), ("Build quality", 5), ("Packaging", 6)]
    assert {r.check: r.n for r in surveys.issue_counts(records).collect()} == {"improvement_area_present": 6, "comments_present": 4, "customer_id_present": 1, "survey_date_valid": 1}
    gaps = {r.row_number: r.rating_satisfaction_gap for r in records.collect()}
    assert gaps[9] == -3.0 and gaps[24] == 4.0 and sum(g == 0.0 for g in gaps.values()) == 12 and sum(g == 0.5 for g in gaps.values()) == 16


def test_empty_summary(records):
    s = surveys.survey_summary(records.where("row_number < 0")).first()
    assert s.rows_read == 0 and s.admission_rate is None and s.mean_product_rating is None


def test_no_csv(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        readers.read_surveys(spark, str(tmp_path))


def test_review_admission(verdicts):
    rows = {r.name: r for r in verdicts.collect()}
    assert len(rows) == 20 and sum(r.admissible for r in rows.values()) == 17
    assert {k: r.fatal_failures for k, r in rows.items() if r.fatal_failures} == {"review_003": ["min_length"], "review_007": ["has_product_id"], "review_011": ["rating_in_range"]}
    assert {k: r.advisory_failures for k, r in rows.items() if r.advisory_failures} == {"review_014": ["valid_date_format"], "review_018": ["has_customer_id"]}
    assert sum(r.quality_score for r in rows.values()) / 20 == 0.96875


@pytest.mark.parametrize("rating,good", [("4", True), ("4.0", False), ('"4"', False), ("true", True), ("false", False), ("6", False), ("null", False)])
def test_rating_keeps_its_json_type(spark, rating, good):
    text = f'{{"review_text": "long enough text", "product_id": "p", "customer_id": "c", "rating": {rating}, "review_date": "2026-01-01"}}'
    row = checks.validate_variant_reviews(spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("review"))).first()
    assert row.checks["rating_in_range"] is good


def test_text_must_be_a_string(spark):
    row = checks.validate_variant_reviews(spark.sql("""SELECT parse_json('{"review_text": 12345678901, "rating": 3}') AS review""")).first()
    assert not row.checks["min_length"] and row.checks["has_review_text"] and not row.admissible


def test_gate_fails_closed(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, admissible boolean")
    assert [r.i for r in checks.gate(df).collect()] == [1]


def test_rules(spark):
    raw = readers.read_surveys(spark, str(DATA / "surveys.csv"))
    rules = quality_rules.parse_rules((DATA / "surveys_ruleset.dqdl").read_text())
    got = quality_rules.evaluate_rules(raw, rules)
    assert len(rules) == 10 and {r.rule for r in got.where("not passed").collect()} == {'ColumnLength "customer_id" > 0', 'ColumnLength "survey_date" > 0'}
    assert quality_rules.rules_score(got).first().score == 0.8
    with pytest.raises(ValueError):
        quality_rules.parse_rules('Rules = [ RowCount > 1 ]')


def test_call_document(call_doc):
    d = call_doc.first()
    assert (d.doc_id, d.order_ref, d.signals.sentiment, d.signals.sentiment_confidence) == ("call:call_001", "ORD-9001", "NEGATIVE", 0.9047)
    assert d.provenance.admissible and d.provenance.trust_notes == [documents.POSITIONAL] and d.text.startswith("agent: Thank you")


def test_routes_and_truth(spark, verdicts, records, call_doc):
    truth = json.loads((DATA / "ground_truth.json").read_text())
    # Captured-style sentiment: a planted mismatch is one because its text contradicts its rating.
    planted = {d.split(":")[1] for d in truth["planted_rating_mismatches"] if d.startswith("review:")}
    field = lambda n, kind="string": F.try_variant_get("review", f"$.{n}", kind)
    rating = field("rating", "int")
    label = F.when(F.col("name").isin(*planted), F.when(rating >= 4, "NEGATIVE").otherwise("POSITIVE")).otherwise(F.when(rating >= 4, "POSITIVE").otherwise("NEGATIVE"))
    done = checks.gate(verdicts).select(F.concat(F.lit("processed-data/reviews/"), "name", F.lit("_processed.json")).alias("source_key"), field("review_text").alias("original_text"), label.alias("sentiment"), F.create_map(F.lit("Negative"), F.lit(0.9), F.lit("Positive"), F.lit(0.9)).alias("sentiment_scores"), F.struct(field("product_id").alias("product_id"), field("customer_id").alias("customer_id"), field("review_date").alias("review_date"), rating.alias("rating")).alias("metadata"))
    docs = documents.unified(documents.from_reviews(done), documents.from_surveys(records), call_doc)
    judged = review.verdicts(docs)
    s = {r.route: r.n for r in judged.where("source_type = 'survey'").groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert s == {"rejected": 2, "review_queue": 2, "auto_accept": 26}
    flagged = judged.where("route = 'review_queue'").select("doc_id")
    score = review.truth_score(flagged, spark.createDataFrame([(d,) for d in truth["planted_rating_mismatches"]], "doc_id string")).first()
    assert (score.planted, score.precision, score.recall, score.f1) == (5, 1.0, 1.0, 1.0)
    m = documents.manifest(docs).first()
    assert (m.documents_total, m.documents_sent, m.by_source) == (48, 17 + 24 + 1, {"call": 1, "review": 17, "survey": 30})
    assert documents.unique_ids(docs).count() == 0
    flag = judged.where("doc_id = 'survey:row_24'").first().flags[0]
    assert flag.rule == "survey_label_vs_ratings" and flag.detail == "stated satisfaction differs from own ratings by 4.0 points"


def test_route_units(spark):
    docs = spark.createDataFrame([("a", "NEGATIVE", 5, None, True, "t"), ("b", "POSITIVE", 5, None, True, "t"), ("c", None, None, None, True, "t"), ("d", "neutral", 1, None, True, "t"), ("e", "x", 1, 9.0, False, ""), ("f", None, None, None, True, "")], "doc_id string, s string, r int, g double, a boolean, text string")
    shaped = docs.select("doc_id", F.lit("review").alias("source_type"), F.lit(None).cast("string").alias("product_id"), "text", F.struct(F.col("s").alias("sentiment"), F.col("r").alias("rating"), F.col("g").alias("rating_satisfaction_gap")).alias("signals"), F.struct(F.col("a").alias("admissible")).alias("provenance"))
    v = review.verdicts(shaped)
    assert {r.doc_id: r.route for r in v.collect()} == {"a": "review_queue", "b": "auto_accept", "c": "escalate_to_fm", "d": "auto_accept", "e": "rejected", "f": "auto_accept"}
    s = review.review_summary(v).first()
    assert (s.judged, s.flagged, s.mismatch_rate) == (4, 1, 0.25)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id string")
    half = review.truth_score(ids("a"), ids("a", "z")).first()
    assert (half.precision, half.recall, half.f1) == (1.0, 0.5, 0.667)
    none = review.truth_score(ids("a").where("false"), ids("a").where("false")).first()
    assert (none.precision, none.recall, none.f1) == (None, None, 0.0)
    assert review.review_summary(v.where("false")).first().mismatch_rate is None


def segments(spark, rows):
    return spark.createDataFrame([(1, i, s, t, str(i), str(i + 1)) for i, (s, t) in enumerate(rows)], "call_id int, pos int, speaker string, text string, start_time string, end_time string")


def test_turns_and_roles(spark):
    turns = calls.merge_turns(segments(spark, [("a", "Hi "), ("a", " there"), ("b", "  "), ("a", "again"), ("b", "yes"), ("a", "ok")])).orderBy("turn").collect()
    assert [(r.speaker, r.text, r.start_time, r.end_time) for r in turns] == [("a", "Hi there again", 0.0, 4.0), ("b", "yes", 4.0, 5.0), ("a", "ok", 5.0, 6.0)]
    roles = lambda *rows: {r.speaker: (r.role_guess, r.role_method) for r in calls.infer_roles(calls.merge_turns(segments(spark, rows))).collect()}
    assert roles(("x", "1"), ("y", "2"), ("x", "3")) == {"x": ("agent", "first_speaker"), "y": ("customer", "first_speaker")}
    assert roles(("x", "1")) == {"x": ("unknown", "not_inferred:speaker_count=1")}
    assert {v[1] for v in roles(("x", "1"), ("y", "2"), ("z", "3")).values()} == {"not_inferred:speaker_count=3"}


def test_slots_results_and_summary(spark):
    turns = calls.merge_turns(segments(spark, [("a", "hello"), ("b", "it broke"), ("a", "sorry"), ("b", "refund please")]))
    named = calls.with_roles(turns, calls.infer_roles(turns))
    items = calls.slot_documents(named)
    assert [(r.slot, r.part, r.text, r.n_turns) for r in items.orderBy("item").collect()] == [("customer_all", 0, "it broke refund please", 2), ("agent_all", 0, "hello sorry", 2), ("customer_end", 0, "refund please", 1)]
    assert calls.last_customer_turn(named).first().text == "refund please"
    assert calls.render_dialogue(named).first().text.split("\n")[1] == "customer: it broke"
    assert calls.slot_documents(calls.with_roles(turns, calls.infer_roles(turns).where("false"))).count() == 0
    units = {r.design: r.units for r in calls.billed_units(calls.request_designs(named)).collect()}
    assert units == {"a": 1200, "b": 900}


def test_results_go_by_index(spark):
    items = calls.batched(spark.createDataFrame([(1, i) for i in range(30)], "call_id int, item int"))
    results = spark.createDataFrame([(1, 1, 2, "NEGATIVE", {"Negative": 1.0})], "call_id int, batch int, index int, sentiment string, sentiment_scores map<string,double>")
    errors = spark.createDataFrame([(1, 1, 1, "ERR")], "call_id int, batch int, index int, error string")
    got = {r.item: (r.sentiment, r.sentiment_error) for r in calls.apply_results(items, results, errors).collect()}
    assert got[27] == ("NEGATIVE", None) and got[26] == (None, "ERR") and got[0] == (None, None)


def test_byte_weighted_mean(spark):
    neg, pos = ({"Positive": p, "Negative": n, "Neutral": 0.0, "Mixed": 0.0} for p, n in ((0.0, 1.0), (1.0, 0.0)))
    scored = spark.createDataFrame([(1, "customer_all", "x" * 300, 3, True, neg), (1, "customer_all", "y" * 100, 1, False, pos), (1, "agent_all", "z", 1, False, None)], "call_id int, slot string, text string, n_turns int, truncated boolean, sentiment_scores map<string,double>")
    got = {r.slot: r for r in calls.slot_summary(scored, scored).collect()}
    c = got["customer_overall"]
    assert (c.sentiment, c.scores["Negative"], c.scores["Positive"], c.parts, c.turns_used, c.truncated, c.reason) == ("NEGATIVE", 0.75, 0.25, 2, 4, True, None)
    assert got["agent_overall"].reason == "comprehend_error" and got["customer_end_state"].reason == "no_text_for_role"


def test_call_records(spark):
    turns = calls.merge_turns(segments(spark, [("a", "hello"), ("b", "it broke")]))
    roles = calls.infer_roles(turns)
    items = calls.batched(calls.slot_documents(calls.with_roles(turns, roles)))
    scored = calls.apply_results(items, items.where("item < 2").select("call_id", "batch", "index", F.lit("NEUTRAL").alias("sentiment"), F.expr("map('Positive', 0D, 'Negative', 0D, 'Neutral', 1D, 'Mixed', 0D)").alias("sentiment_scores")), items.where("item = 2").select("call_id", "batch", "index", F.lit("E").alias("error")))
    jobs = spark.createDataFrame([(1, "j1", "COMPLETED", "raw/call_9.mp3", None), (2, "j2", "FAILED", None, None)], "call_id int, job_name string, status string, source_audio string, failure_reason string")
    text = spark.createDataFrame([(1, "hello it broke")], "call_id int, full_transcript string")
    out = calls.call_records(jobs, text, turns, roles, scored, calls.slot_summary(scored, turns)).first()
    assert out.speakers["b"].role_guess == "customer" and [t.text for t in out.turns] == ["hello", "it broke"]
    assert out.sentiment["customer_overall"].sentiment == "NEUTRAL" and [d.slot for d in out.sentiment_docs] == ["customer_all", "agent_all", "customer_end"]
    assert [(e["index"], e.error) for e in out.sentiment_errors] == [(2, "E")]
    failed = calls.failure_records(jobs, F.lit("2026-01-01 00:00:00").cast("timestamp")).first()
    assert (failed.source_audio, failed.failure_reason) == ("unknown", "not provided")
    requests = calls.transcription_requests(spark.createDataFrame([("raw/a b.mp3",), ("raw/a.txt",)], "key string"), F.lit("bkt"), F.col("key"), F.lit("2026-01-01 00:00:00").cast("timestamp")).collect()
    assert len(requests) == 1 and requests[0].media_uri == "s3://bkt/raw/a b.mp3" and requests[0].output_key == "transcriptions/a b.json"


BLOCKS = """image_key string, pos int, Id string, BlockType string, Text string, EntityTypes array<string>, Relationships array<struct<Type:string,Ids:array<string>>>"""


def test_block_graph(spark):
    """A synthetic graph, not a captured one."""
    k, n = "x/EAR-2200_CUST-2001.png", None
    rows = [
        (k, 0, "l1", "LINE", "RETURN REQUEST", n, n), (k, 1, "l2", "LINE", "Customer: CUST-2001", n, n), (k, 2, "p", "PAGE", n, n, n),
        (k, 3, "k1", "KEY_VALUE_SET", n, ["KEY"], [("CHILD", ["w1"]), ("VALUE", ["v1"])]), (k, 4, "v1", "KEY_VALUE_SET", n, ["VALUE"], [("CHILD", ["w2", "w3", "gone"])]),
        (k, 5, "w1", "WORD", "Product:", n, n), (k, 6, "w2", "WORD", "Wireless", n, n), (k, 7, "w3", "SELECTION_ELEMENT", "X", n, n),
        (k, 8, "k2", "KEY_VALUE_SET", n, ["KEY"], [("CHILD", ["w1"])]), (k, 9, "k3", "KEY_VALUE_SET", n, ["KEY"], [("VALUE", ["v1"])]), (k, 10, "k4", "KEY_VALUE_SET", n, ["KEY"], [("CHILD", ["w2"]), ("VALUE", ["none"])]),
    ]
    r = images.image_records(spark.createDataFrame(rows, BLOCKS)).first()
    assert r.full_text == "RETURN REQUEST\nCustomer: CUST-2001" and r.metadata.product_id == "EAR-2200"
    assert r.textract_key_values == {"Product": "", "Wireless": ""}  # the last of a repeated key stays
    assert r.block_counts == {"KEY_VALUE_SET": 5, "LINE": 2, "PAGE": 1, "SELECTION_ELEMENT": 1, "WORD": 2}
    first = images.image_records(spark.createDataFrame(rows[:8], BLOCKS)).first()
    assert first.textract_key_values == {"Product": "Wireless X"}
    assert images.ids_agree(images.image_records(spark.createDataFrame(rows, BLOCKS))).first().customer_agrees


def test_redaction_keeps_identifiers(spark):
    base = spark.createDataFrame([("a", "EAR-2200 of Ann, ann@x.example"), ("b", "   "), ("c", "é" * 3000)], "doc_id string, t string")
    docs = documents.document(base, F.col("doc_id"), "review", F.lit("k"), F.col("t"))
    got = {r.doc_id: r for r in redaction.redact_documents(docs, providers.pattern_spans).collect()}
    assert got["a"].text == "EAR-2200 of Ann, [EMAIL]" and got["a"].pii_redacted == ["EMAIL"] and got["a"].pii_allowlisted == ["EAR-2200"]
    assert got["b"].pii_redacted == [] and got["b"].pii_allowlisted is None
    assert got["c"].text == "é" * 2500 and got["c"].provenance.truncated and not got["a"].provenance.truncated
    tally = {(r.kind, r.name): r.n for r in redaction.tally(redaction.redact_documents(docs, providers.pattern_spans)).collect()}
    assert tally == {("redacted", "EMAIL"): 1, ("allowlisted", "EAR-2200"): 1}


def test_providers(spark):
    s = spark.createDataFrame([("I love it, great",), ("broken and useless",), ("a table",), ("good but broken",), (None,)], "t string").select(providers.lexicon_sentiment(F.col("t")).alias("s"))
    assert [r.s.sentiment for r in s.collect()] == ["POSITIVE", "NEGATIVE", "NEUTRAL", "MIXED", "NEUTRAL"]
    assert all(abs(sum(r.s.scores.values()) - 1) < 1e-9 for r in s.collect())
    done = providers.process_reviews(spark.createDataFrame([("r1", "I love it for 3 weeks", "p", "c", 5, "2026-01-01")], "file_name string, review_text string, product_id string, customer_id string, rating int, review_date string")).first()
    assert done.sentiment == "POSITIVE" and [(e.Type, e.BeginOffset, e.EndOffset) for e in done.entities] == [("QUANTITY", 14, 21)] and done.metadata.rating == 5


def test_report_validation_and_citations(spark):
    good = '{"themes":[{"theme":"t","doc_ids":["a"],"evidence_strength":"s","product_link_basis":"b"}],"call_outcomes":[{"doc_id":"c"}],"contradictions":[{"doc_ids":["d"]}],"recommended_actions":[{"doc_ids":["a","zz"]}],"coverage_note":""}'
    bad = '{"themes":[{"theme":"t","doc_ids":[]}],"call_outcomes":null}'
    df = spark.createDataFrame([(0, good), (1, bad)], "i int, t string").select("i", F.parse_json("t").alias("report"))
    p = {r.i: r.p for r in df.select("i", insight.report_problems(F.col("report")).alias("p")).collect()}
    assert p[0] == [] and p[1] == ["missing key: contradictions", "missing key: recommended_actions", "missing key: coverage_note", "themes[0] missing evidence_strength", "themes[0] missing product_link_basis", "themes[0] cites no doc_ids"]
    cited = insight.cited_ids(insight.typed_report(df.where("i = 0")))
    assert {r.doc_id for r in cited.collect()} == {"a", "c", "d", "zz"}
    batch = spark.createDataFrame([("a",), ("c",), ("d",)], "doc_id string")
    assert [r.doc_id for r in insight.hallucinated(cited, batch).collect()] == ["zz"]


def test_asking_again(spark):
    said = iter(["no json", 'Here: {"themes": []}'])
    seen = []
    got = insight.ask(spark, lambda system, user: seen.append(user) or next(said), "s", "m").first()
    assert got.report is not None and got.error is None and len(seen) == 2 and seen[1].startswith("m\n\n")
    lost = insight.ask(spark, lambda system, user: "never", "s", "m").first()
    assert lost.report is None and lost.error


def test_message_and_stub_report(spark, call_doc, records):
    docs = documents.unified(call_doc, documents.from_surveys(records))
    batch = documents.admissible_batch(docs)
    stripped = insight.strip_inferred_signals(batch)
    assert stripped.schema["signals"].dataType.names == ["rating"]
    message = json.loads(insight.user_message(stripped, documents.manifest(docs), {"EAR-2200": "Wireless Earbuds"}).first().message)
    assert len(message["documents"]) == 25 and message["manifest"]["documents_total"] == 31 and "sentiment" not in json.dumps(message["documents"])
    body = insight.request_body("m", "s", "again")
    assert body["temperature"] == 0 and body["messages"][0]["content"][0]["text"] == "m\n\nagain"
    links = documents.link_products(docs, spark.createDataFrame([("EAR-2200", "Wireless Earbuds")], "product_id string, name string"))
    assert links.where("doc_id = 'call:call_001'").first().product_link_basis == "inferred_from_text"
    themes = insight.rule_model({"EAR-2200": ("charg",), "VAC-3000": ("stuck",)})(batch, links)
    got = {r.product_id: r for r in themes.collect()}
    assert got["EAR-2200"].evidence_strength == "cross_channel" and "call:call_001" in got["EAR-2200"].doc_ids
    expected = spark.createDataFrame([("EAR-2200", "i"), ("VAC-3000", "i"), ("BLD-4500", "i")], "product_id string, issue string")
    words = spark.createDataFrame([("EAR-2200", "charg"), ("VAC-3000", "stuck"), ("BLD-4500", "burn")], "product_id string, keyword string")
    recall = insight.theme_recall(expected, themes, words)
    assert {r.product_id: r.found for r in recall.collect()} == {"EAR-2200": True, "VAC-3000": True, "BLD-4500": False}
    invented = insight.invented_issues(themes, spark.createDataFrame([("EAR-2200",)], "product_id string"))
    nothing = spark.createDataFrame([], "doc_id string")
    assert invented.count() == 1 and insight.verdict(recall, invented, nothing).first().verdict == "REVIEW NEEDED"
    assert insight.verdict(recall.where("found"), invented.where("false"), nothing).first().verdict == "PASS"
    assert insight.uncited_themes(themes).count() == 0 and insight.link_bases(themes).agg(F.sum("n")).first()[0] == 2


def test_order_links(spark, call_doc):
    image = documents.from_images(spark.createDataFrame([("k", "EAR-2200_CUST-2001.png", "RETURN REQUEST\nOrder #ORD-9001", ("EAR-2200", "CUST-2001"))], "source_key string, image_key string, full_text string, metadata struct<product_id:string,customer_id:string>"))
    docs = documents.unified(call_doc, image)
    link = documents.order_links(docs).first()
    assert (link.order_ref, link.left_id, link.right_id) == ("ORD-9001", "call:call_001", "image:EAR-2200_CUST-2001")
    linked = documents.link_products(docs, spark.createDataFrame([], "product_id string, name string")).where("doc_id = 'call:call_001'")
    assert linked.count() == 0 or linked.first().linked_product == "EAR-2200"
    with pytest.raises(ValueError):
        documents.normalise(docs, "somewhere/else")


def test_metrics(spark, verdicts):
    ts = F.lit("2026-01-01 10:30:00").cast("timestamp")
    m = metrics.validation_metrics(verdicts, ts)
    w = {r.name: (r.n, round(r.mean, 5)) for r in metrics.windowed(m).collect()}
    assert w == {"QualityScore": (20, 0.96875), "AdmissionRate": (20, 0.85)}
    events = spark.createDataFrame([((0.0, ["a", "b"]),), ((None, ["a"]),), ((0.5, None),)], "detail struct<score:double,rulesetNames:array<string>>")
    assert sorted((r.dims["Ruleset"], r.value) for r in metrics.ruleset_metrics(events, ts).collect()) == [("a", 0.0), ("b", 0.0)]
    summary = spark.createDataFrame([(None, 0, 3)], "mismatch_rate double, flagged long, escalate_to_fm long")
    assert {r.name: r.value for r in metrics.review_metrics(summary, ts).collect()} == {"MismatchRate": 0.0, "RecordsFlagged": 0.0, "RecordsEscalatedToFM": 3.0}


def test_synthetic_data_keeps_its_truth(spark):
    raw = synthetic.surveys(spark, 600)
    rec = surveys.survey_records(surveys.numbered(raw, "source_key"))
    judged = review.verdicts(documents.from_surveys(rec.drop("position", "planted_mismatch", "malformed")))
    planted = rec.where("planted_mismatch and admissible").select(F.concat(F.lit("survey:row_"), "row_number").alias("doc_id"))
    assert review.truth_score(judged.where("route = 'review_queue'"), planted).first().f1 == 1.0
    bad = checks.validate_reviews(synthetic.reviews(spark, 400))
    assert bad.where("not admissible and malformed is null").count() == 0 and bad.where("admissible and malformed is not null").count() == 0
    assert images.ids_agree(synthetic.images(spark, 20)).where("not product_agrees").count() == 0


def test_sinks(spark, tmp_path, records):
    out = str(tmp_path / "out")
    sinks.write_survey(records, surveys.survey_summary(records), out)
    sinks.write_survey(records, surveys.survey_summary(records), out)
    assert spark.read.parquet(f"{out}/records").count() == 30 and spark.read.json(f"{out}/summary").first().admissible == 28
    sinks.write_split(records, ~F.col("admissible"), f"{out}/split")
    kept = readers.read_processed(spark, [f"{out}/split"], "row_number int", one_per_file=False)
    assert kept.count() == 28 and readers.failed_count(spark, [f"{out}/split"]).first().failed >= 1
    m = metrics.datum(records, "n", "x", F.lit(1), F.lit("2026-01-01").cast("timestamp"))
    sinks.append_metrics(m, f"{out}/metrics")
    assert spark.read.parquet(f"{out}/metrics").count() == 30
    assert "Scan" in sinks.dry_run(records)
    v = review.verdicts(documents.from_surveys(records))
    sinks.write_review(v, review.review_summary(v), review.truth_score(v.where("route = 'review_queue'"), v.where("route = 'rejected'")), f"{out}/review")
    assert spark.read.parquet(f"{out}/review/verdicts").count() == 30
    assert readers.register(spark, str(DATA / "surveys.csv")) == "surveys" and spark.table("surveys").count() == 30
    assert readers.read_media(spark, str(DATA)).count() >= 20
