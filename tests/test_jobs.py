"""Jobs from folder to folder, and the readers they need."""

import json

import pytest
from pyspark.sql import functions as F

from hearken import jobs
from hearken.functions.text import strip
from hearken.operators import documents, insight, providers
from hearken.sources import readers

HEADER = "customer_id,product_id,survey_date,product_rating,service_rating,overall_satisfaction,improvement_area,comments"


@pytest.fixture(scope="module")
def surveys(tmp_path_factory):
    folder = tmp_path_factory.mktemp("surveys")
    (folder / "a.csv").write_text(HEADER + "\nC1,P1,2026-01-02,5,4,Satisfied,Price,\"two\nlines, one cell\"\n,P1,2026-01-02,5,9,Satisfied,,x\n")
    (folder / "b.CSV").write_text("\ufeffproduct_id,customer_id,extra,comments,overall_satisfaction,service_rating,product_rating,survey_date\nP2,C2,?,fine,Neutral,3,3,2026-1-5\n")
    return str(folder)


def test_columns_are_found_by_their_names(spark, surveys, tmp_path):
    rows = {r.customer_id: r for r in readers.read_surveys(spark, surveys).collect()}
    assert len(rows) == 3
    assert (rows["C2"].product_id, rows["C2"].comments, rows["C2"].service_rating, rows["C2"].improvement_area) == ("P2", "fine", "3", "")
    assert (rows["C1"].product_id, rows["C1"].comments) == ("P1", "two\nlines, one cell")
    with pytest.raises(FileNotFoundError):
        readers.read_surveys(spark, str(tmp_path))


def test_survey_job(spark, surveys, tmp_path):
    assert jobs.survey_job(spark, surveys, str(tmp_path), dry_run=True).count("rows") == 2 and not list(tmp_path.iterdir())
    told = jobs.survey_job(spark, surveys, str(tmp_path)).splitlines()
    assert told[0].endswith("a.csv: 2 rows, 1 admissible") and told[1].endswith("b.CSV: 1 rows, 1 admissible")
    records = spark.read.parquet(str(tmp_path / "records")).orderBy("source_key", "row_number").collect()
    assert [(r.row_number, r.admissible, r.survey_date) for r in records] == [(2, True, "2026-01-02"), (3, False, "2026-01-02"), (2, True, "2026-01-05")]


@pytest.fixture(scope="module")
def processed(tmp_path_factory):
    root = tmp_path_factory.mktemp("processed-data")
    own = {
        "reviews/r1_processed.json": {"original_text": "Order #1234: it broke, mail a@b.example", "sentiment": "NEGATIVE", "sentiment_scores": {"Negative": 0.9}, "metadata": {"product_id": "P1", "customer_id": "C1", "review_date": "2026-01-01", "rating": 5}},
        "calls/c1_processed.json": {"source_audio": "raw-data/calls/c1.mp3", "status": "COMPLETED", "turns": [{"speaker": "s0", "start_time": 0, "end_time": 1, "text": "Hello"}, {"speaker": "s1", "start_time": 1, "end_time": 2, "text": "my order 1234 broke"}], "speakers": {"s0": {"role_guess": "agent", "role_method": "first_speaker"}, "s1": {"role_guess": "customer", "role_method": "first_speaker"}}, "sentiment": {"customer_overall": {"sentiment": "NEGATIVE", "scores": {"Negative": 0.8}, "truncated": False}}},
        "calls/_failed/x.json": {"source_audio": "raw-data/calls/x.mp3", "status": "FAILED"},
        "surveys/s_processed.json": {"summary": {}, "records": [{"row_number": 2, "customer_id": "C2", "product_id": "P1", "survey_date": "2026-01-01", "product_rating": 1, "service_rating": 1, "overall_satisfaction": "Very Satisfied", "rating_satisfaction_gap": 4.0, "comments": "odd", "admissible": True, "issues": []}, {"row_number": 3, "admissible": False, "issues": [{"check": "customer_id_present", "severity": "FATAL"}]}]},
        "images/P1_CUST-9_processed.json": {"image_key": "raw-data/images/P1_CUST-9.png", "full_text": "ORD-1234 receipt", "metadata": {"product_id": "P1", "customer_id": "CUST-9"}},
    }
    for name, record in own.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(json.dumps(record))
    return str(root)


def test_documents_are_collected_and_linked(spark, processed):
    docs = jobs.collect_documents(spark, processed)
    assert sorted(r.doc_id for r in docs.collect()) == ["call:c1", "image:P1_CUST-9", "review:r1", "survey:row_2", "survey:row_3"]
    assert [tuple(r) for r in documents.order_links(docs).collect()] == [("ORD-1234", "call:c1", "image:P1_CUST-9")]
    with pytest.raises(FileNotFoundError):
        jobs.collect_documents(spark, processed + "/none")


def test_review_job(spark, processed, tmp_path):
    planted = spark.createDataFrame([("review:r1",), ("survey:row_9",)], "doc_id string")
    docs = jobs.collect_documents(spark, processed)
    assert "nothing written" in jobs.review_job(spark, docs, planted, str(tmp_path), dry_run=True) and not list(tmp_path.iterdir())
    told = jobs.review_job(spark, docs, planted, str(tmp_path))
    assert "precision: 0.5" in told and "recall: 0.5" in told
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 3
    assert {r.route for r in spark.read.parquet(str(tmp_path / "verdicts")).collect()} == {"rejected", "review_queue", "escalate_to_fm", "auto_accept"}


def test_insight_and_score_jobs(spark, processed, tmp_path):
    docs, asked = jobs.collect_documents(spark, processed), []
    report = {"themes": [{"theme": "broken on arrival", "product_id": "P1", "product_link_basis": "stated_id", "severity": "high", "channels": ["review", "call"], "doc_ids": ["review:r1", "call:c1"], "evidence_strength": "cross_channel", "quote": "it broke"}], "call_outcomes": [], "contradictions": [{"doc_ids": ["review:r1"], "note": "n"}], "recommended_actions": [{"action": "a", "doc_ids": ["nobody"], "confidence": "low"}], "coverage_note": "c"}

    def model(system, user):
        asked.append((system, json.loads(user.split("\n\n")[0])))
        return "no" if len(asked) == 1 else "Here: " + json.dumps(report)

    shown = jobs.insight_job(spark, docs, {"P1": "Kettle"}, str(tmp_path), model, dry_run=True)
    assert "nothing was sent" in shown and not asked and '"EMAIL"' in shown
    told = jobs.insight_job(spark, docs, {"P1": "Kettle"}, str(tmp_path), model)
    assert len(asked) == 2 and "NOT in the batch: nobody" in told and insight.RULES[0] in asked[0][0]
    texts = {d["doc_id"]: d for d in asked[0][1]["documents"]}
    assert "[EMAIL]" in texts["review:r1"]["text"] and "sentiment" not in texts["review:r1"]["signals"] and len(texts) == 4
    assert "a@b.example" in jobs.insight_job(spark, docs, {}, str(tmp_path), lambda s, u: asked.append(u) or "{}", redact=False) or "a@b.example" in asked[-1]
    with pytest.raises(ValueError, match="at the most"):
        insight.user_message(docs, documents.manifest(docs), {}, most=2)
    (tmp_path / "r.json").write_text(json.dumps({"report": report}))
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    text, well = jobs.score_job(spark, str(tmp_path / "r.json"), one([("P1", "breaks"), ("P2", "burns")], "product_id string, issue string"), one([("P1", "broke"), ("P2", "burn")], "product_id string, keyword string"), one([("P3",)], "product_id string"), one([("review:r1",)], "doc_id string"), docs)
    assert not well and "FOUND  P1" in text and "MISSED P2" in text and "contradiction hit: review:r1" in text and "hallucinated: 1" in text


def test_command_line(spark, surveys, tmp_path, capsys):
    assert jobs.main(["survey", "--input-dir", surveys, "--output-dir", str(tmp_path), "--dry-run"]) == 0
    assert "2 rows, 1 admissible" in capsys.readouterr().out


def test_spans_of_texts_with_control_characters(spark):
    texts = ["a\x02b x@y.com z", "\x02\x03\x04 555-123-4567 \x05 x@y.com", "x@y.com", "", None, "4111 1111 1111 1111 and 123-45-6789, AB-1234; x@y.com,z@y.org", "a" * 200_000 + "@"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: [(s.Type, texts[r.i][s.BeginOffset : s.EndOffset]) for s in r.spans] for r in docs.select("i", providers.pattern_spans(F.col("t")).alias("spans")).collect()}
    assert got == {0: [("EMAIL", "x@y.com")], 1: [("PHONE", "555-123-4567"), ("EMAIL", "x@y.com")], 2: [("EMAIL", "x@y.com")], 3: [], 4: [], 5: [("CREDIT_DEBIT_NUMBER", "4111 1111 1111 1111"), ("SSN", "123-45-6789"), ("LICENSE_PLATE", "AB-1234"), ("EMAIL", "x@y.com"), ("EMAIL", "z@y.org")], 6: []}


def test_strip_is_python_s(spark):
    rows = ["".join(p) for p in (" \t\u2003x\u3000\x85", "\x1c\x1fa b\x1d\x1e\n", " " * 50_000 + "y", "", "\u200bz")]
    got = [r.s for r in spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i").select(strip(F.col("t")).alias("s")).collect()]
    assert got == [r.strip() for r in rows]


def test_the_last_delivery_does_not_depend_on_the_order_of_rows(spark):
    rows = [("d", 1, "a"), ("d", 2, "b"), ("d", 2, "c"), ("e", 1, "x")]
    got = {tuple(sorted(tuple(r) for r in documents.latest(spark.createDataFrame(own, "doc_id string, at int, text string"), "at").collect())) for own in (rows, rows[::-1])}
    assert len(got) == 1
    with pytest.raises(ValueError, match="names"):
        documents.link_products(spark.createDataFrame([], documents.SCHEMA), spark.createDataFrame([("a", "b"), ("c", "d")], "product_id string, name string"), most=1)


def test_the_command_line_takes_a_model(spark, processed, tmp_path, capsys, monkeypatch):
    (tmp_path / "names.json").write_text("\n".join(json.dumps({"product_id": f"P{i}", "name": f"Kettle {i}"}) for i in range(3)))
    (tmp_path / "told.py").write_text('ASKED = []\ndef reply(system, message):\n    ASKED.append(message)\n    return "no {" if len(ASKED) == 1 else \'{"themes": [], "call_outcomes": [], "contradictions": [], "recommended_actions": [], "coverage_note": "c"}\'\n')
    monkeypatch.syspath_prepend(str(tmp_path))
    own = ["insight", "--processed", processed, "--catalogue", str(tmp_path / "names.json"), "--out", str(tmp_path / "out")]
    assert jobs.main(own) == 0 and "nothing was sent" in capsys.readouterr().out
    assert jobs.main([*own, "--model", "told:reply"]) == 0 and "validation: clean" in capsys.readouterr().out
    import told

    assert len(told.ASKED) == 2 and "Expecting value" in told.ASKED[1] and "Kettle 2" in told.ASKED[0]
    with pytest.raises(ValueError, match="module:name"):
        jobs.model_at("told")
    with pytest.raises(ValueError, match="at the most"):
        jobs.catalogue_names(spark, str(tmp_path / "names.json"), 2)


def test_a_model_is_asked_twice_at_the_most(spark):
    asked = []
    lost = insight.ask(spark, lambda system, message: asked.append(message) or "never", "s", "m").first()
    assert len(asked) == 2 and lost.report is None and "Expecting value" in lost.error


def test_schemas_are_merged_and_drift_is_told(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"id": 1, "tags": ["x"], "in": {"k": 1.5}}\n{"id": 2}\nno json\n')
    (tmp_path / "j" / "b.json").write_text('{"id": "three", "more": true}\n')
    told = {r.source_key.rsplit("/", 1)[-1]: r for r in readers.inferred(readers.variants(spark, str(tmp_path / "j"))).collect()}
    assert all(r.drifts for r in told.values()) and len({r.merged for r in told.values()}) == 1
    assert "id: BIGINT" in told["a.json"].schema and "id: STRING" in told["b.json"].schema
    assert all(part in told["a.json"].merged for part in ("id: VARIANT", "more: BOOLEAN", "tags: ARRAY<STRING>"))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("id,name,n\n1,x,2.5\n2,,3\n")
    (tmp_path / "c" / "b.csv").write_text("id,name,n\n7,y,1.5\n")
    (tmp_path / "c" / "d.csv").write_text("id,name,n\nseven,y,true\n")
    told = {r.source_key.rsplit("/", 1)[-1]: r for r in readers.inferred(readers.variants(spark, str(tmp_path / "c"), "csv")).collect()}
    assert "id: BIGINT" in told["a.csv"].schema and "n: DOUBLE" in told["b.csv"].schema and "name: STRING" in told["a.csv"].schema
    assert told["d.csv"].drifts and "n: VARIANT" in told["d.csv"].merged
