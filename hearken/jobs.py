"""Jobs from folder to folder, and their command line: python -m hearken.jobs survey|review|insight|score ...

Each job reads by the readers, applies the operators, writes by the sinks, and returns what it tells as text. A dry run
writes nothing and asks no model."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import documents, insight, providers, redaction, review, surveys
from .sources import readers, sinks

SCORES = "map<string,double>"
#: What lies below each prefix of processed records.
PROCESSED = {
    "reviews": f"original_text string, sentiment string, sentiment_scores {SCORES}, metadata struct<product_id:string,customer_id:string,review_date:string,rating:int>",
    "calls": f"source_audio string, status string, turns array<struct<speaker:string,start_time:double,end_time:double,text:string>>, speakers map<string,struct<role_guess:string,role_method:string>>, sentiment map<string,struct<sentiment:string,scores:{SCORES},truncated:boolean>>",
    "surveys": "row_number:int,customer_id:string,product_id:string,survey_date:string,product_rating:int,service_rating:int,overall_satisfaction:string,rating_satisfaction_gap:double,comments:string,admissible:boolean,issues:array<struct<check:string,severity:string>>",
    "images": "image_key string, full_text string, metadata struct<product_id:string,customer_id:string>",
}


def survey_job(spark: SparkSession, source: str, out: str, dry_run: bool = False) -> str:
    """All CSV files of a folder: records and a summary for each file."""
    raw = surveys.numbered(readers.read_surveys(spark, source), "source_key").drop("position")
    records = surveys.survey_records(raw)
    summary = surveys.survey_summary(records, "source_key")
    if not dry_run:
        sinks.write_survey(records, summary, out)
        summary = spark.read.schema(summary.schema).json(f"{out}/summary")
    return "\n".join(f"{r.source_key}: {r.rows_read} rows, {r.admissible} admissible" for r in summary.orderBy("source_key").toLocalIterator())


def collect_documents(spark: SparkSession, root: str) -> DataFrame:
    """The documents of all processed records below a root's prefixes; a prefix that is not there has none."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    parts = []
    for kind, schema in PROCESSED.items():
        path = f"{root.rstrip('/')}/{kind}"
        place = hadoop.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            own = readers.read_survey_results(spark, path, schema) if kind == "surveys" else readers.read_processed(spark, [path], schema)
            parts.append(documents.normalise(own, f"{kind}/"))
    if not parts:
        raise FileNotFoundError(f"no processed records below {root}")
    return documents.unified(*parts)


def review_job(spark: SparkSession, docs: DataFrame, planted: DataFrame, out: str, dry_run: bool = False) -> str:
    """Routes of all documents, their summary, the score against planted doc_ids, and three metrics."""
    judged = review.verdicts(docs)
    flagged = judged.where("route = 'review_queue'").select("doc_id")
    summary, score = review.review_summary(judged), review.truth_score(flagged, planted)
    if not dry_run:
        sinks.write_review(judged, summary, score, out)
        value = F.inline(F.array(*(F.struct(F.lit(name).alias("metric"), F.coalesce(F.col(c), F.lit(0)).cast("double").alias("value")) for name, c in (("MismatchRate", "mismatch_rate"), ("RecordsFlagged", "flagged"), ("RecordsEscalatedToFM", "escalate_to_fm")))))
        told = summary.select(value).withColumn("ts", F.current_timestamp())
        sinks.append_metrics(told, f"{out}/metrics")
    lines = [json.dumps(summary.first().asDict(), indent=2), "scored against the planted mismatches:"]
    lines += [f"  {k}: {v}" for k, v in score.first().asDict().items()]
    return "\n".join([*lines, *["nothing written (dry run)"] * dry_run])


def insight_job(spark: SparkSession, docs: DataFrame, catalogue: dict[str, str], out: str, model: insight.InsightModel | None = None, dry_run: bool = False, redact: bool = True, most: int = 5000) -> str:
    """The batch is chosen, redacted, told to a model, and its report checked. Tells the manifest, the prompt's size, and
    what is wrong with the report."""
    sent = documents.admissible_batch(docs)
    held = documents.manifest(docs)
    if redact:
        own = redaction.redact_documents(sent, providers.pattern_spans, None)
        found = redaction.tally(own).agg(F.array_sort(F.collect_list(F.struct("kind", "name", "n"))).alias("pii_redaction"))
        held = held.join(found)
        sent = own.drop("pii_redacted", "pii_allowlisted", "allowlisted_spans")
    held = held.withColumn("signals_withheld", F.array(*map(F.lit, insight.INFERRED)))
    known = insight.strip_inferred_signals(sent)
    message = insight.user_message(known, held, catalogue, most=most).first()["message"]
    lines = [held.select(F.to_json(F.struct("*"))).first()[0], f"PII redaction: {'done' if redact else 'skipped'}", f"prompt size: {len(message)} characters"]
    if dry_run or model is None:
        return "\n".join([*lines, "nothing was sent (dry run)"])
    report = insight.ask(spark, model, insight.system_prompt(), message).cache()
    sinks.write_report(report, out)
    if report.where("report is null").head(1):
        return "\n".join([*lines, "the model gave no JSON, twice; its reply is kept"])
    problems = report.select(insight.report_problems(F.col("report")).alias("p")).first()["p"]
    unknown = sorted(r.doc_id for r in insight.hallucinated(insight.cited_ids(insight.typed_report(report)), known).collect())
    problems += [f"cited, but NOT in the batch: {', '.join(unknown)}"] if unknown else []
    return "\n".join([*lines, f"validation: {'; '.join(problems) or 'clean'}"])


def score_job(spark: SparkSession, report: str, expected: DataFrame, keywords: DataFrame, controls: DataFrame, planted: DataFrame, batch: DataFrame | None = None) -> tuple[str, bool]:
    """A stored report against the truth: recall of the expected issues, issues made up for control products, planted
    contradictions, citations. The text, and whether all is well."""
    stored = spark.read.option("wholetext", True).text(report).select(insight.unwrapped(F.parse_json("value")).alias("report"))
    typed = insight.typed_report(stored)
    themes = typed.select(F.inline("themes"))
    recall = insight.theme_recall(expected, themes, keywords)
    invented = insight.invented_issues(themes, controls)
    cited = typed.select(F.explode("contradictions").alias("c")).select(F.explode("c.doc_ids").alias("doc_id"))
    unknown = insight.hallucinated(insight.cited_ids(typed), batch) if batch is not None else themes.select(F.lit("").alias("doc_id")).where("false")
    end = insight.verdict(recall, invented, unknown).first()
    lines = [f"{'FOUND ' if r.found else 'MISSED'} {r.product_id} ({r.issue})" + (f": {r.theme}, {', '.join(r.channels or [])}, {r.docs} documents" if r.found else "") for r in recall.orderBy("product_id").collect()]
    lines += [f"INVENTED {r.product_id} {r.severity}: {r.theme}" for r in invented.collect()]
    lines += [f"contradiction {r.outcome}: {r.doc_id}" for r in review.truth_sets(cited, planted).orderBy("outcome", "doc_id").collect()]
    lines += [f"themes without documents: {insight.uncited_themes(themes).count()}", f"hallucinated: {end.hallucinated}"]
    lines += [f"product_link_basis {r.product_link_basis}: {r.n}" for r in insight.link_bases(themes).orderBy("product_link_basis").collect()]
    return "\n".join([*lines, f"VERDICT: {end.verdict}"]), end.verdict == "PASS"


def catalogue_names(spark: SparkSession, path: str, most: int = 10_000) -> dict[str, str]:
    """product_id and name of a catalogue that a prompt has whole; one of over `most` products is refused."""
    rows = spark.read.json(path).select("product_id", "name").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a prompt takes {most} products at the most: choose a catalogue")
    return {r.product_id: r.name for r in rows}


def model_at(place: str) -> insight.InsightModel:
    """The callable at module:name, which takes a system prompt and a message and gives the model's reply."""
    module, _, name = place.partition(":")
    found = getattr(importlib.import_module(module), name, None) if name else None
    if not callable(found):
        raise ValueError(f"no callable at {place}: give module:name")
    return found


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="hearken.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, words in {"survey": ("--input-dir", "--output-dir"), "review": ("--processed", "--truth", "--out"), "insight": ("--processed", "--catalogue", "--out"), "score": ("--report", "--truth", "--keywords")}.items():
        own = jobs.add_parser(name)
        for word in words:
            own.add_argument(word, required=True)
        if name != "score":
            own.add_argument("--dry-run", action="store_true")
        if name == "insight":
            own.add_argument("--no-redact", action="store_true")
            own.add_argument("--model", help="module:name of a callable (system, message) -> reply; without one nothing is sent")
    a = parser.parse_args(arguments)
    from .session import session

    spark = session()
    well = True
    if a.job == "survey":
        told = survey_job(spark, a.input_dir, a.output_dir, a.dry_run)
    elif a.job == "review":
        truth = readers.read_truth(spark, a.truth)
        told = review_job(spark, collect_documents(spark, a.processed), truth.select(F.explode("planted_rating_mismatches").alias("doc_id")), a.out, a.dry_run)
    elif a.job == "insight":
        model = model_at(a.model) if a.model else None
        names = catalogue_names(spark, a.catalogue)
        told = insight_job(spark, collect_documents(spark, a.processed), names, a.out, model, a.dry_run, not a.no_redact)
    else:
        truth, known = readers.read_truth(spark, a.truth), readers.read_truth(spark, a.keywords)
        expected = truth.select(F.inline("expected_themes")).select("product_id", "issue")
        told, well = score_job(spark, a.report, expected, known.select("product_id", "keyword"), truth.select(F.explode("controls").alias("product_id")), truth.select(F.explode("planted_rating_mismatches").alias("doc_id")))
    print(told)
    return 0 if well else 1


if __name__ == "__main__":
    raise SystemExit(main())
