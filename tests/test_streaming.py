"""Streams give what batches give."""

import json

import pytest
from pyspark.sql import functions as F

from hearken.operators import checks
from hearken.sources import readers
from hearken.streaming import jobs

from .test_goldens import DATA


def test_validate_then_admit(spark, tmp_path):
    raw, seen, done = str(DATA / "reviews"), str(tmp_path / "seen"), str(tmp_path / "done")
    jobs.validate_stream(spark, raw, seen, str(tmp_path / "c1"), per_batch=6).awaitTermination()
    batch = checks.validate_variant_reviews(readers.read_reviews(spark, raw))
    key = ["source_key", "quality_score", "admissible"]
    assert sorted(spark.read.parquet(seen).select(key).collect()) == sorted(batch.select(key).collect())
    jobs.admit_stream(spark, seen, readers.read_reviews(spark, raw), done, str(tmp_path / "c2"), lambda df: df.select("source_key", F.try_variant_get("review", "$.product_id", "string").alias("product_id"))).awaitTermination()
    assert spark.read.parquet(done).count() == 17
    jobs.validate_stream(spark, raw, seen, str(tmp_path / "c1"), per_batch=6).awaitTermination()  # nothing new
    assert spark.read.parquet(seen).count() == 20


def event(name, status, time):
    return json.dumps({"source": "aws.transcribe", "detail-type": "Transcribe Job State Change", "time": time, "detail": {"TranscriptionJobName": name, "TranscriptionJobStatus": status}})


def test_job_events(spark, tmp_path):
    where = tmp_path / "events"
    where.mkdir()
    (where / "1.json").write_text("\n".join([event("j1", "COMPLETED", "2026-01-01T10:00:00Z"), event("j2", "FAILED", "2026-01-01T10:20:00Z"), event("j3", "IN_PROGRESS", "2026-01-01T10:30:00Z"), event("j1", "COMPLETED", "2026-01-01T10:00:01Z")]))
    (where / "2.json").write_text(event("j4", "COMPLETED", "2026-01-01T13:00:00Z"))
    known = spark.createDataFrame([("j1", "a.mp3", "x"), ("j2", "b.mp3", "x"), ("j4", "d.mp3", "x")], "job_name string, source_audio string, status string")
    out, failed = str(tmp_path / "out"), str(tmp_path / "failed")
    stream = jobs.collected_jobs(jobs.job_events(spark, str(where)), known)
    jobs.start(stream, jobs.split_sink(out, failed, F.col("status") == "FAILED"), str(tmp_path / "c")).awaitTermination()
    assert sorted((r.job_name, r.source_audio) for r in spark.read.parquet(out).collect()) == [("j1", "a.mp3"), ("j4", "d.mp3")]
    assert [r.job_name for r in spark.read.parquet(failed).collect()] == ["j2"]
    rates = jobs.rate_stream(jobs.job_events(spark, str(where), per_batch=1))
    q = rates.writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.status, r.n) for r in spark.table("rates").collect()) == [("COMPLETED", 1), ("COMPLETED", 2), ("FAILED", 1)]
    ended = spark.read.parquet(out)
    started = spark.createDataFrame([("j1", "2026-01-01 09:00:00"), ("j9", "2026-01-01 01:00:00"), ("j8", "2026-01-01 11:00:00")], "job_name string, t string").select("job_name", F.col("t").cast("timestamp").alias("started_at"))
    assert [r.job_name for r in jobs.unfinished_jobs(started, ended, F.lit("2026-01-01 12:00:00").cast("timestamp")).collect()] == ["j9"]


def test_rulesets_and_bronze(spark, tmp_path):
    where = tmp_path / "dq"
    where.mkdir()
    (where / "1.json").write_text(json.dumps({"time": "2026-01-01T10:00:00Z", "detail": {"score": 0.8, "rulesetNames": ["a", "b"], "state": "FAILED"}}))
    q = jobs.ruleset_stream(spark, str(where)).writeStream.format("memory").queryName("dq").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.dims["Ruleset"], r.value) for r in spark.table("dq").collect()) == [("a", 0.8), ("b", 0.8)]
    jobs.bronze(spark, str(where), str(tmp_path / "raw"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1


def test_folders_must_differ():
    with pytest.raises(ValueError):
        jobs.distinct_folders("/a/b", "/a/b/c")
    jobs.distinct_folders("/a/b", "/a/bc")


def test_event_sources(spark):
    raw = spark.createDataFrame([('{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"raw-data/calls/my+call+001.mp3"}}}]}',)], "t string")
    keys = readers.object_events(raw.select(F.from_json("t", readers.OBJECT_EVENT).alias("e")).select("e.*"))
    assert keys.first().key == "raw-data/calls/my call 001.mp3"
    assert readers.triggered(keys, "raw-data/calls/", ".mp3").count() == 1 and readers.triggered(keys, "raw-data/images/", ".png").count() == 0
    events = spark.createDataFrame([(event("j", "COMPLETED", "2026-01-01T10:00:00Z"),)], "t string").select(F.from_json("t", readers.JOB_EVENT).alias("e")).select("e.*")
    assert readers.matching(events, "aws.transcribe", TranscriptionJobStatus=["COMPLETED", "FAILED"]).count() == 1
    assert readers.matching(events, "aws.glue").count() == 0


def rows_of(spark, folder, schema, batches):
    """A stream of files, one a batch, in order; each gets a later time than the one before."""
    import os
    import time

    folder.mkdir()
    for i, batch in enumerate(batches):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(row) for row in batch))
        os.utime(path, (time.time() - 1000 + i,) * 2)
    return jobs.files(spark, str(folder), "json", schema, per_batch=1)


def test_jobs_that_end_late_twice_or_never(spark, tmp_path):
    at = lambda hour: f"2026-01-01T{hour:02d}:00:00Z"
    began = [[{"job_name": n, "started_at": at(1), "source_audio": n + ".mp3"} for n in ("ends", "twice", "fails", "never", "late")], [{"job_name": "next", "started_at": at(10), "source_audio": "x"}], [{"job_name": "last", "started_at": at(23), "source_audio": "y"}]]
    end = lambda name, status, hour: {"job_name": name, "status": status, "ts": at(hour)}
    ended = [[end("ends", "COMPLETED", 2), end("twice", "COMPLETED", 3), end("twice", "COMPLETED", 3), end("unknown", "COMPLETED", 2)], [end("fails", "FAILED", 4), end("twice", "COMPLETED", 3), end("late", "COMPLETED", 9)], [end("next", "COMPLETED", 11), end("other", "COMPLETED", 23)]]
    starts = rows_of(spark, tmp_path / "began", "job_name string, started_at timestamp, source_audio string", began)
    ends = rows_of(spark, tmp_path / "ended", "job_name string, status string, ts timestamp", ended)
    out = str(tmp_path / "out")
    jobs.start(jobs.correlated_jobs(starts, ends), jobs.into(out), str(tmp_path / "c")).awaitTermination()
    got = sorted((r.job_name, r.status, r.source_audio) for r in spark.read.parquet(out).collect())
    assert got == [("ends", "COMPLETED", "ends.mp3"), ("fails", "FAILED", "fails.mp3"), ("late", "UNFINISHED", "late.mp3"), ("never", "UNFINISHED", "never.mp3"), ("next", "COMPLETED", "x"), ("twice", "COMPLETED", "twice.mp3")]


def test_raw_files_after_their_verdicts_and_corrections(spark, tmp_path):
    raw, seen, done, state = (str(tmp_path / d) for d in ("raw", "seen", "done", "c"))
    (tmp_path / "raw").mkdir()

    def put(name):
        (tmp_path / "raw" / f"{name}.json").write_text(json.dumps({"product_id": name}))

    def tell(*verdicts):
        rows = [(f"file:{tmp_path}/raw/{name}.json", good) for name, good in verdicts]  # as a stream of files tells it
        spark.createDataFrame(rows, "source_key string, admissible boolean").coalesce(1).write.mode("append").parquet(seen)

    def run():
        product = F.try_variant_get("review", "$.product_id", "string").alias("product_id")
        jobs.admit_pairs_stream(spark, seen, raw, done, state, lambda df: df.select("source_key", "admissible", "version", product)).awaitTermination()
        return {r.product_id for r in jobs.current(spark.read.parquet(done)).collect()}

    put("a")
    put("b")
    tell(("a", True), ("b", False), ("late", True))
    assert run() == {"a"}
    put("late")  # its verdict is there already
    assert run() == {"a", "late"}
    n = spark.read.parquet(done).count()
    tell(("a", True))  # delivered again
    assert run() == {"a", "late"} and spark.read.parquet(done).count() == n
    tell(("b", True))  # corrected
    tell(("a", False))  # withdrawn
    assert run() == {"b", "late"}
