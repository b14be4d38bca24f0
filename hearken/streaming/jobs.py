"""The same transformations on streams. Stages are chained by folders: what one writes, the next reads, each with its own
checkpoint. Batches are written under their number, so a batch that is run again replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.checks import validate_variant_reviews
from ..sources.readers import JOB_EVENT, RULE_EVENT


def distinct_folders(*paths: str) -> None:
    """A stage must not write where it, or a stage before it, reads."""
    own = [p.rstrip("/") + "/" for p in paths]
    for i, a in enumerate(own):
        for j, b in enumerate(own):
            if i != j and a.startswith(b):
                raise ValueError(f"{a} lies in {b}: a stage would read its own output")


def files(spark: SparkSession, path: str, fmt: str, schema: str | None = None, per_batch: int = 1000, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", per_batch).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def start(stream: DataFrame, sinks: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sinks).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def into(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch under its number."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={number}")

    return sink


def validate_stream(spark: SparkSession, raw: str, verdicts: str, checkpoint: str, per_batch: int = 1000) -> StreamingQuery:
    """Raw review files -> verdicts."""
    distinct_folders(raw, verdicts)
    texts = files(spark, raw, "text", per_batch=per_batch, wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_path").alias("source_key"), F.try_parse_json("value").alias("review"))
    judged = validate_variant_reviews(texts).drop("review")
    return start(judged, into(verdicts), checkpoint)


def admit_stream(spark: SparkSession, verdicts: str, raw_reviews: DataFrame, processed: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], delay: str = "7 days") -> StreamingQuery:
    """Verdicts -> processed reviews, joined back to the raw ones by their key. A verdict delivered twice within `delay`, by
    the time its file was written, counts once; what comes later writes the same review again, and state stays bounded."""
    distinct_folders(verdicts, processed)
    schema = "source_key string, checks map<string,boolean>, quality_score double, fatal_failures array<string>, advisory_failures array<string>, admissible boolean"
    admitted = files(spark, verdicts, "parquet", schema, recursiveFileLookup=True).where(F.coalesce("admissible", F.lit(False)))
    admitted = admitted.select("source_key", F.col("_metadata.file_modification_time").alias("written")).withWatermark("written", delay).dropDuplicatesWithinWatermark(["source_key"]).drop("written")
    return start(process(admitted.join(raw_reviews, "source_key")), into(processed), checkpoint)


def admitted_pairs(verdicts: DataFrame, raw: DataFrame, within: str = "7 days", delay: str = "1 hour") -> DataFrame:
    """Two streams, verdicts (source_key, admissible, written) and raw reviews (source_key, review, arrived), joined by their
    key, whichever comes first, if they come within `within` of each other: source_key, review, admissible, version. A
    verdict that is delivered again within `delay` counts once; a corrected one is another version, and so is one that
    withdraws. The state holds `within` and `delay` of either stream, no more."""
    judged = verdicts.withWatermark("written", delay).dropDuplicatesWithinWatermark(["source_key", "admissible"])
    told = judged.select(F.col("source_key").alias("_key"), F.coalesce("admissible", F.lit(False)).alias("admissible"), "written")
    bound = F.expr(f"arrived BETWEEN written - INTERVAL {within} AND written + INTERVAL {within}")
    both = raw.withWatermark("arrived", delay).join(told, (F.col("source_key") == F.col("_key")) & bound)
    return both.select("source_key", "review", "admissible", F.col("written").alias("version"))


def current(versions: DataFrame) -> DataFrame:
    """Of records (source_key, admissible, version) the last version of each key, unless that one withdraws it."""
    last = versions.groupBy("source_key").agg(F.max("version").alias("version"))
    return versions.join(last, ["source_key", "version"]).where("admissible").dropDuplicates(["source_key", "version"])


def admit_pairs_stream(spark: SparkSession, verdicts: str, raw: str, processed: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], within: str = "7 days") -> StreamingQuery:
    """Verdicts and raw review files, both as streams -> versions of processed reviews; `process` keeps source_key, admissible
    and version. `current` tells what holds now. A raw file may come after its verdict."""
    distinct_folders(verdicts, processed)
    distinct_folders(raw, processed)
    schema = "source_key string, admissible boolean"
    judged = files(spark, verdicts, "parquet", schema, recursiveFileLookup=True).select("source_key", "admissible", F.col("_metadata.file_modification_time").alias("written"))
    texts = files(spark, raw, "text", wholetext=True, pathGlobFilter="*.json")
    reviews = texts.select(F.col("_metadata.file_path").alias("source_key"), F.try_parse_json("value").alias("review"), F.col("_metadata.file_modification_time").alias("arrived"))
    return start(process(admitted_pairs(judged, reviews, within)), into(processed), checkpoint)


def correlated_jobs(started: DataFrame, ended: DataFrame, within: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    """Two streams, jobs that began (job_name, started_at and what else is known) and their ends (job_name, status, ts),
    joined while they run: all of the first, with status and ts. A job whose end does not come `within` its start comes out
    UNFINISHED, once the watermark has passed; an end that is delivered again within `delay` counts once, and one that
    comes after its time not at all."""
    own = started.withWatermark("started_at", delay)
    once = ended.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["job_name"])
    told = once.select(F.col("job_name").alias("_name"), "status", "ts")
    bound = F.expr(f"ts BETWEEN started_at AND started_at + INTERVAL {within}")
    both = own.join(told, (F.col("job_name") == F.col("_name")) & bound, "left")
    return both.drop("_name").withColumn("status", F.coalesce("status", F.lit("UNFINISHED")))


def job_events(spark: SparkSession, path: str, **options) -> DataFrame:
    """job_name, status, ts of jobs that ended."""
    events = files(spark, path, "json", JOB_EVENT, **options)
    ended = events.where(F.col("detail.TranscriptionJobStatus").isin("COMPLETED", "FAILED"))
    return ended.select(F.col("detail.TranscriptionJobName").alias("job_name"), F.col("detail.TranscriptionJobStatus").alias("status"), F.col("time").try_cast("timestamp").alias("ts"))


def collected_jobs(events: DataFrame, jobs: DataFrame, delay: str = "1 day") -> DataFrame:
    """Ended jobs with what the jobs table tells of them; an event delivered again within `delay` is dropped."""
    once = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["job_name", "status"])
    return once.join(jobs.drop("status"), "job_name", "left")


def split_sink(path: str, failed: str, is_failed: Column) -> Callable[[DataFrame, int], None]:
    """Two sinks of one stream: records, and failures below their own folder. The batch is made once, for both. A condition
    that is null is no failure."""

    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            into(path)(batch.where(~F.coalesce(is_failed, F.lit(False))), number)
            into(failed)(batch.where(is_failed), number)
        finally:
            batch.unpersist()

    return sink


def rate_stream(events: DataFrame, width: str = "1 hour", delay: str = "1 hour", ts: str = "ts", by: str = "status") -> DataFrame:
    """window_start, status, n of each tumbling window; what comes later than `delay` is not counted."""
    counted = events.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), by, "n")


def ruleset_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """A metric for each ruleset of each event that has a score."""
    from ..operators.metrics import ruleset_metrics

    return ruleset_metrics(files(spark, path, "json", RULE_EVENT, **options), F.col("time").try_cast("timestamp"))


def bronze(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Every event as it came, before anything is made of it."""
    distinct_folders(path, out)
    raw = files(spark, path, "text").select("value", F.col("_metadata.file_path").alias("source_key"), F.current_timestamp().alias("seen"))
    return start(raw, into(out), checkpoint)


def unfinished_jobs(started: DataFrame, ended: DataFrame, now: Column, limit: str = "INTERVAL 6 HOURS") -> DataFrame:
    """Jobs that began over `limit` ago and never ended."""
    return started.where(F.col("started_at") < now - F.expr(limit)).join(ended.select("job_name"), "job_name", "left_anti")
