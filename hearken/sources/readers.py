"""Readers. Each has an explicit schema, names the file that a record came from, and lists files by Spark alone, so any
store that Spark reads will do."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode_event_key

SURVEY_COLUMNS = ("customer_id", "product_id", "survey_date", "product_rating", "service_rating", "overall_satisfaction", "improvement_area", "comments")
SPAN = "struct<Score:double,Type:string,Text:string,BeginOffset:int,EndOffset:int>"
BLOCK = "struct<Id:string,BlockType:string,Text:string,EntityTypes:array<string>,Relationships:array<struct<Type:string,Ids:array<string>>>>"
TRANSCRIPT = "jobName string, results struct<transcripts:array<struct<transcript:string>>,audio_segments:array<struct<speaker_label:string,transcript:string,start_time:string,end_time:string>>>"
JOB = "TranscriptionJob struct<TranscriptionJobName:string,TranscriptionJobStatus:string,Media:struct<MediaFileUri:string>,Transcript:struct<TranscriptFileUri:string>,FailureReason:string>"
JOB_EVENT = "source string, `detail-type` string, time string, detail struct<TranscriptionJobName:string,TranscriptionJobStatus:string>"
RULE_EVENT = "source string, `detail-type` string, time string, detail struct<resultId:string,context:struct<runId:string,databaseName:string,tableName:string>,rulesetNames:array<string>,state:string,score:double,numRulesSucceeded:int,numRulesFailed:int,numRulesSkipped:int>"
OBJECT_EVENT = "Records array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>"


def path_of() -> Column:
    return F.col("_metadata.file_path")


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """source_key, review (a variant, so the types of JSON stay); one object a file. Files that are no JSON have null."""
    raw = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return raw.select(path_of().alias("source_key"), F.try_parse_json("value").alias("review"))


def read_surveys(spark: SparkSession, path: str) -> DataFrame:
    """source_key, position, and eight string columns of all CSV files, .csv in any case, found by their names in each
    file's header, whatever their order; columns that a file has not, and blank cells, are empty strings. A row's cells
    beyond the header are left out. A header is one line; empty files have no rows. No file raises FileNotFoundError."""
    options = dict(multiLine=True, escape='"', pathGlobFilter="*.[cC][sS][vV]")
    lines = spark.read.option("pathGlobFilter", options["pathGlobFilter"]).text(path)
    if not lines.inputFiles():
        raise FileNotFoundError(f"no CSV found in {path}")
    # Files that share a header are read as one; there are as many reads as there are different headers.
    at = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    firsts = lines.select(path_of().alias("file"), at.alias("at"), "value").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    heads = firsts.groupBy("head").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()
    parts = []
    for row in sorted(heads, key=lambda r: r["files"]):
        names = [n.strip() for n in next(csv.reader([row["head"].lstrip("\ufeff")]), [])] or ["_"]
        own = [n if names.index(n) == i else f"_{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in own])
        raw = spark.read.schema(schema).options(header=True, enforceSchema=True, **options).csv(row["files"])
        cells = [F.coalesce(F.col(f"`{c}`") if c in own else F.lit(None).cast("string"), F.lit("")).alias(c) for c in SURVEY_COLUMNS]
        parts.append(raw.select(path_of().alias("source_key"), F.monotonically_increasing_id().alias("position"), *cells))
    return reduce(DataFrame.unionByName, parts)


def read_survey_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """source_key and the records of survey result files, each an object whose `records` is an array of `schema`'s fields."""
    raw = spark.read.schema(f"records array<struct<{schema}>>").options(multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json").json(path)
    return raw.select(path_of().alias("source_key"), F.explode("records").alias("r")).select("source_key", "r.*").where(~F.contains("source_key", F.lit("/_failed/")))


def read_processed(spark: SparkSession, paths: list[str], schema: str, one_per_file: bool = True) -> DataFrame:
    """source_key and the records below several prefixes, one a file or one a line; what lies under _failed/ is no feedback."""
    raw = spark.read.schema(schema).options(multiLine=one_per_file, recursiveFileLookup=True, pathGlobFilter="*.json").json(paths)
    return raw.withColumn("source_key", path_of()).where(~F.contains("source_key", F.lit("/_failed/")))


def failed_count(spark: SparkSession, paths: list[str]) -> DataFrame:
    """failed: how many record files lie under _failed/, which a listing from above passes over as hidden."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    below = [hadoop.Path(f"{p.rstrip('/')}/_failed") for p in paths]
    there = [str(p) for p in below if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)]
    if not there:
        return spark.range(1).select(F.lit(0).cast("long").alias("failed"))
    raw = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.json").text(there, wholetext=True)
    return raw.agg(F.count("*").alias("failed"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """call_id (the file's stem), full_transcript, results."""
    from ..functions.text import stem

    raw = spark.read.schema(TRANSCRIPT).options(multiLine=True, pathGlobFilter="*.json").json(path)
    return raw.select(stem(path_of()).alias("call_id"), path_of().alias("transcript_key"), F.col("results.transcripts")[0]["transcript"].alias("full_transcript"), "results")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """image_key, pos and the fields of each OCR block."""
    from ..functions.text import stem

    raw = spark.read.schema(f"Blocks array<{BLOCK}>").options(multiLine=True, pathGlobFilter="*.json").json(path)
    return raw.select(stem(path_of()).alias("image_key"), F.posexplode("Blocks").alias("pos", "b")).select("image_key", "pos", "b.*")


def read_media(spark: SparkSession, path: str) -> DataFrame:
    """source_key, bytes, modified of media files; their content is never loaded."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("source_key"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """job_name, status, source_audio, transcript_uri, failure_reason of job descriptions."""
    from ..functions.text import object_address

    job = spark.read.schema(JOB).options(multiLine=True).json(path).select("TranscriptionJob.*")
    return job.select(F.col("TranscriptionJobName").alias("job_name"), F.col("TranscriptionJobStatus").alias("status"), object_address(F.col("Media.MediaFileUri"))["key"].alias("source_audio"), F.col("Transcript.TranscriptFileUri").alias("transcript_uri"), F.col("FailureReason").alias("failure_reason"))


def object_events(events: DataFrame) -> DataFrame:
    """bucket, key of object-created notifications; keys are decoded."""
    record = events.select(F.explode("Records").alias("r"))
    return record.select(F.col("r.s3.bucket.name").alias("bucket"), decode_event_key(F.col("r.s3.object.key")).alias("key"))


def matching(events: DataFrame, source: str | None = None, detail_type: str | None = None, **detail: list[str]) -> DataFrame:
    """Bus events that fit a pattern: source, detail-type, and fields of detail."""
    out = events
    if source:
        out = out.where(F.col("source") == source)
    if detail_type:
        out = out.where(F.col("`detail-type`") == detail_type)
    for name, values in detail.items():
        out = out.where(F.col(f"detail.{name}").isin(*values))
    return out


def triggered(keys: DataFrame, prefix: str, suffix: str, column: str = "key") -> DataFrame:
    """Keys under a prefix with a suffix, as notification filters select them."""
    return keys.where(F.startswith(F.col(column), F.lit(prefix)) & F.endswith(F.col(column), F.lit(suffix)))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def _typed(cell: Column) -> Column:
    """A CSV cell as a variant: a whole number, a number, a truth value, or else a string; a blank one is null."""
    own = F.trim(cell)
    as_variant = lambda value: F.variant_get(F.to_variant_object(F.struct(value.alias("v"))), "$.v", "variant")
    whole, number, truth = own.try_cast("bigint"), own.try_cast("double"), own.try_cast("boolean")
    known = F.when(own.rlike(r"^[+-]?\d+$") & whole.isNotNull(), as_variant(whole)).when(own.rlike(r"^[+-]?[\d.]+([eE][+-]?\d+)?$") & number.isNotNull(), as_variant(number))
    return known.when(F.lower(own).isin("true", "false"), as_variant(truth)).when(own != "", as_variant(cell))


def variants(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """source_key, record: the records below a path as variants; JSON is one object a line, CSV has a header in each file."""
    if fmt == "json":
        raw = spark.read.options(**options).text(path)
        return raw.select(path_of().alias("source_key"), F.try_parse_json("value").alias("record")).where("record is not null")
    raw = spark.read.format(fmt).options(**{"header": True, "inferSchema": False, **options}).load(path)
    if fmt != "csv":
        return raw.select(path_of().alias("source_key"), F.to_variant_object(F.struct(*raw.columns)).alias("record"))
    typed = F.to_variant_object(F.struct(*(_typed(F.col(f"`{c}`")).alias(c) for c in raw.columns)))
    return raw.select(path_of().alias("source_key"), typed.alias("record"))


def inferred(records: DataFrame) -> DataFrame:
    """source_key, schema, merged, drifts: the schema of each file's records (source_key, record), that of all of them, and
    whether the file's differs from it. Schemas of records are merged where they are read, those of files where files meet;
    a field that has types without a common one is a VARIANT."""
    own = records.groupBy("source_key").agg(F.schema_of_variant_agg("record").alias("schema"))
    merged = records.agg(F.schema_of_variant_agg("record").alias("merged"))
    return own.join(F.broadcast(merged)).withColumn("drifts", F.col("schema") != F.col("merged"))  # merged: one row


def register(spark: SparkSession, path: str, fmt: str = "csv", **options) -> str:
    """Infers a schema and registers a view named by the path's last segment; the name."""
    name = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0].replace("-", "_").lower()
    spark.read.format(fmt).options(header=True, inferSchema=True, **options).load(path).createOrReplaceTempView(name)
    return name
