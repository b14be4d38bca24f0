"""Writers. Output is partitioned by day, or by source; failures go to a place of their own; writing a key again replaces
it, so that a message delivered twice does no harm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_records(df: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Overwrites only the partitions that `df` has rows for."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    if by:
        writer = writer.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_split(df: DataFrame, failed: Column, path: str, fmt: str = "json") -> None:
    """Records, and below _failed/ those that failed."""
    write_records(df.where(~failed), path, fmt)
    write_records(df.where(failed), f"{path.rstrip('/')}/_failed", fmt)


def write_survey(records: DataFrame, summary: DataFrame, path: str) -> None:
    """Both parts of a survey's result."""
    write_records(records, f"{path}/records")
    write_records(summary, f"{path}/summary", "json")


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.withColumn("dt", F.to_date("ts")).write.mode("append").partitionBy("dt").parquet(path)


def write_review(verdicts: DataFrame, summary: DataFrame, score: DataFrame, path: str) -> None:
    """Summary, score, the review queue, what was escalated, and all verdicts."""
    write_records(summary, f"{path}/summary", "json")
    write_records(score, f"{path}/score", "json")
    write_records(verdicts, f"{path}/verdicts", by=("route",))


def write_report(report: DataFrame, path: str) -> None:
    """One JSON file; a reply that is no report is kept as it came, under raw/."""
    write_records(report.where("report is not null").coalesce(1), f"{path}/report", "json")
    write_records(report.where("report is null").select("raw").coalesce(1), f"{path}/raw", "json")


def write_requests(designs: DataFrame, path: str) -> None:
    write_records(designs, path, "json", by=("design",))


def dry_run(df: DataFrame) -> str:
    """The plan, without running it."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
