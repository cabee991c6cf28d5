"""Sinks: append, replace-all, CSV results and the model log.

Each write is a Spark job with the file commit protocol (task retries on lost
executors do not duplicate output).  ``replace_partitions`` uses dynamic
partition overwrite, the Parquet form of "delete this month, insert the file".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sink_append(df: DataFrame, path: str, *, partition_by=None) -> None:
    """Bulk append (nulls written as nulls)."""
    w = df.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def sink_replace_all(df: DataFrame, path: str) -> None:
    """Delete everything then insert.

    The old rows go before the new ones are committed: for a table that must never be seen
    half replaced, put it into a book (``streaming.book.put``).
    """
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by=("report_date",)) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def sink_csv_result(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header (small result tables: a handful of files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def model_log_row(fit_metrics: DataFrame, *, run_date, vintages: str | Column, scores: DataFrame | None = None,
                  periods=()) -> DataFrame:
    """One model-log row: run date, vintages, n, R², betas, SEs and per-period scores as columns.

    Period scores come in as scalar subqueries over the (few-row) score table.
    """
    row = fit_metrics.select(F.lit(run_date).cast("date").alias("run_date"), (vintages if isinstance(vintages, Column) else F.lit(vintages)).alias("vintages"), "*")
    for p in periods if scores is not None else ():
        one = scores.filter(F.col("period") == p)
        row = (row.withColumn(f"rmse_{p}", one.select("model_rmse").scalar())
               .withColumn(f"naive_{p}", one.select("naive_rmse").scalar()))
    return row


def sink_model_log(row: DataFrame, path: str) -> None:
    """Append one row per model run."""
    row.write.mode("append").option("header", "true").csv(path)
