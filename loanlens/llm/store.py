"""Tables that an operator writes into the shared folder and reads back.

Long plans are cut here: a written table survives the loss of an executor and is
not computed again by the readers that follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlens.session import scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and return the table read back.

    The shuffle files of the write go when it ends (else only when the driver's JVM happens
    to collect its plan): nothing reads them again, as the table is there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Remove a table that ``written`` returned and that nothing reads any more."""
    path = table.inputFiles()[0].rsplit("/", 1)[0] if table.inputFiles() else None
    if path:
        p = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


BATCH_ROWS = 2500  # documents in an Arrow batch: both the executor's JVM and a Python worker hold some at once


def for_documents(spark: SparkSession) -> None:
    """Session settings of the queries here: rows are whole texts, so fewer than usual make a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    for_documents(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def part_bases(df: DataFrame, part: str, total: str) -> DataFrame:
    """(part, base): the sum of ``total`` over all parts before this one.

    Second pass of a two-pass prefix sum: the rows of each part are summed where they
    lie, and only one row per part (a task that wrote the table) meets in one window.
    The result is written, so that Spark knows its size when it chooses how to join it.
    """
    totals = df.groupBy(part).agg(F.sum(total).alias("__total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return written(totals.select(part, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("base")), "bases")
