"""Session helpers.

Library code never creates a session: every operator takes DataFrames.  These
helpers are for tests, the bench and command-line use.  Cluster settings
(checkpoint folder, shuffle partitions) are read from the session when present
and only filled in where unset.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoints once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, driver_memory: str = "8g",
                  app: str = "loanlens", extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster jobs expect (UTC, AQE, no UI)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session, its URI as configured.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is used as
    is.  Only a local master may leave it unset; a fresh scratch folder is then made.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="loanlens-ckpt-", dir=os.environ.get("LOANLENS_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the frames made and run in here go when each action ends, else only when the driver collects their plans.

    For frames with one action: a second would make its shuffles anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def cut(df):
    """Cut the lineage of a small result by a reliable checkpoint into the shared checkpoint folder.

    Used for fit and scorecard frames that later scalar subqueries read several
    times; never a machine-local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
