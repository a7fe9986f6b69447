"""Session settings and the shared scratch area for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "riskspark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Prompts can be long texts, so a batch sent to Python holds few of them.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("_", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local path would be lost with
    its executor, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskspark-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application has written under the shared folder.

    Results are scans of written tables until they are consumed, so this belongs at the end of a job, before the session
    is stopped.
    """
    folder = f"{checkpoint_root(spark)}/riskspark-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, unique per call and grouped per application."""
    return f"{checkpoint_root(spark)}/riskspark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    Cuts lineage so that an expensive input read several times is computed once, survives the loss of any executor,
    and keeps column pruning and filter pushdown for the later readers.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
