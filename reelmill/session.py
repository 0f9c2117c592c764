"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# forceOptimizeSkewedJoin lets AQE split a hot join key even where the split costs one more shuffle
# (a join followed by a group-by on the same key), which it would otherwise refuse.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "reelmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in {**SETTINGS, **given}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is set, in local mode only: on a cluster a
    machine-local folder would be lost with its machine, so that case is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="reelmill-")
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder, which can be removed as a
    whole when the application has ended."""
    root = shared_folder(spark).rstrip("/")
    return f"{root}/reelmill-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Freeze a result as a table in the shared folder, so that a lost executor cannot change it.

    Needed where two later steps must see the very same rows, as with range partitions, whose bounds
    come from a sample. Later steps read only the columns they use.
    """
    path = fresh_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
