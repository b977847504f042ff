"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, **conf: str) -> SparkSession:
    """A session with the settings results depend on.

    Cluster sizing (executors, shuffle partitions, file split size) is left to
    the submitter; ``conf`` overrides anything set here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder the session names.

    Only a session on one machine may do without; it gets a local temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="yardline-")
    return f"{shared.rstrip('/')}/yardline/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str, *, within: str | None = None, compression: str | None = None) -> DataFrame:
    """Write a result that several branches read to the shared scratch folder, once.

    Unlike cached blocks it outlives lost executors, and its lineage is one file scan. ``within``: a folder of
    ``scratch_dir`` for tables that ``remove_scratch`` takes away together. ``compression``: the session's unless given.
    """
    path = f"{within}/{purpose}-{uuid.uuid4().hex}" if within else scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ``scratch_dir`` once all that was made of its tables is written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
