"""Session defaults, the shared work folder, file checks."""
from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows a side may have to be broadcast. Annotation rows are a few dozen bytes, so this stays near 100 MB.
BROADCAST_ROWS = 1_000_000

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed side even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def with_defaults(builder):
    """Add the engine's settings to a session builder; master, memory and partition counts stay with the caller."""
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


@functools.cache
def _local_root(application: str) -> str:
    """One temporary folder for a local application; the setting itself cannot be changed in a running session."""
    root = tempfile.mkdtemp(prefix="cohortqc-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written intermediate tables.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``, which every executor can reach. A session
    that names none may use a temporary folder only in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, without lineage, safe from lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
