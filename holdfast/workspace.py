"""Where jobs keep tables between steps: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: One folder for everything this process writes between steps.
_RUN = f"run-{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``.

    Only a session that runs in one local process may leave it unset: its driver is its executor, so
    a local folder is shared. Anything else must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="holdfast-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/holdfast/{_RUN}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the run's folder."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Delete the run's folder. Results that still read from it must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
