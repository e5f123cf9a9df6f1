"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app_name: str = "outcomelens", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or return) a session with AQE, skew-join splitting and UTC wall-clock time."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="outcomelens-")
    spark.conf.set(_CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Hadoop removes it when the session ends."""
    path = f"{shared_dir(spark)}/outcomelens-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster without a shared installation the package is sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*filter(None, paths), root])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative trainers cut their lineage here."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


#: Rows that one task of a trainer should hold about.
TASK_ROWS = 1_000_000


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over tasks: one per core at least, one per ``TASK_ROWS`` rows if those are more.

    For input that many passes are to read; a small table may come in one file, and so in one task.
    """
    wanted = -(-df.count() // TASK_ROWS)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, wanted))


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where one result feeds several later jobs: columns stay prunable and a
    lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
