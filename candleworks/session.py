"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "candleworks", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without one (as in tests) takes a temporary folder of this
    machine, and sets it so that later calls share it; on a cluster that is an error,
    since executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="candleworks-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to a table of the work root and read back.

    For results that several outputs use: they are computed once, and a lost executor
    costs a new scan of that table instead of the whole lineage.
    """
    path = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the work root that no other run uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of this library's own, wherever it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
