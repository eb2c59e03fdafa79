"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_scratch: list[str] = []


def build_session(app: str = "zonepulse", master: str | None = None, **conf) -> SparkSession:
    """A session with the runtime re-planning features the operators count on.

    AQE picks join strategies from measured shuffle sizes, splits skewed join
    partitions and merges small ones, so no fixed partition count is set here:
    pass ``spark.sql.shuffle.partitions`` for the cluster at hand.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` wins; a directory already set on the context comes
    next; only where neither exists and all runs on one machine is a temporary one made,
    which goes with the process. On a cluster a missing folder is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="zonepulse-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for a write-then-read step."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the sub-folders that ``scratch_path`` has given out so far. For the end of a
    job, when no frame that reads them is used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame, files: int | None = None) -> DataFrame:
    """Evaluate once into a table in the shared folder and cut the lineage there.

    A lost executor costs nothing that was stored. The table is columnar, its row
    count comes from the file footers, and the planner sees its true size. ``files``
    bounds their number where the table is known to be small for its partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
