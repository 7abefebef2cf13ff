"""Sessions and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks. Cluster jobs bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trackloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Without call sites for error messages a column costs half the Python time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A machine-local folder is used only when nothing is set and the session is
    local; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        # One process alone: "local" or "local[...]", but not "local-cluster[...]".
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="trackloom-")


# Where the open run scope of a session keeps its files.
_SCOPE = "spark.trackloom.scope"


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, through Spark's file systems."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; ``target`` must not exist."""
    files, place = _file_system(spark, source)
    if not files.rename(place, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """Own all scratch files that are made inside the block, and remove them at its end.

    Results must be written or collected inside, as relations that read scratch files end with
    them. Scopes may be nested: each owns what is made while it is the innermost. A run that dies
    leaves its folder to :func:`expire_scratch`.
    """
    folder = f"{shared_folder(spark)}/trackloom/run-{uuid.uuid4().hex}"
    outer = spark.conf.get(_SCOPE, None)
    spark.conf.set(_SCOPE, folder)
    try:
        yield folder
    finally:
        spark.conf.set(_SCOPE, outer) if outer else spark.conf.unset(_SCOPE)
        remove(spark, folder)


def expire_scratch(spark: SparkSession, seconds: float) -> int:
    """Remove scratch that was last changed more than ``seconds`` ago; the number of folders removed."""
    files, top = _file_system(spark, f"{shared_folder(spark)}/trackloom")
    if not files.exists(top):
        return 0
    before = (time.time() - seconds) * 1000

    def changed(status) -> int:
        """When anything in a run's folder was changed: its tables lie one level below."""
        inner = files.listStatus(status.getPath()) if status.isDirectory() else []
        return max([status.getModificationTime(), *(s.getModificationTime() for s in inner)])

    old = [s for s in files.listStatus(top) if changed(s) < before]
    for status in old:
        files.delete(status.getPath(), True)
    return len(old)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses, below the open run scope if there is one."""
    folder = spark.conf.get(_SCOPE, None) or f"{shared_folder(spark)}/trackloom"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative MLlib fits cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For relations that several jobs read: the columns stay prunable, the lineage
    ends here, and a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
