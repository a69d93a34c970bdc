"""Where jobs put intermediate tables.

A cluster names one folder that all executors share in ``spark.checkpoint.dir``.
Where that is unset, a run on one machine (``local`` master) gets a temporary
folder that goes when the process ends; any other run is refused, since its
executors could not see each other's files.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}
_FOLDERS: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def shared_root(spark: SparkSession) -> str:
    configured = _configured(spark)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="tracemill-")
        atexit.register(shutil.rmtree, _FALLBACK[app], ignore_errors=True)
    return _FALLBACK[app]


def run_folder(spark: SparkSession) -> str:
    """One folder for each application, so that its tables can go together."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_root(spark)}/tables-{app}-{uuid.uuid4().hex[:8]}"
    return _FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables, through the file system that their paths name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def purge(spark: SparkSession) -> None:
    """Delete every intermediate table of this application. Results that were
    returned but not read yet go too, so call it when all of them are read."""
    path = _FOLDERS.pop(spark.sparkContext.applicationId, None)
    if path:
        discard(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark) + "/checkpoints")


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and
    survives the loss of executors, unlike a cached block."""
    return Workspace(df.sparkSession).save(df, name, partition_by)


_WRITES = threading.Lock()
_OPEN: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffle_files_go(spark: SparkSession):
    """Once a table is written nothing reads the shuffles behind it: Spark drops
    their files at the end of the write, not when the driver collects garbage.
    Of writes in several threads the first one in sets this, the last one out unsets it."""
    app = spark.sparkContext.applicationId
    with _WRITES:
        depth, before = _OPEN.get(app, (0, spark.conf.get(_CLEANUP, None)))
        _OPEN[app] = depth + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _WRITES:
            depth, before = _OPEN.pop(app)
            if depth > 1:
                _OPEN[app] = depth - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


class Workspace:
    """The intermediate tables of one operator call, dropped one by one when
    their last reader inside the call is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, str] = {}

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        writer = df.write.mode("errorifexists")
        if compression:
            writer = writer.option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffle_files_go(self.spark):
            writer.parquet(path)
        self._paths[name] = path
        # A CHAR-free explicit schema keeps partition columns typed as declared.
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        discard(self.spark, *(self._paths.pop(n) for n in names if n in self._paths))
