"""Session helpers: a local session for tests and benches, and the shared scratch folder.

The library itself never creates a session; every operator takes DataFrames and returns a
DataFrame.  Staged results live below the session's ``spark.checkpoint.dir``.  A cluster has to
name that folder; a single-machine session without one uses a folder beside its own warehouse.
Every scratch path is marked for deletion when Spark's process ends, and ``release_scratch``
deletes them earlier.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every session of ours carries; a cluster deployer may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site lookups for every column
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cores: int = 8,
    shuffle_partitions: int | None = None,
    app: str = "dialstat",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """Build (or fetch) a local session for tests, benches and the smoke entry.

    :param cores: number of local task threads
    :param shuffle_partitions: defaults to ``cores``
    :param checkpoint_dir: the folder for staged results
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _single_machine(spark: SparkSession) -> bool:
    """``local`` and ``local[n]``: driver and executor are one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    A cluster must name it in ``spark.checkpoint.dir``; a single-machine session without one
    gets a folder beside its warehouse, deleted when Spark's process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _single_machine(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on shared storage for staged results"
            )
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch/{sc.applicationId}"
        _delete_on_exit(spark, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)  # only paths that exist can be marked
    fs.deleteOnExit(target)


_SCRATCH: dict[str, list[str]] = {}


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder (never a machine-local one).

    Deleted by ``release_scratch`` or when Spark's process ends.  The path does not exist yet.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    fs.delete(target, True)  # the mark stays
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_paths(spark: SparkSession, path: str) -> Iterator[str]:
    """The data files at or below a path, one by one; hidden and marker files aside."""
    fs, target = _file_system(spark, path)
    found = fs.listFiles(target, True)
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            yield file.toString()


def parquet_rows(spark: SparkSession, path: str, most_files: int = 16) -> int | None:
    """The rows of a small Parquet table by its files' footers, without a job; None for a table of
    more than ``most_files`` files."""
    files = list(itertools.islice(file_paths(spark, path), most_files + 1))
    if len(files) > most_files:
        return None
    jvm, conf, rows = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for file in files:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            rows += reader.getRecordCount()
        finally:
            reader.close()
    return rows


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store that Spark writes to."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch paths of this session; returns how many there were."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)
