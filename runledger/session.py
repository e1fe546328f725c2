"""Session helpers: the shared folder for written intermediates, and table-safe settings."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions that name none, by application.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own; on a cluster
    that would be a folder the executors cannot see, hence the error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="runledger-")
    return _local_dirs[app]


# Lists that fresh paths are noted in, see recorded_scratch().
_noting: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/runledger/{name}-{uuid.uuid4().hex}"
    for paths in _noting:
        paths.append(path)
    return path


@contextmanager
def recorded_scratch(paths: list[str]):
    """Note in ``paths`` all fresh paths that are asked for in a ``with`` block, so that they can be released."""
    _noting.append(paths)
    try:
        yield
    finally:
        _noting[:] = [p for p in _noting if p is not paths]


def release_scratch(spark: SparkSession, paths: list[str], *still: DataFrame) -> None:
    """Remove the noted folders, but for those that the DataFrames ``still`` read from."""
    read = {f for df in still for f in df.inputFiles()}
    for path in list(paths):
        if not any(path.split("://")[-1] in f for f in read):
            remove(spark, path)
            paths.remove(path)


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, fixes whatever a second run of the plan could decide
    differently (range bounds, generated positions) and survives lost executors.
    Being Parquet, later passes read only the columns they use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one SQL option for the length of a ``with`` block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _file(spark: SparkSession, path: str):
    """File system and path of a file, wherever it lies."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: until it is there, readers find the one before it, or none."""
    fs, there = _file(spark, path)
    _, fresh = _file(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(fresh)
    out.write(text.encode())
    out.close()
    fs.delete(there, False)
    if not fs.rename(fresh, there):
        raise OSError(f"{path} could not be written")


def get_text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds; None if it is not there."""
    fs, there = _file(spark, path)
    if not fs.exists(there):
        return None
    stream = fs.open(there)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it, if it is there."""
    fs, there = _file(spark, path)
    fs.delete(there, True)
