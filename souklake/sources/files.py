"""Driver-side file operations on any Hadoop file system. Names and small markers only, no data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(status.getPath().getName() for status in _fs(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a new small file in one step; fails if it is already there."""
    fs, target = _fs(spark, path), _path(spark, path)
    draft = _path(spark, f"{path}.{spark._jvm.java.util.UUID.randomUUID().toString()}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"{path} was written by someone else meanwhile")


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
