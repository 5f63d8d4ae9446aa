"""Small files on the shared file system: markers and manifests.

They go through Hadoop's file API, so that every path Spark reads works here
too.  Only names and small files pass through the driver."""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where it is missing."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def modified(spark: SparkSession, path: str) -> float:
    """Time of the last change in seconds."""
    return _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that is there whole or not at all, and only if ``path`` is
    not there yet: a hidden file beside it, renamed without overwriting.
    ``FileExistsError`` where someone else was first."""
    from py4j.protocol import Py4JJavaError
    sc = spark.sparkContext
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    stream = _fs(spark, path).create(_path(spark, hidden))
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs = sc._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_fs(spark, path).getUri(), sc._jsc.hadoopConfiguration())
    never = sc._gateway.new_array(fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, hidden), _path(spark, path), never)
    except Py4JJavaError as e:
        delete(spark, hidden)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise
