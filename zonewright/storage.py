"""Small files and paths of any file system that Hadoop knows, through the driver's JVM."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def join(folder: str, *parts: str) -> str:
    """A path below another; unlike ``pathlib`` it leaves a scheme such as ``s3://`` as it is."""
    return "/".join([folder.rstrip("/"), *parts])


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isFile()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it; a missing path is no error."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The whole of a small file."""
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, written beside its place and then moved there: readers see all of it or none."""
    fs, where = _at(spark, path)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    stream = fs.create(_at(spark, part)[1])
    stream.write(content)
    stream.close()
    if fs.exists(where):
        fs.delete(where, True)
    if not fs.rename(_at(spark, part)[1], where):
        raise OSError(f"cannot move {part} to {path}")


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put ``new`` in the place of ``path``."""
    fs, where = _at(spark, path)
    fs.delete(where, True)
    if not fs.rename(_at(spark, new)[1], where):
        raise OSError(f"cannot move {new} to {path}")
