"""Folders on any file system that Spark reads, through Hadoop's file system interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    fs, where = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of the data files below ``path``, from the listing alone."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), f.getLen()))
    return found


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; refused if it is there already."""
    fs, where = _at(spark, path)
    if fs.exists(where):
        raise FileExistsError(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(part, where):
        raise FileExistsError(path)
