"""Small files of the driver (records, listings) on whatever file system a path names.

Only records of a few hundred bytes and listings of folders of bounded number go through
here; tables are always read and written by Spark.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Exists(Exception):
    """The record is already there: somebody else put it in place."""


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder, none if it is not there."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A record's text, None if it is not there."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write a record aside and rename it into place, so that readers see all of it or nothing.
    Without ``replace`` an existing record stays and ``Exists`` is raised."""
    jvm, (fs, p) = spark._jvm, _at(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, how)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise Exists(path) from e
        raise


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put a file in the place of another."""
    fs, p = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.delete(target, False)
    if not fs.rename(p, target):
        raise OSError(f"cannot move {path} to {to}")


def length(spark: SparkSession, path: str) -> int:
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getLen()
