"""Folders and small files through the Hadoop file system of the session."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty when the folder is absent."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.delete(target, True)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 when the entry was last changed."""
    fs, target = _open(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file whole or not at all; False when there is one of that name already."""
    jvm = spark.sparkContext._jvm
    fs, target = _open(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    # A rename that refuses to replace what is there.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(part), fs.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        if not fs.exists(target):
            raise error
        fs.delete(part, False)
        return False
