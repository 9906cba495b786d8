"""Existence, listing and removal through Hadoop's file API: local disks and object stores."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty where it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file."""
    fs, target = _open(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Sizes and times of the file at ``path``, or of the files below it by name, as one digest."""
    fs, target = _open(spark, path)
    root, found = fs.makeQualified(target).toString(), []
    folders = [target]
    while folders:
        for status in fs.listStatus(folders.pop()):
            if status.isDirectory():
                folders.append(status.getPath())
            else:
                name = status.getPath().toString().removeprefix(root)
                found.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()
