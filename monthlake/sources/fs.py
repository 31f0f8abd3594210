"""The few file-system steps no DataFrame writer offers, through Hadoop's own API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a directory or file; absent is fine."""
    fs, target = _at(spark, path)
    return fs.exists(target) and fs.delete(target, True)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below; partition values, never data files."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below; none for an absent directory."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile())


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, target = _at(spark, path)
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below."""
    fs, target = _at(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a marker."""
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file whole or not at all: under another name first, then renamed into place."""
    fs, target = _at(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.tmp")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, target):
        raise OSError(f"cannot write {path}")
