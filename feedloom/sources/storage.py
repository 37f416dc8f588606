"""Directory listing through the Hadoop file system, for any path Spark can read."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, jvm_path = _file_system(spark, path)
    return file_system.exists(jvm_path)


def total_size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all files under these directories."""
    total = 0
    for path in paths:
        file_system, jvm_path = _file_system(spark, path)
        if file_system.exists(jvm_path):
            total += file_system.getContentSummary(jvm_path).getLength()
    return total


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    file_system, jvm_path = _file_system(spark, path)
    stream = file_system.create(jvm_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(row[0] for row in spark.read.text(path, wholetext=True).collect())


def put_in_place(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished directory its final name, under which nobody has seen anything yet."""
    file_system, jvm_path = _file_system(spark, source)
    _, jvm_target = _file_system(spark, target)
    file_system.mkdirs(jvm_target.getParent())
    if not file_system.rename(jvm_path, jvm_target):
        raise OSError(f"{source} cannot be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _file_system(spark, path)
    file_system.delete(jvm_path, True)


def set_age(spark: SparkSession, path: str, days: int) -> None:
    """Make the files under a directory as old as a copy or a restored backup may be."""
    file_system, jvm_path = _file_system(spark, path)
    then = int((time.time() - days * 86_400) * 1000)
    for status in file_system.listStatus(jvm_path):
        file_system.setTimes(status.getPath(), then, -1)


# What has been written under a folder is noted in it by name, so one listing tells all of it.
_FINISHED = "_finished"


def mark_finished(spark: SparkSession, folder: str, name: str) -> None:
    write_text(spark, f"{folder}/{_FINISHED}/{name}")


def is_finished(spark: SparkSession, folder: str, name: str) -> bool:
    return exists(spark, f"{folder}/{_FINISHED}/{name}")


def finished(spark: SparkSession, folder: str) -> list[str]:
    return child_names(spark, f"{folder}/{_FINISHED}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries right under ``path``; empty if there is no such directory."""
    file_system, jvm_path = _file_system(spark, path)
    if not file_system.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(jvm_path)]


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers N of the directories ``<prefix>=N`` under ``path``, ascending."""
    start = f"{prefix}="
    names = child_names(spark, path)
    return sorted(int(name[len(start) :]) for name in names if name.startswith(start))
