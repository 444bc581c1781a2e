"""Looking at folders through Hadoop's file system, so that any storage works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return bool(fs.exists(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if the folder is not there."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's own listings spell it, scheme included, without a closing slash."""
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file if nobody has: of several writers only one gets True."""
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        return bool(fs.createNewFile(hadoop_path))
    except Exception:
        if fs.exists(hadoop_path):
            return False
        raise


def listed(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """``(name, is_folder, modified in ms)`` of what stands directly below a folder."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [
        (status.getPath().getName(), bool(status.isDirectory()), int(status.getModificationTime()))
        for status in fs.listStatus(hadoop_path)
    ]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text, read by the driver."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text unless one of that name is there: of several
    writers only one gets True, and a reader sees all of the text or no file.

    The text is written under a name readers pass over and renamed without overwriting, which is
    atomic where the store renames atomically (HDFS does, plain object stores do not).
    """
    context = spark._jvm.org.apache.hadoop.fs
    fs, target = _open(spark, path)
    parent = target.getParent()
    fs.mkdirs(parent)
    if fs.exists(target):
        return False
    hidden = context.Path(parent, f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = context.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(context, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(hidden), fs.makeQualified(target), plain)
        return True
    except Exception:
        fs.delete(hidden, False)
        if fs.exists(target):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def success_marks(spark: SparkSession, pattern: str) -> dict[str, int]:
    """For the folders of a path pattern whose write has finished: name and time in ms."""
    fs, hadoop_path = _open(spark, f"{pattern}/_SUCCESS")
    found = fs.globStatus(hadoop_path) or []
    return {status.getPath().getParent().getName(): int(status.getModificationTime()) for status in found}


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file of a path, a pattern, or a folder, without its subfolders."""
    fs, hadoop_path = _open(spark, path)
    found = 0
    for status in fs.globStatus(hadoop_path) or []:
        entries = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for entry in entries:
            if entry.isFile() and not entry.getPath().getName().startswith(("_", ".")):
                found = max(found, int(entry.getLen()))
    return found
