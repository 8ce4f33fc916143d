"""Path helpers on the Hadoop file system, so any scheme the cluster knows works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _handle(spark, path)
    return bool(fs.exists(target))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark job finished writing ``path``, or a stream has committed batches to it."""
    folder = path.rstrip("/")
    return path_exists(spark, f"{folder}/_SUCCESS") or path_exists(spark, f"{folder}/_spark_metadata")


def remove_folder(spark: SparkSession, path: str) -> None:
    target, fs = _handle(spark, path)
    fs.delete(target, True)


def set_mark(spark: SparkSession, path: str) -> None:
    """Mark a folder of several tables as whole, once the last is written."""
    target, fs = _handle(spark, f"{path.rstrip('/')}/_COMPLETE")
    fs.create(target, True).close()


def clear_mark(spark: SparkSession, path: str) -> None:
    target, fs = _handle(spark, f"{path.rstrip('/')}/_COMPLETE")
    fs.delete(target, False)


def has_mark(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_COMPLETE")


def fingerprint(spark: SparkSession, path: str) -> str:
    """What is under a path, in a few calls whatever its size: bytes, files, and times of change.

    Of a folder, the times are its own and that of its finishing mark, which every rewrite renews.
    """
    target, fs = _handle(spark, path)
    if not fs.exists(target):
        return "missing"
    whole = fs.getContentSummary(target)
    times = [fs.getFileStatus(target).getModificationTime()]
    for mark in ("_SUCCESS", "_COMPLETE"):
        at, _ = _handle(spark, f"{path.rstrip('/')}/{mark}")
        if fs.exists(at):
            times.append(fs.getFileStatus(at).getModificationTime())
    return f"{whole.getLength()} bytes, {whole.getFileCount()} files, {times}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _handle(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; empty when there is none."""
    target, fs = _handle(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(target), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of the entries of a folder; empty when the folder does not exist."""
    target, fs = _handle(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))
