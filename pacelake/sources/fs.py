"""Driver-side file-system calls through Spark's Hadoop FileSystem, so they
work on any storage Spark can read (local, HDFS, object stores): listing,
sizes, small pointer files, folder creation and deletion. Only metadata and
tiny files pass through the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.mkdirs(p)


def total_bytes(spark: SparkSession, *paths: str) -> int:
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _unchecked(spark: SparkSession, fs):
    """The local file system keeps checksums in files of their own, which a
    rename cannot replace together with the data: tiny files go without."""
    if fs.getUri().getScheme() != "file":
        return fs
    return spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark.sparkContext._jsc.hadoopConfiguration()).getRaw()


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a tiny file atomically: write a temporary file of its own name,
    then rename it over the old one in one call. A reader sees the old or the
    new text, never none, and concurrent writers don't share a file."""
    fs, dst = _fs(spark, path)
    own = _unchecked(spark, fs)
    jvm = spark.sparkContext._jvm
    tmp = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = own.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if own is not fs:
        own.rename(tmp, dst)  # the local rename replaces
        return
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(dst), options)


def read_small_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    fs = _unchecked(spark, fs)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return line.strip() if line else None
    finally:
        stream.close()


def fingerprint(spark: SparkSession, *paths: str) -> list[tuple[str, int, int, int]]:
    """(path, bytes, files, newest modification time) of each table folder or
    file: a content summary and one listing per folder, not a call per file."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            out.append((path, -1, -1, -1))
            continue
        total, status = fs.getContentSummary(p), fs.getFileStatus(p)
        newest, folders = status.getModificationTime(), [p] if status.isDirectory() else []
        while folders:
            for st in fs.listStatus(folders.pop()):
                newest = max(newest, st.getModificationTime())
                if st.isDirectory():
                    folders.append(st.getPath())
        out.append((path, total.getLength(), total.getFileCount(), newest))
    return sorted(out)
