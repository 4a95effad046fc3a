"""Small file-system calls through Hadoop, so any path Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of the data files behind a file or folder, in name order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if f[1][0] not in "_.")


def versions(spark: SparkSession, path: str) -> list[list]:
    """[name, bytes, time of change] of the data files behind a path; tells whether a source is the one seen before."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [[s.getPath().getName(), s.getLen(), s.getModificationTime()] for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if f[0][0] not in "_.")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not as its name says; None when it has no text."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside ``path`` and rename over it, so that readers see the old text or the new one."""
    write_text(spark, path + ".new", text)
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    source, target = jvm.org.apache.hadoop.fs.Path(path + ".new"), jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, path)[0].getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} cannot be renamed to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files under a path, and their bytes."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0, 0
    summary = fs.getContentSummary(p)
    return summary.getFileCount(), summary.getLength()
