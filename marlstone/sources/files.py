"""Small text files and listings on whatever storage a path points to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; for folders of versions, not of data files."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path)


def list_files(spark: SparkSession, path: str) -> list[dict]:
    """Path, length and time of the data files directly below a folder one job wrote."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [
        {"path": s.getPath().toString(), "length": s.getLen(), "modified": s.getModificationTime()}
        for s in fs.listStatus(hadoop_path) if s.isFile() and not s.getPath().getName().startswith(("_", "."))
    ]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing to do where there is none."""
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, read by the driver without a Spark job."""
    hadoop_path, fs = _path(spark, path)
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = codecs.getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    try:
        content = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; refuses to replace an existing one."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
