"""File listings through Hadoop's file system API, so any storage scheme works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none when the folder does not exist."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def create_until_exit(spark: SparkSession, path: str) -> None:
    """Create a folder that is deleted with its content when the driver ends."""
    hadoop_path, fs = _file_system(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark reads for a path: itself, or those of a folder that are not empty."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path) or not fs.getFileStatus(hadoop_path).isDirectory():
        return [path]
    found = []
    for status in fs.listStatus(hadoop_path):
        child = status.getPath()
        if status.isFile() and status.getLen() and child.getName()[0] not in "._":
            found.append(child.toString())
    return sorted(found)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as the catalog holds locations."""
    hadoop_path, fs = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def from_uri(spark: SparkSession, uri: str) -> str:
    """The path of a file that Spark's ``_metadata`` names."""
    jvm = spark._jvm
    return qualified(spark, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString())


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not; empty for a file without lines."""
    hadoop_path, fs = _file_system(spark, path)
    io = spark._jvm.java.io
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    )
    codec = codecs.getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return io.BufferedReader(io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing what is there."""
    hadoop_path, fs = _file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds of the store's clock."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file; False if it is gone. Of several callers only one succeeds."""
    hadoop_path, fs = _file_system(spark, source)
    try:
        return fs.exists(hadoop_path) and fs.rename(hadoop_path, _file_system(spark, target)[0])
    except Py4JJavaError as error:
        if _java_class(error) == "FileNotFoundException":
            return False
        raise


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its content in one step; False if there is one already.

    The content is written under another name first. On a local disk it is then linked, elsewhere
    renamed without overwriting; both fail if the name is taken. A store needs an atomic rename for
    this (HDFS and its like).
    """
    waiting = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"
    write_text(spark, waiting, text)
    jvm = spark._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (waiting, path))
    conf = spark._jsc.hadoopConfiguration()
    scheme = source.getFileSystem(conf).getUri().getScheme()
    try:
        if scheme == "file":
            places = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), _strings(spark)) for p in (target, source)]
            jvm.java.nio.file.Files.createLink(*places)
        else:
            hadoop = jvm.org.apache.hadoop.fs
            no_overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
            context = hadoop.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
            context.rename(source, target, no_overwrite)
    except Py4JJavaError as error:
        if _java_class(error) == "FileAlreadyExistsException":
            return False
        raise
    finally:
        delete_folder(spark, waiting)
    return True


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def _java_class(error: Py4JJavaError) -> str:
    return error.java_exception.getClass().getSimpleName()
