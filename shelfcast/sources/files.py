"""Path operations through the Hadoop file system API, for any storage Spark can reach."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def size_in_bytes(spark: SparkSession, path: str) -> int:
    target, fs = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    target, fs = _resolve(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files of a folder that Spark would read."""
    target, fs = _resolve(spark, path)
    if not fs.getFileStatus(target).isDirectory():
        return [path]
    found = [s.getPath() for s in fs.listStatus(target) if s.isFile()]
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file, compressed or not; None for an empty file."""
    target, fs = _resolve(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    ).getCodec(target)
    stream = fs.open(target)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def replace(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name in place of what has it."""
    source, fs = _resolve(spark, path)
    target, _ = _resolve(spark, to)
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not rename {path} to {to}")


def concatenate(spark: SparkSession, paths: list[str]) -> None:
    """Append files to the first one, in order, and remove the others. All are in one folder.

    The file system does it where it can join files without reading them, as HDFS does. On local
    disks their bytes are copied through a small buffer. Other stores are refused, because the
    content would pass through one machine.
    """
    jvm = spark._jvm
    first, fs = _resolve(spark, paths[0])
    parts = [jvm.org.apache.hadoop.fs.Path(p) for p in paths[1:]]
    parts = [p for p in parts if fs.getFileStatus(p).getLen()]
    if fs.getUri().getScheme() != "file":
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            sources[k] = part
        try:
            if parts:
                fs.concat(first, sources)
        except Py4JJavaError as error:
            if "UnsupportedOperationException" in error.java_exception.toString():
                raise OSError(f"{fs.getUri()} cannot join files; write folders of parts there") from error
            raise
        return
    joined = jvm.org.apache.hadoop.fs.Path(f"{paths[0]}.joined")
    out = fs.create(joined, True)
    try:
        for part in [first, *parts]:
            source = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
    for part in [first, *parts]:
        fs.delete(part, False)
    if not fs.rename(joined, first):
        raise OSError(f"could not rename {joined} to {first}")


def read_text(spark: SparkSession, path: str) -> str:
    """Whole content of a file known to be tiny, such as a pointer or a report."""
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one already; False if there is. Of several callers at
    once one creates it, on HDFS, on object stores with conditional writes and on local disks."""
    target, fs = _resolve(spark, path)
    if fs.getUri().getScheme() == "file":
        return _link_new(spark, target, fs, text)
    builder = fs.createFile(target).recursive().overwrite(False)
    builder.opt("fs.s3a.create.conditional.overwrite", True)
    try:
        stream = builder.build()
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def _link_new(spark: SparkSession, target, fs, text: str) -> bool:
    """A local file system only looks before it creates; a hard link to a whole file is one step."""
    nio, none = spark._jvm.java.nio.file, spark.sparkContext._gateway.new_array
    fs.mkdirs(target.getParent())
    folder = nio.Paths.get(fs.makeQualified(target.getParent()).toUri())
    written = nio.Files.createTempFile(folder, ".new", None, none(nio.attribute.FileAttribute, 0))
    try:
        nio.Files.write(written, bytearray(text, "utf-8"), none(nio.OpenOption, 0))
        nio.Files.createLink(folder.resolve(target.getName()), written)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.toString():
            return False
        raise
    finally:
        nio.Files.delete(written)
    return True
