"""File-system checks and scratch space, through Hadoop's API so that any store works."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    filesystem, path = _path(spark, location)
    return filesystem.exists(path)


def finished(spark: SparkSession, directory: str) -> bool:
    """Whether a Spark write into the directory ran to its end."""
    return exists(spark, f"{directory.rstrip('/')}/_SUCCESS")


def changed(spark: SparkSession, location: str) -> str:
    """Length and time of the last change of a file."""
    filesystem, path = _path(spark, location)
    status = filesystem.getFileStatus(path)
    return f"{status.getLen()} {status.getModificationTime()}"


def write_text(spark: SparkSession, location: str, text: str) -> None:
    filesystem, path = _path(spark, location)
    stream = filesystem.create(path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, location: str) -> str:
    filesystem, path = _path(spark, location)
    stream = filesystem.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, location: str, text: str) -> None:
    """Write a file that is seen whole or not at all; one that is there is an error.

    It is written under a hidden name and renamed.
    """
    folder, name = location.rsplit("/", 1)
    hidden = f"{folder}/_{name}.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    filesystem, path = _path(spark, location)
    source = spark._jvm.org.apache.hadoop.fs.Path(hidden)
    if filesystem.exists(path) or not filesystem.rename(source, path):
        filesystem.delete(source, False)
        raise FileExistsError(f"{location} was written by another job meanwhile")


def total_bytes(spark: SparkSession, location: str) -> int:
    """Length of a file, or of all files below a directory."""
    filesystem, path = _path(spark, location)
    return filesystem.getContentSummary(path).getLength()


def names_in(spark: SparkSession, directory: str) -> list[str]:
    """Names in a directory, but for hidden ones; none if there is no such directory."""
    filesystem, path = _path(spark, directory)
    if not filesystem.exists(path):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(path)]
    return sorted(name for name in names if name[0] not in "._")


def remove(spark: SparkSession, directory: str) -> None:
    """Delete a file, or a directory with all it holds."""
    filesystem, path = _path(spark, directory)
    filesystem.delete(path, True)


def first_visible_byte(spark: SparkSession, location: str) -> str:
    """First character that is not whitespace in a file, or in the first data file below it."""
    filesystem, path = _path(spark, location)
    if filesystem.getFileStatus(path).isDirectory():
        names = sorted(
            status.getPath().toString()
            for status in filesystem.listStatus(path)
            if status.isFile() and status.getPath().getName()[0] not in "._"
        )
        if not names:
            return ""
        filesystem, path = _path(spark, names[0])
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    )
    codec = codecs.getCodec(path)
    stream = filesystem.open(path)
    try:
        reader = codec.createInputStream(stream) if codec is not None else stream
        while (byte := reader.read()) >= 0:
            # Skips blanks, line breaks and the bytes of a UTF-8 byte-order mark.
            if byte not in b" \t\r\n\xef\xbb\xbf":
                return chr(byte)
        return ""
    finally:
        stream.close()


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory below the cluster's checkpoint folder.

    Only a session on one machine may do without ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        shared = tempfile.mkdtemp(prefix="loomset-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/loomset/{label}-{uuid.uuid4().hex}"
