"""Directory listing and markers through the session's Hadoop FileSystem,
so the same code works on a local disk, HDFS or an object store URI."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _path_class(jvm):
    """Hadoop's Path; each step of its name would be a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


@lru_cache(maxsize=1)
def _listing_methods(jvm):
    util = jvm.org.apache.hadoop.util
    return util.functional.RemoteIterators.toList, util.StringUtils.join


def _fs(spark: SparkSession, path: str):
    p = _path_class(spark.sparkContext._jvm)(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


PIECE = 16  # statuses a text: an answer of over 8 KB from the JVM takes 40 ms
LISTED = re.compile(r"^\w*FileStatus\{path=[^\n]*?([^/\n]+); isDirectory=(true|false);", re.MULTILINE)


def _names(spark: SparkSession, path: str, directories: bool) -> list[str]:
    """Names below ``path`` of one kind.

    The statuses come as text: asking each for its kind and name would be
    four calls to the JVM an entry.  They are asked where the text is not as expected."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    to_list, join = _listing_methods(spark.sparkContext._jvm)
    statuses = to_list(fs.listStatusIterator(p))
    n = len(statuses)
    found = [x for i in range(0, n, PIECE) for x in LISTED.findall(join("\n", statuses.subList(i, min(i + PIECE, n))))]
    if len(found) != n:
        found = [(s.getPath().getName(), "true" if s.isDirectory() else "false") for s in statuses]
    return sorted(name for name, kind in found if (kind == "true") == directories)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty when it does not exist)."""
    return _names(spark, path, True)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory (parents of the target are made); the target must not exist."""
    fs, src = _fs(spark, source)
    dst = _path_class(spark.sparkContext._jvm)(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; fails if it exists.

    One ``create`` and ``close``: object stores show the file only when it is
    closed, and a reader of a half-written one finds no JSON and waits."""
    fs, target = _fs(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_bytes_atomic(spark: SparkSession, path: str, data: bytes) -> None:
    """Create a file that readers of its folder see whole or not at all (hidden until it is renamed); fails if it exists."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _fs(spark, f"{folder}/.{name}.part")
    out = fs.create(hidden, False)
    try:
        out.write(data)
    finally:
        out.close()
    if not fs.rename(hidden, _path_class(spark.sparkContext._jvm)(path)):
        raise OSError(f"could not create {path}")


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path`` (empty when it does not exist)."""
    return _names(spark, path, False)
