"""Folders of the session's file systems: listing, removal and file times.

Spark reads and writes data; what it has no operation for - which partition
folders exist, removing those a snapshot covers - goes through the Hadoop file
system of the path, so it works wherever the path does.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob; none when the path does not exist."""
    system, where = _at(spark, pattern)
    found = system.globStatus(where)
    return [s.getPath().toString() for s in found or [] if s.isDirectory()]


def files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match a glob; none when the path does not exist."""
    system, where = _at(spark, pattern)
    return [s.getPath().toString() for s in system.globStatus(where) or [] if s.isFile()]


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return bool(system.exists(where))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None when there is no such file."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over what is there."""
    system, where = _at(spark, path)
    out = system.create(where, True)
    out.write(text.encode())
    out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole, unless there is one: of several writers one
    succeeds.  The text goes to a hidden file first, which then gets its name
    by a link (local) or a rename that doesn't overwrite (other file systems)."""
    system, where = _at(spark, path)
    if system.exists(where):
        return False
    jvm = spark.sparkContext._jvm
    system.mkdirs(where.getParent())
    hidden = f"{where.getParent().toString()}/_{uuid.uuid4().hex}"
    local = system.getUri().getScheme() == "file"
    put(spark, hidden, text)
    try:
        if local:
            plain = [system.makeQualified(x).toUri().getPath() for x in (_at(spark, hidden)[1], where)]
            os.link(*plain)
        else:
            source = _at(spark, hidden)[1]
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            how = spark.sparkContext._gateway.new_array(kind, 1)
            how[0] = kind.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(source, where, how)
        return True
    except Exception:
        if system.exists(where):   # another writer was first
            return False
        raise
    finally:
        system.delete(_at(spark, hidden)[1], False)


def partition_of(folder: str) -> dict[str, str]:
    """The partition columns that a folder's path names."""
    return {k: unquote(v) for k, v in (x.split("=", 1) for x in folder.split("/") if "=" in x)}


# Fixed value: characters that Spark escapes in the names of partition folders.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def escaped(value: str) -> str:
    """A partition value as its folder spells it."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def partition_values(spark: SparkSession, pattern: str, name: str) -> list[int]:
    """The values of the integer partition ``name`` among folders ``pattern``."""
    return sorted({int(partition_of(f)[name]) for f in folders(spark, pattern)})


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def set_modified(spark: SparkSession, pattern: str, millis: int) -> None:
    """Give the files that match a glob one modification time."""
    system, where = _at(spark, pattern)
    for s in system.globStatus(where) or []:
        system.setTimes(s.getPath(), millis, -1)


def modified(spark: SparkSession, path: str) -> int:
    system, where = _at(spark, path)
    return int(system.getFileStatus(where).getModificationTime())
