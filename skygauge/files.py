"""Files and folders of whatever file system Spark reads: marks, listings, moves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A file or folder: its whole path, its name, and when it last changed (epoch seconds)."""

    path: str
    name: str
    folder: bool
    size: int
    changed: float


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _entry(status) -> Entry:
    where = status.getPath()
    return Entry(where.toString(), where.getName(), status.isDirectory(), status.getLen(),
                 status.getModificationTime() / 1000)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies directly in a folder, by name; nothing if there is no such folder."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return []
    return sorted((_entry(s) for s in system.listStatus(where)), key=lambda e: e.name)


def files_below(spark: SparkSession, folder: str) -> list[Entry]:
    """All files below a folder, those of hidden folders too."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return []
    found, each = [], system.listFiles(where, True)
    while each.hasNext():
        found.append(_entry(each.next()))
    return sorted(found, key=lambda e: e.path)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file, or a folder with all that is in it; False if there was none."""
    system, where = _at(spark, path)
    return system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another path; its folder is made if need be."""
    system, where = _at(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(to.getParent())
    if not system.exists(where) or not system.rename(where, to):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if there is one."""
    system, where = _at(spark, path)
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
