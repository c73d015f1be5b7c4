"""Compaction of landed tables: the many small files of a closed day become a few."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterator, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge import files

#: Bytes of a file that compaction aims at.
FILE_BYTES = 128 * 1024 * 1024
#: A folder is rewritten if it has more than so many times the files it needs.
WORTH = 2

_NAMED_BY_TIME = re.compile(r"\d{8}-\d{6}\.json")


@dataclass(frozen=True)
class Folder:
    """Files of one combination of folder values."""

    values: dict[str, str]
    files: list[files.Entry]

    def wanted(self, file_bytes: int) -> int:
        return max(1, -(-sum(f.size for f in self.files) // file_bytes))


def folders_of(spark: SparkSession, root: str, names: Sequence[str], wanted: Callable[[dict], bool]) -> Iterator[Folder]:
    """The folders below ``root`` in directories ``name=value`` that are wanted by their values."""
    def walk(path: str, known: dict[str, str]) -> Iterator[Folder]:
        if len(known) == len(names):
            if wanted(known):
                found = [e for e in files.entries(spark, path) if not e.folder and not e.name.startswith(("_", "."))]
                yield Folder(dict(known), found)
            return
        mark = f"{names[len(known)]}="
        for entry in files.entries(spark, path):
            if entry.folder and entry.name.startswith(mark):
                yield from walk(entry.path, {**known, names[len(known)]: entry.name.removeprefix(mark)})

    yield from walk(root, {})


def closed_day(values: dict[str, str], until: date) -> bool:
    """Whether a folder's day, by year, month and day or by ingestion date, is before ``until``."""
    text = values.get("ingest_date") or "-".join(values.get(n, "") for n in ("year", "month", "day"))
    try:
        year, month, day = map(int, text.split("-"))
        return date(year, month, day) < until
    except ValueError:
        return False


def _read(spark: SparkSession, root: str, names: Sequence[str], form: str) -> DataFrame:
    """The table with folder values as they are written; JSON as lines, whatever is in them."""
    kept = spark.read.parquet(root).drop(*names).schema if form == "parquet" else T.StructType().add("value", "string")
    folders = [T.StructField(n, T.StringType()) for n in names]
    reader = spark.read.schema(T.StructType([*kept.fields, *folders]))
    return reader.format("parquet" if form == "parquet" else "text").load(root)


def compact_days(
    spark: SparkSession,
    root: str,
    names: Sequence[str],
    form: str,
    until: date,
    pending: Collection[str] = (),
    file_bytes: int = FILE_BYTES,
) -> int:
    """Rewrite the folders of days before ``until`` into files near ``file_bytes``; how many were.

    The rows stay the same, broken lines too.  Spark replaces exactly the folders that are
    rewritten (dynamic partition overwrite), once all their new files are written: a job
    that fails changes nothing.  Left alone are folders with few files already, those
    with a file of a ``pending`` batch, which may be written again, and those whose files
    carry their time in their names.
    """
    def worth(folder: Folder) -> bool:
        return len(folder.files) > WORTH * folder.wanted(file_bytes) and not any(
            _NAMED_BY_TIME.fullmatch(f.name) or any(f.name.startswith(f"{p}-") for p in pending)
            for f in folder.files)

    chosen = [f for f in folders_of(spark, root, names, lambda v: closed_day(v, until)) if worth(f)]
    if not chosen:
        return 0
    table = _read(spark, root, names, form)
    sizes = spark.createDataFrame(
        [(*[f.values[n] for n in names], f.wanted(file_bytes)) for f in chosen],
        T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_files", T.IntegerType())]))
    # One row for each folder to rewrite: its values prune the scan, its files share tasks.
    rows = table.withColumn("_file", F.xxhash64(F.col("_metadata.file_path"))).join(F.broadcast(sizes), list(names))
    total = sum(f.wanted(file_bytes) for f in chosen)
    dealt = rows.repartition(total, *names, F.pmod("_file", F.col("_files"))).drop("_file", "_files")
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names)
     .format("parquet" if form == "parquet" else "text").save(root))
    return len(chosen)
