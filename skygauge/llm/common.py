"""What the training-data operators share: words, hashes, stored steps, lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge.operators.joins import total_bytes
from skygauge.session import Stored, materialize
from skygauge.session import settle as settled_by

#: Regular expression of what lies between words: space, and tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"
#: A lookup up to this measured size is copied to every executor.
LOOKUP_BYTES = 16 * 1024 * 1024
#: Rows that a Python task handles at once.
SLICE_ROWS = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.array_remove(F.split(whole(text), GAP), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def stored(df: DataFrame, label: str, **measures: Column) -> Stored:
    """A step written to the shared folder: survives lost executors, cuts lineage."""
    return materialize(df, f"llm-{label}", **measures)


def measured(df: DataFrame, label: str, **measures: Column) -> Stored:
    """A stored step with its bytes in ``measures["bytes"]``."""
    return stored(df, label, bytes=total_bytes(df), **measures)


def settled(build: Callable[[], DataFrame], label: str, **measures: Column) -> Stored:
    """A stored step; the steps that ``build`` stores on the way to it are removed."""
    return settled_by(build, f"llm-{label}", **measures)


def lookup(step: Stored, limit: int = LOOKUP_BYTES) -> DataFrame:
    """The table of a ``measured`` step, marked for broadcast if it is small."""
    return F.broadcast(step.table) if step.measures["bytes"] <= limit else step.table


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition on columns of one name, nulls equal to each other."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


class WordHashes(dict):
    """64-bit hash by word, remembered up to a bound."""

    def __init__(self, bound: int = 500_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, found: Sequence[bytes]) -> np.ndarray:
        return np.array([self[w] for w in found], dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of a text's shingles of ``size`` words, sorted.

    A text of fewer words is one shingle, its whole sequence; none without words.
    """
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    mixed = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            mixed = (mixed ^ hashes[k: len(hashes) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a few rows, so that what a task derives stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
