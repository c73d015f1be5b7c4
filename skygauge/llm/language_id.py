"""Language of a text by rank-order profiles of character n-grams.

A language's profile are the most frequent n-grams of all its training texts, in order.
A text's own most frequent n-grams are compared with each profile: an n-gram counts as
many places as it is out of place, and as many as a profile is long where the profile
lacks it.  The language with the least distance is the answer.

N-grams are runs of one to three letters in lower case; whatever is no letter is one
space, and a space stands only at an end of an n-gram.  Three characters of 21 bits are
one 63-bit number, so n-grams are counted as numbers, without collisions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygauge.llm.common import slices, stored, whole

#: N-grams of a profile, and of a text at most.
PROFILE = 300
#: Languages learned at most, those with most n-grams; the standard's list has fewer.
LANGUAGES = 8192
#: What is predicted for a text without letters.
UNKNOWN = "und"
#: Different n-grams that a task counts before it passes them on.
COUNTED = 400_000
#: Characters whose n-grams are listed at once.
CHARACTERS = 1 << 18

#: The space: it follows the last code point and still has 21 bits, so that n-grams of
#: two and three characters are greater than all shorter ones.
_GAP = 0x110000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point itself if it is a letter, else the space."""
    return np.fromiter((c if chr(c).isalpha() else _GAP for c in range(_GAP)), np.uint32, _GAP)


def characters(text: str) -> np.ndarray:
    """The text in lower case, a space for each run of others and at both ends; empty without a letter."""
    codes = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate([[np.uint32(_GAP)], codes, [np.uint32(_GAP)]])
    kept = codes[np.concatenate([[True], (codes[1:] != _GAP) | (codes[:-1] != _GAP)])]
    return kept if len(kept) > 1 else kept[:0]


def ngrams(codes: np.ndarray, at_once: int = CHARACTERS) -> Iterator[np.ndarray]:
    """The n-grams of a text as numbers, those that begin in one piece of it together."""
    for start in range(0, len(codes), at_once):
        c = codes[start: start + at_once + 2].astype(np.int64)
        own = len(codes[start: start + at_once])
        one, two = c[:own], (c[:-1] << 21 | c[1:])[:own]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != _GAP]
        yield np.concatenate([one[one != _GAP], two, three])


class Counts:
    """N-grams and how often each was added."""

    def __init__(self) -> None:
        self.grams, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.fresh: list[np.ndarray] = []
        self.waiting = 0

    def add(self, text: str) -> None:
        for some in ngrams(characters(text)):
            self.fresh.append(some)
            self.waiting += len(some)
            if self.waiting >= 4 * CHARACTERS:
                self.merge()

    def merge(self) -> Counts:
        if self.fresh:
            grams, counts = np.unique(np.concatenate(self.fresh), return_counts=True)
            if len(self.grams):
                every, weights = np.concatenate([self.grams, grams]), np.concatenate([self.counts, counts])
                grams, at = np.unique(every, return_inverse=True)
                counts = np.bincount(at, weights, len(grams)).astype(np.int64)
            self.grams, self.counts, self.fresh, self.waiting = grams, counts, [], 0
        return self

    def ranked(self, size: int = PROFILE) -> np.ndarray:
        """The most frequent n-grams, ties by number."""
        grams, counts = self.grams, self.counts
        if len(grams) > size:
            least = np.partition(counts, len(counts) - size)[len(counts) - size]
            grams, counts = grams[counts >= least], counts[counts >= least]
        return grams[np.argsort(-counts, kind="stable")][:size]


def count_ngrams(texts: DataFrame) -> DataFrame:
    """lang, gram, c over all rows of (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counts] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, own in seen.items():
                own.merge()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own.grams), pa.string()), pa.array(own.grams), pa.array(own.counts)],
                    ["lang", "gram", "c"])
            seen.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counts()).add(text)
            if sum(len(own.grams) + own.waiting // 4 for own in seen.values()) > COUNTED:
                for own in seen.values():
                    own.merge()
                if sum(len(own.grams) for own in seen.values()) > COUNTED:
                    yield from passed()
        yield from passed()

    return texts.select("lang", "text").mapInArrow(count, "lang string, gram long, c long").groupBy(
        "lang", "gram").agg(F.sum("c").alias("c"))


def profiles(texts: DataFrame, size: int = PROFILE, languages: int = LANGUAGES) -> pa.Table:
    """lang, gram, place (from 0): the profile of each language of (lang, text), by all texts."""
    counted = stored(count_ngrams(texts), "language-ngrams").table
    most = counted.groupBy("lang").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    order = Window.partitionBy("lang").orderBy(F.desc("c"), "gram")
    first = counted.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < size)
    return first.join(F.broadcast(most.select("lang")), "lang", "left_semi").select("lang", "gram", "place").toArrow()


@dataclass
class Profiles:
    """Where each n-gram stands in which profiles, by n-gram."""

    langs: list[str]
    grams: np.ndarray   # different ones, ascending
    starts: np.ndarray  # of each one's entries in the next two, and their end
    lang: np.ndarray
    place: np.ndarray
    size: int

    @classmethod
    def of(cls, table: pa.Table, size: int = PROFILE) -> Profiles:
        names = sorted(set(table["lang"].to_pylist()))
        number = {lang: i for i, lang in enumerate(names)}
        lang = np.array([number[v] for v in table["lang"].to_pylist()], np.int64)
        gram, place = (np.array(table[n].to_pylist(), np.int64) for n in ("gram", "place"))
        order = np.argsort(gram, kind="stable")
        grams, starts = np.unique(gram[order], return_index=True)
        return cls(names, grams, np.append(starts, len(gram)), lang[order], place[order], size)

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Sum of places that a text's ranked n-grams are out of place, for each language."""
        at = np.minimum(np.searchsorted(self.grams, own), max(0, len(self.grams) - 1))
        known = np.flatnonzero(self.grams[at] == own)
        lengths = self.starts[at[known] + 1] - self.starts[at[known]]
        # The entries of all known n-grams, one after the other.
        entries = np.repeat(self.starts[at[known]] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        saved = self.size - np.abs(self.place[entries] - np.repeat(known, lengths))
        total = np.bincount(self.lang[entries], saved, len(self.langs))
        return len(own) * self.size - total.astype(np.int64)

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, by name among equals, and how sure it is: the runner-up's
        share of both distances; without one, that of an unknown text."""
        own = Counts()
        own.add(text)
        ranks = own.merge().ranked(self.size)
        if not len(ranks) or not self.langs:
            return UNKNOWN, 0.0
        found = self.distances(ranks)
        best = int(found.argmin())
        others = np.delete(found, best)
        second = int(others.min()) if len(others) else len(ranks) * self.size
        return self.langs[best], second / (found[best] + second) if found[best] + second else 0.5


def identify(docs: DataFrame, training: Column, size: int = PROFILE) -> DataFrame:
    """doc_id, trained, lang_pred, score of every row.

    ``training`` marks the rows whose ``lang`` and text are learnt from; a null lang, or a
    text without letters, teaches nothing.  Predictions read the text alone: ``und`` with
    score 0 where it is null or has no letter, or where no language was learnt.  Texts
    are read whole, in pieces; equal distances go to the lesser language name; repeated
    rows and null doc_ids are answered row by row; an empty table gives no rows.  Other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.coalesce(training, F.lit(False)).alias("trained"), whole("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(
        profiles(rows.filter(F.col("trained") & F.col("lang").isNotNull()), size))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles.of(shared.value, size)
        for batch in slices(batches):
            found = [known.predict(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "trained", "lang_pred", "score"])

    return rows.select("doc_id", "trained", "text").mapInArrow(
        read, "doc_id long, trained boolean, lang_pred string, score double")
