"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel of two words sums, over the subsequences of three letters that both have,
a decay for every letter that a subsequence spans.  Letters put in between therefore
weaken a match but do not end it, and other characters are passed over; letters that
stand alone ("i d i o t") are read as one word.

Landmarks are words, or beginnings of words that are inflected, which tell toxic
labelled documents from others, each of length one in the kernel.  The inverse root of
their own kernel turns a word's kernels with them into Nyström features, on which a
linear machine is trained with hinge loss.  A sentence is its worst word, and a text its
worst sentence; which word that is, the machine of the round before says.  The plainest
landmarks are also learnt with letters put in, so that the machine sets its margin between
these and the worst words of clean documents.  The machine is
linear in the kernel, so it is one weight for each three letters: scoring a word sums
these over its subsequences, exactly.  Scores are on a logistic scale fitted to the
labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import slices, stored, whole

#: Labelled documents from which the model is fitted, at most.
LABELLED_DOCS = 20_000
LANDMARKS = 64
#: Letters that a subsequence may span, and the decay of each beyond the third.
SPAN, DECAY = 9, 0.9
#: Letters of a beginning of a word that may be a landmark.
STEM = range(3, 13)
#: Share of the toxic rows in the training loss.
TOXIC_SHARE = 0.3
#: Landmarks with at least this share of the first one's toxic documents are also learnt with
#: letters put in.
PLAIN = 0.25
#: Rounds of training, each on the words that the machine before it takes for the worst.
ROUNDS = 3
#: Longer words are read in overlapping pieces of this many letters.
PIECE = 32
#: Words that a task remembers.
REMEMBERED = 500_000

_BASE = 31
_PUT_IN = "xqzjkvwbnt"
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def held_out(doc_id: Column, remainder: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``remainder`` by 5; a null id is empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == remainder


def letters(word: str) -> list[int]:
    """Codes of a word's letters: a-z, and five classes of other letters."""
    return [ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % 5 for c in word if c.isalpha()]


def subsequences(codes: list[int]) -> dict[int, float]:
    """Weight of each subsequence of three letters: of its tightest occurrence."""
    found: dict[int, float] = {}
    n = len(codes)
    for a, b in _OFFSETS:  # by span
        for i in range(n - b):
            found.setdefault((codes[i] * _BASE + codes[i + a]) * _BASE + codes[i + b], DECAY ** (b - 2))
    return found


def kernel(x: dict[int, float], y: dict[int, float]) -> float:
    return sum(v * y[k] for k, v in x.items() if k in y)


def worded(text: str) -> set[str]:
    """Words in lower case; runs of three or more words of one character also as one word.

    Letters of long words come in overlapping pieces.
    """
    found = text.lower().split()
    lengths = bytes(len(w) == 1 for w in found)
    units = set(found)
    units.update("".join(found[m.start(): m.end()]) for m in re.finditer(b"\x01{3,}", lengths))
    for word in [w for w in units if len(w) > PIECE]:
        units.remove(word)
        only = "".join(filter(str.isalpha, word))
        units.update(only[at: at + PIECE] for at in range(0, max(1, len(only) - PIECE // 2), PIECE // 2))
    return units


def weighted(words: list[str], table: np.ndarray) -> np.ndarray:
    """By word the sum over its subsequences of their weight times their row of ``table``."""
    by_length: dict[int, tuple[list[int], list[list[int]]]] = {}
    for place, word in enumerate(words):
        codes = letters(word)
        at, rows = by_length.setdefault(len(codes), ([], []))
        at.append(place)
        rows.append(codes)
    sums = np.zeros((len(words), table.shape[1]))
    column, decay = np.ascontiguousarray(table.T), DECAY ** np.arange(-2.0, SPAN - 2)
    for n, (at, rows) in by_length.items():
        for begin in range(0, len(at) if n >= 3 else 0, 4096):
            codes = np.array(rows[begin: begin + 4096], dtype=np.int32)
            some = [(a, b) for a, b in _OFFSETS if b < n]
            keys = np.concatenate([(codes[:, : n - b] * _BASE + codes[:, a: n - b + a]) * _BASE + codes[:, b:]
                                   for a, b in some], axis=1)
            spans = np.concatenate([np.full(n - b, b, dtype=np.int32) for _, b in some])
            both = np.sort(keys * np.int32(SPAN) + spans, axis=1)
            keys, spans = np.divmod(both, np.int32(SPAN))
            share = decay[spans]
            share[:, 1:][keys[:, 1:] == keys[:, :-1]] = 0  # a wider occurrence
            for k in range(table.shape[1]):
                sums[at[begin: begin + 4096], k] = (column[k][keys] * share).sum(axis=1)
    return sums


class Landmarks:
    """Words of length one in the kernel: their subsequences by column, and their own kernel."""

    def __init__(self, words: list[str]):
        maps = [subsequences(letters(w)) for w in words]
        self.words, self.norms = words, np.array([kernel(m, m) for m in maps]) ** 0.5
        self.own = np.array([[kernel(p, q) for q in maps] for p in maps]) / np.outer(self.norms, self.norms)
        self.table = np.zeros((_BASE ** 3, len(words)))
        for k, m in enumerate(maps):
            for key, v in m.items():
                self.table[key, k] = v / self.norms[k]


class Model:
    """Weights by subsequence (a column), a bias, and a logistic scale of margins in [-1, 1]."""

    def __init__(self, table: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.table, self.bias, self.slope, self.shift = table, bias, slope, shift
        self.seen: dict[str, float] = {}

    def margins(self, words: list[str]) -> list[float]:
        return (weighted(words, self.table)[:, 0] + self.bias).tolist()

    def worst(self, texts: list[str]) -> list[tuple[float, str]]:
        """Margin and word of the worst word of each text; of ties the first; bias and "" without words."""
        units = [worded(text) for text in texts]
        fresh = list(set().union(*units).difference(self.seen))
        if len(self.seen) + len(fresh) > REMEMBERED:
            self.seen, fresh = {}, list(set().union(*units))
        self.seen.update(zip(fresh, self.margins(fresh), strict=True))
        get = self.seen.__getitem__
        tops = [max(map(get, unit), default=self.bias) for unit in units]
        return [(top, min((w for w in unit if get(w) == top), default="")) for top, unit in zip(tops, units, strict=True)]

    def score(self, margin: float) -> float:
        sure = max(-1.0, min(1.0, margin))
        return float(1 / (1 + np.exp(-np.clip(self.slope * sure + self.shift, -30, 30))))


def with_letters(word: str) -> list[str]:
    """Copies of a word with one or two letters put in at one place, or in every gap."""
    found = []
    for many in (1, 2):
        found += [word[:at] + _PUT_IN[at % 10] * many + word[at:] for at in range(1, len(word))]
        for first in range(3):
            gaps = ("".join(_PUT_IN[(first + at + k) % 10] for k in range(many)) for at in range(len(word) - 1))
            found.append("".join(c + gap for c, gap in zip(word, [*gaps, ""], strict=True)))
    return found


def train_svm(x: np.ndarray, y: np.ndarray, own: np.ndarray, each: np.ndarray,
              rounds: int = 1500) -> tuple[np.ndarray, float]:
    """Weights on kernels and bias of a linear machine on Nyström features.

    y is -1 or 1, ``each`` the number of documents that a row stands for.  Hinge loss
    by subgradients whose steps shrink with what they have summed to.
    """
    values, vectors = np.linalg.eigh(own + 1e-2 * np.eye(len(own)))
    root = vectors @ np.diag(np.maximum(values, 1e-2) ** -0.5) @ vectors.T
    z = np.concatenate([x @ root, np.ones((len(x), 1))], axis=1)
    toxic = TOXIC_SHARE / max(1, each[y > 0].sum()), (1 - TOXIC_SHARE) / max(1, each[y < 0].sum())
    share = each * np.where(y > 0, *toxic)
    w, squares = np.zeros(z.shape[1]), np.full(z.shape[1], 1e-8)
    for _ in range(rounds):
        wrong = y * (z @ w) < 1
        g = -(z.T @ (share * y * wrong)) + 1e-5 * w
        squares += g * g
        w -= 0.3 * g / np.sqrt(squares)
    return root @ w[:-1], float(w[-1])


def fit_scale(margins: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic scale of margins in [-1, 1] (Newton's method)."""
    x = np.stack([np.clip(margins, -1, 1), np.ones_like(margins)], axis=1)
    t = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        t = t - np.linalg.solve(h, x.T @ (p - y) + 1e-2 * t)
    return float(t[0]), float(t[1])


def choose_landmarks(sample: DataFrame, count: int = LANDMARKS) -> dict[str, tuple[int, int]]:
    """Words of toxic documents, with how many toxic and how few other documents have them."""
    clean = F.regexp_replace("word", r"^[^\p{L}]+|[^\p{L}]+$", "")
    words = sample.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word")).select(
        "toxic", clean.alias("word")).filter((F.length("word") >= 3) & (F.length("word") <= PIECE))
    marked = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fair"))
    stems = marked.select("bad", "fair", F.explode(F.array_distinct(F.transform(
        F.array(*[F.lit(k) for k in STEM]), lambda k: F.substring("word", F.lit(1), k)))).alias("word"))
    best = stems.filter(F.length("word") >= STEM[0]).groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("fair").alias("fair")).filter("bad >= 3 AND bad >= 9 * fair").orderBy(
        F.desc("bad"), "fair", F.desc(F.length("word")), "word").limit(20 * count)
    chosen: dict[str, tuple[int, int]] = {}
    maps: list[dict[int, float]] = []
    for row in best.collect():
        own = subsequences(letters(row["word"]))
        if own and all(kernel(own, m) < 0.8 * min(kernel(m, m), kernel(own, own)) for m in maps):
            chosen[row["word"]] = row["bad"], row["fair"]
            maps.append(own)
        if len(chosen) == count:
            break
    return chosen


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED_DOCS) -> Model:
    """Model from labelled documents that are not held out.

    A document that is labelled twice counts as toxic if one label says so.  Without
    toxic documents nothing is a landmark and every text scores near 0.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"), 0)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    picked = stored(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "labelled").table
    texts = docs.select("doc_id", whole("text").alias("text"))
    sample = stored(texts.join(F.broadcast(picked), "doc_id"), "labelled-texts").table
    landmarks = choose_landmarks(sample)
    if not landmarks:
        return Model(np.zeros((_BASE ** 3, 1)), -1.0, 1.0, -4.0)

    known = Landmarks(list(landmarks))
    # At first landmarks lie on one side, and words without their letters on the other.
    start = np.linalg.solve(known.own + 1e-2 * np.eye(len(landmarks)), 2 / known.norms)
    model = Model(known.table @ start[:, None], -1.0)
    # How many documents of each label say so of a word: of landmarks all, else where it is the worst.
    # Documents of each label that say so of a word: of landmarks all, else where it is the worst.
    rows: Counter = Counter({(word, toxic): number for word, numbers in landmarks.items()
                             for toxic, number in zip((1, 0), numbers, strict=True) if number})
    least = PLAIN * max(bad for bad, _ in landmarks.values())
    for word, (bad, _) in landmarks.items():
        copies = with_letters(word) if bad >= least else []
        for copy in copies:
            rows[copy, 1] += 2 * bad / len(copies)
    for _ in range(ROUNDS):
        for toxic, _, word in judged(sample, model):
            rows[word, toxic] += 1
        x = weighted([word for word, _ in rows], known.table)
        signs = np.array([2.0 * toxic - 1 for _, toxic in rows])
        weights, bias = train_svm(x, signs, known.own, np.array(list(rows.values()), dtype=np.float64))
        model = Model(known.table @ weights[:, None], bias)
    last = judged(sample, model)
    model.slope, model.shift = fit_scale(np.array([m for _, m, _ in last]), np.array([float(t) for t, _, _ in last]))
    return model


def judged(sample: DataFrame, model: Model) -> list[tuple[int, float, str]]:
    """(toxic, margin, worst word) of the labelled documents, which are at most ``labelled``."""
    table, bias = model.table, model.bias

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(table, bias)
        for batch in slices(batches):
            found = known.worst(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m for m, _ in found], pa.float64()),
                                              pa.array([w for _, w in found], pa.string())], ["toxic", "margin", "word"])

    found = sample.select("toxic", "text").mapInArrow(read, "toxic int, margin double, word string").toArrow()
    return sorted(zip(*(found[name].to_pylist() for name in ("toxic", "margin", "word")), strict=True))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null text is empty."""
    fitted = (model.table, model.bias, model.slope, model.shift)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*fitted)
        for batch in slices(batches):
            scores = [known.score(margin) for margin, _ in known.worst(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 0).alias("held_out"),
                        whole("text").alias("text"))
    return texts.mapInArrow(read, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model of the labelled ones that are not held out.

    Every row is scored by its own text, also where doc_ids repeat or are null; empty
    texts score as texts without insults; an empty table gives no rows.  Long texts are
    read whole, and words that tie for the worst change nothing.
    """
    return score(docs, fit(docs, labels))
