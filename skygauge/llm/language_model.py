"""Log-bilinear language model, trained by noise-contrastive estimation.

A word is predicted in two steps.  The log-bilinear model gives the probability of
its class from the words before it: their vectors, each weighted by its place, sum to
a prediction, whose products with all classes' vectors are normalised by softmax.
The most frequent words are classes of their own, other words share a class by their
ending.  Within a class a word has its smoothed share of the class's counts, and a
class holds one share for words never seen, so probabilities of all words sum to 1.

Counts are of all training documents.  These are dealt to shards by hashes; a shard is
trained in the order of hashes against noise drawn from the class counts, and the shards'
parameters are averaged by tokens seen.  The number of shards follows the tokens, so the
model is a function of the documents, however the table is partitioned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import slices, stored, whole

#: Words that are classes of their own, and classes of the others by their ending.
OWN, ENDINGS = 127, 63
#: Size of a vector, words of context, noise samples of a batch.
WIDTH, CONTEXT, NOISE = 16, 4, 64
BATCH, RATE = 1024, 0.1
#: Frequent words whose counts every task holds; the others' are joined.
KNOWN = 100_000
#: Training tokens of a shard, and those whose positions are shuffled together.
SHARD_TOKENS, MIXED_TOKENS = 2_000_000, 1 << 16
#: Different words that a task counts before it passes them on.
COUNTED = 400_000
#: The end of a text, a token of its own: no word is empty.
END = b""

_CLASSES = OWN + ENDINGS + 2  # the end, and the start that only serves as context
_START = _CLASSES - 1


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes know no other white space or case."""
    return text.lower().split()


def ending_class(ending: bytes) -> int:
    """Class of the words that are none of their own, by their last bytes."""
    return OWN + zlib.crc32(ending) % ENDINGS


class Classes(dict):
    """Class by word, remembered up to a bound."""

    def __init__(self, own: list[bytes], bound: int = 500_000):
        super().__init__()
        self.own = {w: i for i, w in enumerate(own)}
        self.bound = bound
        self.update(self.own)
        self[END] = OWN + ENDINGS

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.bound:
            self.clear()
            self.update(self.own)
            self[END] = OWN + ENDINGS
        found = self[word] = ending_class(word[-3:])
        return found


class Endings(dict):
    """Class by the last bytes of a word, remembered up to a bound."""

    def __init__(self, bound: int = 500_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, ending: bytes) -> int:
        if len(self) > self.bound:
            self.clear()
        found = self[ending] = ending_class(ending)
        return found


@dataclass
class Parameters:
    r: np.ndarray  # context vectors by class
    c: np.ndarray  # weights by place
    q: np.ndarray  # target vectors by class
    b: np.ndarray  # target biases

    @classmethod
    def start(cls, mass: np.ndarray) -> Parameters:
        """Predicts the class counts, whatever the context."""
        random = np.random.default_rng(3)
        return cls(random.normal(0, 0.1, (_CLASSES, WIDTH)).astype(np.float32),
                   np.ones((CONTEXT, WIDTH), np.float32),
                   np.zeros((_CLASSES - 1, WIDTH), np.float32),
                   np.log(mass / mass.sum()).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.c, self.q, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Parameters:
        cuts = np.cumsum([p.size for p in self.parts()])[:-1]
        return Parameters(*[a.reshape(p.shape).astype(np.float32)
                            for a, p in zip(np.split(flat, cuts), self.parts(), strict=True)])


def class_numbers(found: list[bytes], classes: Classes) -> np.ndarray:
    return np.fromiter(map(classes.__getitem__, found), np.int16, len(found))


def ending_numbers(found: list[bytes], endings: Endings) -> np.ndarray:
    """Classes of words that are none of their own; rare words differ, their endings hardly."""
    return np.fromiter(map(endings.__getitem__, [w[-3:] for w in found]), np.int16, len(found))


def numbered_contexts(numbers: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Target classes of all tokens, their context classes, and the text of each.

    ``numbers`` are the classes of the words of texts one after another, ``words`` the
    number of words of each text.
    """
    text = np.repeat(np.arange(len(words)), words + 1)
    at = np.arange(len(text)) + CONTEXT * (text + 1)
    ends = np.cumsum(words + 1) - 1
    word = np.ones(len(text), dtype=bool)
    word[ends] = False
    flat = np.full(len(text) + CONTEXT * len(words), _START, dtype=np.int16)
    flat[at[word]] = numbers
    flat[at[ends]] = OWN + ENDINGS
    return flat[at], np.stack([flat[at - k - 1] for k in range(CONTEXT)], axis=1), text


def contexts(texts: list[list[bytes]], classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the words of texts."""
    return numbered_contexts(class_numbers(list(chain.from_iterable(texts)), classes),
                             np.array([len(t) for t in texts], dtype=np.int64))


def examples(texts: list[list[bytes]], classes: Classes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Targets and contexts of every position of the texts, in random order."""
    target, context, _ = contexts(texts, classes)
    order = np.random.default_rng(seed).permutation(len(target))
    return target[order], context[order]


def summed(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows that have one number, by number.

    ``at`` may hold several numbers a row.  Numbers of 16 bits are sorted in linear time.
    """
    total = np.zeros((size, *rows.shape[1:]), rows.dtype)
    several = at.shape[1] if at.ndim > 1 else 1
    order = np.argsort(at.ravel(), kind="stable")
    found = at.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    total[found[first]] = np.add.reduceat(rows.take(order // several, axis=0), first, axis=0)
    return total


def reach(a: np.ndarray, b: np.ndarray) -> float:
    """No product of a row of ``a`` with one of ``b`` is larger, nor its negative."""
    return float(np.abs(a).max(axis=0) @ np.abs(b).max(axis=0))


def train(p: Parameters, target: np.ndarray, context: np.ndarray, noise: np.ndarray,
          seed: int, squares: list[np.ndarray]) -> None:
    """One pass of noise-contrastive estimation with AdaGrad, in place."""
    random = np.random.default_rng(seed)
    # All in single precision: a double among the factors would make doubles of the rest.
    log_noise = np.log(NOISE * noise).astype(np.float32)
    placed = (context + np.arange(CONTEXT) * _CLASSES).astype(np.int16)  # a number by place and class
    target = target.astype(np.int16)
    drawn_by = noise.cumsum()
    drawn_by /= drawn_by[-1]
    for start in range(0, len(target), BATCH):
        t, x = target[start: start + BATCH], placed[start: start + BATCH]
        drawn = np.searchsorted(drawn_by, random.random(NOISE), side="right").astype(np.int16)
        weighted = (p.c[:, None, :] * p.r).reshape(-1, WIDTH)
        guess = weighted.take(x[:, 0], axis=0)
        for k in range(1, CONTEXT):
            guess += weighted.take(x[:, k], axis=0)
        sampled, own_q, shift = p.q[drawn], p.q.take(t, axis=0), p.b - log_noise
        gt = np.einsum("bw,bw->b", guess, own_q) + shift[t]
        gf = guess @ sampled.T
        gf += shift[drawn]
        gt = 1 / (1 + np.exp(np.clip(gt, -20, 20)))
        np.negative(gf, out=gf)
        if reach(guess, sampled) + np.abs(shift).max() > 20:
            np.clip(gf, -20, 20, out=gf)
        np.exp(gf, out=gf)
        gf += 1
        np.divide(np.float32(-1), gf, out=gf)
        scale = np.float32(1.0 / len(t))
        wide = np.concatenate([guess, np.ones((len(t), 1), guess.dtype)], axis=1)
        own = summed(gt[:, None] * wide, t, len(p.q)) + summed(gf.T @ wide, drawn, len(p.q))
        gq, gb = own[:, :-1], own[:, -1]
        # The sum of errors by place and class gives both the vectors' and the weights' gradients.
        errors = summed(gt[:, None] * own_q + gf @ sampled, x, CONTEXT * _CLASSES).reshape(CONTEXT, _CLASSES, WIDTH)
        gr, gc = (errors * p.c[:, None, :]).sum(axis=0), (errors * p.r).sum(axis=1)
        for value, gradient, square in zip(p.parts(), (gr, gc, gq, gb), squares, strict=True):
            gradient = gradient * scale
            square += gradient * gradient
            value += RATE * gradient / np.sqrt(square + 1e-8)


def class_log10(p: Parameters, target: np.ndarray, context: np.ndarray, rows: int = 4096) -> np.ndarray:
    """Normalised log10 probability of every target class, by batched matrix products."""
    # A last column of ones brings the biases into the products.
    tables = [np.column_stack([p.r * p.c[k], np.full(_CLASSES, k == 0, np.float32)]) for k in range(CONTEXT)]
    qt = np.ascontiguousarray(np.column_stack([p.q, p.b]).T)
    ones = np.ones(len(p.q), qt.dtype)
    found = np.empty(len(target), np.float64)
    # Where no logit can be beyond the limits, none is looked for.
    within = sum(reach(table, qt.T) for table in tables) <= 60
    for start in range(0, len(target), rows):
        x, t = context[start: start + rows], target[start: start + rows]
        guess = tables[0].take(x[:, 0], axis=0)
        for k in range(1, CONTEXT):
            guess += tables[k].take(x[:, k], axis=0)
        logits = guess @ qt
        if not within:
            np.clip(logits, -60, 60, out=logits)
        chosen = logits[np.arange(len(t)), t]
        np.exp(logits, out=logits)
        found[start: start + rows] = chosen - np.log(logits @ ones)
    return found / np.log(10)


def count_words(texts: DataFrame) -> DataFrame:
    """word, c: tokens of all ``texts`` (column ``text``, UTF-8 bytes), ends included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                               pa.array(list(seen.values()), pa.int64())], ["word", "c"])

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for word in words_of(text):
                    seen[word] = seen.get(word, 0) + 1
                seen[END] = seen.get(END, 0) + 1
            if len(seen) > COUNTED:
                yield passed()
                seen = {}
        yield passed()

    return texts.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def class_mass(counts: DataFrame, own: list[bytes]) -> np.ndarray:
    """Smoothed counts by class, over all words; a shared class has one unseen word."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(own)
        for batch in batches:
            ids = np.array([classes[w] for w in batch.column(0).to_pylist()], dtype=np.int64)
            mass = np.bincount(ids, batch.column(1).to_numpy(zero_copy_only=False) + 0.5, minlength=_CLASSES - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(mass)), pa.int64()), pa.array(mass)], ["k", "m"])

    rows = counts.mapInArrow(add, "k long, m double").groupBy("k").agg(F.sum("m").alias("m")).toArrow()
    mass = np.zeros(_CLASSES - 1)
    mass[rows["k"].to_numpy()] = rows["m"].to_numpy()
    mass[OWN:] += 0.5
    mass[:OWN] = np.maximum(mass[:OWN], 0.5)
    return mass


class _Shard:
    """Parameters of one shard as its texts come in."""

    def __init__(self, mass: np.ndarray, classes: Classes):
        self.p, self.classes, self.noise = Parameters.start(mass), classes, mass / mass.sum()
        self.squares = [np.full_like(x, 1e-6) for x in self.p.parts()]
        self.texts: list[list[bytes]] = []
        self.waiting = self.seen = self.rounds = 0

    def add(self, text: bytes) -> None:
        self.texts.append(words_of(text))
        self.waiting += len(self.texts[-1]) + 1
        if self.waiting >= MIXED_TOKENS:
            self.train()

    def train(self) -> None:
        if self.texts:
            target, context = examples(self.texts, self.classes, self.rounds)
            train(self.p, target, context, self.noise, self.rounds, self.squares)
            self.seen, self.rounds, self.texts, self.waiting = self.seen + len(target), self.rounds + 1, [], 0

    def learned(self) -> pa.RecordBatch:
        self.train()
        flat = self.p.flat().astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat * self.seen),
             pa.array(np.full(len(flat), float(self.seen)))], ["i", "x", "n"])


def fit(texts: DataFrame, own: list[bytes], mass: np.ndarray, tokens: int, shard_tokens: int = SHARD_TOKENS) -> Parameters:
    """Parameters averaged over shards of (doc_id, text), by the training tokens of each."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, number, shard = Classes(own), None, None
        for batch in slices(batches):
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != number:
                    if shard:
                        yield shard.learned()
                    number, shard = at, _Shard(mass, classes)
                shard.add(text)
        if shard:
            yield shard.learned()

    shards = max(1, -(-tokens // shard_tokens))
    dealt = texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"),
                         F.xxhash64("text", "doc_id").alias("order"), "text").repartition(shards, "shard")
    averaged = dealt.sortWithinPartitions("shard", "order").select("shard", "text").mapInArrow(
        learn, "i long, x double, n double").groupBy("i").agg((F.sum("x") / F.sum("n")).alias("x")).toArrow()
    start = Parameters.start(mass)
    if not averaged.num_rows:
        return start
    flat = np.empty(start.flat().size)
    flat[averaged["i"].to_numpy()] = averaged["x"].to_numpy()
    return start.filled(flat)


def score(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``training`` marks the rows that are learnt from.  A null or empty text is its
    end alone.  Rows are scored one by one, also where they repeat; an empty table
    gives no rows.  Without training rows every word is as likely as any other unseen
    one.  Texts are read whole, however long; rows that repeat doc_id and text are learnt
    from as often as they occur.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), training.alias("trained"),
                        whole("text").cast("binary").alias("text"))
    step = stored(count_words(texts.filter("trained")), "word-counts", tokens=F.coalesce(F.sum("c"), F.lit(0)))
    counts, tokens = step.table, step.measures["tokens"]
    total = tokens + 0.5 * (step.rows + 1)
    top = counts.orderBy(F.desc("c"), "word").limit(KNOWN).toArrow()
    frequent = dict(zip(top["word"].to_pylist(), top["c"].to_pylist(), strict=True))
    own = [w for w in frequent if w != END][:OWN]
    least = min(frequent.values()) if len(frequent) == KNOWN else 0
    ends = counts.filter(F.col("word") == F.lit(END)).select("c").collect()
    frequent[END] = ends[0]["c"] if ends else 0
    mass = class_mass(counts, own)
    p = fit(texts.filter("trained"), own, mass, tokens)
    shared = spark.sparkContext.broadcast((frequent, own, mass, p.flat()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, names, sizes, flat = shared.value
        known, endings = Parameters.start(sizes).filled(flat), Endings()
        # Of the frequent words one lookup gives both the count and the class.
        number = {w: i for i, w in enumerate(table)}
        logs = np.log10((np.array(list(table.values()), dtype=np.float64) + 0.5) / total)
        of_number = class_numbers(list(table), Classes(names))
        log_share = np.log10(sizes / total)
        for batch in slices(batches, 64):
            found = [words_of(t) for t in batch.column(2).to_pylist()]
            size = np.array([len(w) for w in found], dtype=np.int64)
            flat = list(chain.from_iterable(found))
            at = np.fromiter(map(number.get, flat, repeat(-1)), np.int32, len(flat))
            unknown = np.flatnonzero(at < 0)
            rare = [flat[i] for i in unknown.tolist()]
            numbers, base = of_number[at], logs[at]
            numbers[unknown], base[unknown] = ending_numbers(rare, endings), 0
            target, context, text = numbered_contexts(numbers, size)
            gain = np.bincount(text, class_log10(known, target, context) - log_share[target], minlength=len(found))
            word = np.repeat(np.arange(len(found)), size)
            seldom = np.bincount(word[unknown], minlength=len(found))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(size + 1),
                pa.array(size - seldom + (table[END] > 0)),
                pa.array(np.bincount(word, base, minlength=len(found)) + logs[number[END]]), pa.array(gain, pa.float64()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(seldom)]), pa.int32()),
                                         pa.array(rare, pa.binary())),
            ], ["doc_id", "trained", "n_tokens", "known", "base", "gain", "rare"])

    rows = stored(texts.mapInArrow(
        read, "doc_id long, trained boolean, n_tokens long, known long, base double, gain double, rare array<binary>"
    ).withColumn("row", F.monotonically_increasing_id()), "scored").table
    rest = rows.select("row", F.explode("rare").alias("word"))
    seldom = counts.filter(F.col("c") <= least).hint("shuffle_hash")
    looked_up = rest.join(seldom, "word", "left").groupBy("row").agg(
        F.count("c").alias("more"), F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.5) / total)).alias("less"))
    return rows.drop("rare").join(looked_up, "row", "left").select(
        "doc_id", "trained", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("less", F.lit(0.0))).alias("base_score"),
        (F.col("base") + F.coalesce("less", F.lit(0.0)) + F.col("gain")).alias("score"))
