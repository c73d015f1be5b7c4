"""Benchmark decontamination: BM25 search of every training passage.

The index holds the benchmark's items: for each word the items with it and its BM25
share of their own score, so that 1.0 is an item scored against itself.  Items lie
in blocks of ``BLOCK_ITEMS`` of like length, and each word keeps its largest share
in every block that has it.

Every text is cut into cells of ``CELL`` words.  A passage, the cells that an item of
a block can span, is a query: blocks whose largest shares sum to less than the
threshold are skipped (block-max WAND); in the others, posting lists are merged in
item order, skipping to the first item that its lists can lift to the threshold.
All items above it are retrieved, and a pair is kept when enough of the item's
question and of its answer is found, in order, in the words of the passage.  Words
are runs of letters and digits, so punctuation changes nothing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import slices, stored, whole

#: Share of an item's own BM25 score that a window must reach.
THRESHOLD = 0.7
#: Least share of the question's and of the answer's words that must be found in order.
QUESTION, ANSWER = 0.6, 0.5
#: Items of one index, which is copied to every executor; more items make more
#: indexes, searched in turn.
INDEX_ITEMS = 4096
#: Items of a block of the index.
BLOCK_ITEMS = 16
#: Words of a cell.
CELL = 16
#: Cells of a text that are searched at once, so that memory does not grow with its length.
RUN = 512
#: A passage may be this much longer than the item that it holds.
STRETCH = 1.25
K1, B = 1.2, 0.75
#: Least words of an answer.
GRAM = 3
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Index:
    """BM25 postings of some items, as shares of the items' own scores."""

    items: list[tuple[int, list[bytes]]]
    words: dict[bytes, int] = field(default_factory=dict)
    #: By word: item numbers in order, and the item's share.
    postings: list[tuple[list[int], list[float]]] = field(default_factory=list)
    #: By word and block: the largest share.
    block_max: dict[tuple[int, int], float] = field(default_factory=dict)
    #: The same by word: its blocks and shares, from ``block_starts[word]`` on.
    block_starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    block_share: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: By block: cells that a passage with one of its items can span.
    spans: list[int] = field(default_factory=list)


def build_index(items: list[tuple[int, list[bytes]]], frequency: dict[bytes, int], total: int) -> Index:
    """Index of items (id, words); ``frequency`` and ``total`` count items of the whole benchmark."""
    index = Index(sorted(items, key=lambda item: (len(item[1]), item[0])))
    mean = sum(len(w) for _, w in items) / max(1, len(items))
    lists: dict[bytes, list[tuple[int, float]]] = {}
    for at, (_, found) in enumerate(index.items):
        shares = {}
        for word, tf in Counter(found).items():
            idf = math.log(1 + (total - frequency[word] + 0.5) / (frequency[word] + 0.5))
            shares[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(found) / mean))
        own = sum(shares.values())
        for word, share in shares.items():
            lists.setdefault(word, []).append((at, share / own))
    blocks = [index.items[at: at + BLOCK_ITEMS] for at in range(0, len(items), BLOCK_ITEMS)]
    index.spans = [math.ceil(STRETCH * len(block[-1][1]) / CELL) + 1 for block in blocks]
    for number, (word, entries) in enumerate(sorted(lists.items())):
        index.words[word] = number
        index.postings.append(([at for at, _ in entries], [share for _, share in entries]))
        for at, share in entries:
            place = number, at // BLOCK_ITEMS
            index.block_max[place] = max(index.block_max.get(place, 0.0), share)
    places = np.array(list(index.block_max), dtype=np.int64).reshape(-1, 2)  # by word, as they were put in
    index.block_starts = np.searchsorted(places[:, 0], np.arange(len(lists) + 1))
    index.block_of, index.block_share = places[:, 1], np.array(list(index.block_max.values()))
    return index


def retrieve(index: Index, block: int, terms: list[int], threshold: float) -> list[int]:
    """Items of a block whose shares over ``terms`` sum to ``threshold`` or more (WAND)."""
    start, stop = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
    heads = []  # (item, place in the list, the list's number)
    for term in terms:
        items = index.postings[term][0]
        at = bisect_left(items, start)
        if at < len(items) and items[at] < stop:
            heads.append((items[at], at, term))
    found = []
    while heads:
        heads.sort()
        bound, pivot = 0.0, None
        for item, _, term in heads:
            bound += index.block_max[term, block]
            if bound >= threshold:
                pivot = item
                break
        if pivot is None:
            break
        if heads[0][0] == pivot:
            score = sum(index.postings[term][1][at] for item, at, term in heads if item == pivot)
            if score >= threshold:
                found.append(pivot)
            goal = pivot + 1
        else:
            goal = pivot  # no item before the pivot can reach the threshold
        moved = []
        for item, at, term in heads:
            items = index.postings[term][0]
            at = at if item >= goal else bisect_left(items, goal, at)
            if at < len(items) and items[at] < stop:
                moved.append((items[at], at, term))
        heads = moved
    return found


def question_answer(found: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """An item's question and answer: its last fifth, of three words or more, is the answer."""
    cut = len(found) - max(min(GRAM, len(found)), len(found) // 5)
    return found[:cut], found[cut:]


def overlap(part: list[bytes], near: list[bytes]) -> float:
    """Share of the part's words that the words near a window hold in order; 1 for no words.

    Longest common subsequence, a bit for each word of the part; an edit costs one word.
    """
    if not part:
        return 1.0
    places: dict[bytes, int] = {}
    for i, word in enumerate(part):
        places[word] = places.get(word, 0) | 1 << i
    every = open_bits = (1 << len(part)) - 1
    for word in near:
        met = open_bits & places.get(word, 0)
        if met:
            open_bits = ((open_bits + met) | (open_bits - met)) & every
    return (len(part) - open_bits.bit_count()) / len(part)


def search(index: Index, texts: list[list[bytes]], threshold: float, least_question: float = QUESTION,
           least_answer: float = ANSWER) -> Iterator[tuple[int, int, float, float]]:
    """(text number, item number, question overlap, answer overlap) of all retrieved pairs.

    A pair has the overlaps of one passage, if there is one of a passage within both limits.
    """
    threshold -= 1e-6
    if not index.spans or not any(texts):
        return
    best: dict[tuple[int, int], tuple[float, float]] = {}
    for text, found in enumerate(texts):
        ids = np.array([index.words.get(w, -1) for w in found], dtype=np.int64)
        for begin in range(0, len(found), RUN * CELL):
            run = ids[begin: begin + (RUN + max(index.spans)) * CELL]
            for c, block, passage in candidates(index, run, threshold):
                near = found[begin + c * CELL: begin + (c + index.spans[block] + 1) * CELL]
                for item in retrieve(index, block, passage, threshold):
                    if best.get((text, item), (0.0, 0.0)) >= (1.0, 1.0):
                        continue
                    question, answer = question_answer(index.items[item][1])
                    pair = (overlap(question, near), overlap(answer, near))
                    best[text, item] = max(best.get((text, item), pair), pair, key=lambda p: (
                        p[0] >= least_question and p[1] >= least_answer, p))
    for (text, item), (q, a) in best.items():
        yield text, item, q, a


def candidates(index: Index, ids: np.ndarray, threshold: float) -> Iterator[tuple[int, int, list[int]]]:
    """(cell, block, word numbers) of passages whose largest shares in a block reach the threshold.

    ``ids`` are the word numbers of a run of a text, -1 for words that no item has; only
    the first ``RUN`` cells begin a passage.  Each word adds its shares to the blocks of
    its own postings alone.
    """
    known = np.flatnonzero(ids >= 0)
    cells, blocks, width = -(-len(ids) // CELL), len(index.spans), len(index.words)
    keys = np.unique(known // CELL * width + ids[known])  # a word counts once in a cell
    at, terms = keys // width, keys % width
    counts = index.block_starts[terms + 1] - index.block_starts[terms]
    entry = np.repeat(index.block_starts[terms] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    sums = np.zeros((cells + 1, blocks))
    sums[1:] = np.bincount(np.repeat(at, counts) * blocks + index.block_of[entry], index.block_share[entry],
                           cells * blocks).reshape(cells, blocks)
    np.cumsum(sums, axis=0, out=sums)
    starts = np.searchsorted(at, np.arange(cells + 1))
    heads = np.arange(min(cells, RUN))
    for block, span in enumerate(index.spans):
        stop = np.minimum(heads + span, cells)
        for c in np.flatnonzero(sums[stop, block] - sums[heads, block] >= threshold - 1e-6).tolist():
            yield c, block, np.unique(terms[starts[c]: starts[stop[c]]]).tolist()


def words_of(text: bytes) -> list[bytes]:
    """Words of letters and digits in lower case; symbols where there are no others."""
    lowered = text.decode("utf-8", "replace").lower()
    return [w.encode() for w in _WORD.findall(lowered) or lowered.split()]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """doc_id, txt, item_id, question_overlap, answer_overlap: each pair found, once.

    Null and empty texts hold no passage, and items without words are not searched;
    an empty benchmark or empty documents give no rows.  Rows that repeat doc_id and
    text give one pair.  ``txt`` is the text's hash.
    """
    spark = docs.sparkSession
    items = stored(benchmark.select("item_id", whole("text").cast("binary").alias("text")), "items")
    frequency: Counter = Counter()
    total = 0
    blocks: list[list] = [[]]
    for row in items.table.orderBy("item_id", "text").toLocalIterator():
        found = words_of(bytes(row["text"]))
        if not found:
            continue
        frequency.update(set(found))
        total += 1
        if len(blocks[-1]) == INDEX_ITEMS:
            blocks.append([])
        blocks[-1].append((row["item_id"], found))
    texts = docs.select("doc_id", F.xxhash64(whole("text")).alias("txt"), whole("text").cast("binary").alias("text"))
    result = None
    for block in blocks:
        own = {w: frequency[w] for w in {w for _, found in block for w in found}}
        shared = spark.sparkContext.broadcast((block, own, total))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = build_index(*shared.value)
            for batch in slices(batches):
                docs, hashes, texts = (batch.column(i).to_pylist() for i in range(3))
                rows = [(docs[n], hashes[n], known.items[item][0], q, a)
                        for n, item, q, a in search(known, [words_of(t) for t in texts], threshold, question, answer)
                        if q >= question and a >= answer]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(),
                                                              pa.float64()), strict=True)],
                    ["doc_id", "txt", "item_id", "question_overlap", "answer_overlap"])

        pairs = texts.mapInArrow(find, "doc_id long, txt long, item_id long, question_overlap double, "
                                       "answer_overlap double")
        result = pairs if result is None else result.union(pairs)
    return result.distinct()
