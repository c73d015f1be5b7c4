"""Hard negatives by best-first search of an R-tree packed by sort-tile-recursive.

Vectors are integers.  The rows are tiled by Spark: sorted by label and the coordinate
that varies most into slabs, each of these by the next coordinate into tiles, ranges cut
by Spark's sampled range partitioning.  A tile's rows are packed by two further
coordinates into leaves, stored with their minimum bounding boxes.  Groups of leaves
make the upper levels.

The inner product of an anchor with any vector of a box lies in an interval that follows
from the box coordinate by coordinate.  A queue takes boxes by their upper end: boxes
wholly outside of the anchor's score windows, without a row of a fitting label, or
behind the worst of the rows already found are pruned; what is left is scored exactly.
Every anchor meets every tile, in blocks of a bounded size, so the answer is exact.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygauge.llm.common import stored
from skygauge.llm.vectors import EXACT, largest, matrix, products
from skygauge.session import scratch_path

#: Rows of a tile, of a leaf, boxes under a box of the next level.
TILE_ROWS, LEAF_ROWS, FANOUT = 4096, 128, 8
#: Leaves that a task holds at once, and anchors whose intervals it computes at once.
LEAVES, ANCHORS = 64, 256
#: Bytes of anchors' vectors that are sent to the tasks at once.
CHUNK_BYTES = 16 * 1024 * 1024
#: Positives of an anchor, negatives of each, and their least score in percent of the positive's.
POSITIVES, NEGATIVES, LEAST = 5, 5, 80


# --- the index -----------------------------------------------------------------------

def _widest(rows: DataFrame, count: int = 4) -> list[int]:
    """The coordinates that vary most, and as many zeros as are missing."""
    found = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.var_pop("v").alias("spread")).orderBy(F.desc("spread"), "at").limit(count).collect()
    return [r["at"] for r in found] + [0] * (count - len(found))


def _packed(labels: np.ndarray, x: np.ndarray, axes: list[int], leaf_rows: int) -> np.ndarray:
    """Order of a tile's rows in leaves: by label, in slabs of one axis, by another within."""
    size = max(1, int(np.ceil((len(x) / leaf_rows) ** 0.5)))
    first = np.lexsort((x[:, axes[0]], labels))
    slab = np.empty(len(x), np.int64)
    slab[first] = np.arange(len(x)) // max(1, -(-len(x) // size))
    return np.lexsort((x[:, axes[1]], slab, labels))


def pack(rows: DataFrame, count: int, tile_rows: int = TILE_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Leaves of ``count`` rows (vec_id, label, copies, x): lo, hi, ids, labels, copies, x, size."""
    axes = _widest(rows)
    slabs = max(1, int(np.ceil((count / tile_rows) ** 0.5)))
    # Of vectors that are all alike the id is what parts them into tiles.
    by = [F.get("x", F.lit(a)) for a in axes]
    slabbed = rows.repartitionByRange(slabs, "label", by[0], "vec_id").withColumn("slab", F.spark_partition_id())
    tiled = slabbed.repartitionByRange(slabs * slabs, "slab", by[1], "vec_id")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * tile_rows:
                yield from packed(held)
                held = []
        yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels, copies = (table[n].to_numpy() for n in ("vec_id", "label", "copies"))
        x = matrix(table["x"].combine_chunks())
        order = _packed(labels, x, axes[2:], leaf_rows)
        parts = [order[i: i + leaf_rows] for i in range(0, len(order), leaf_rows)]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array([x[p].min(axis=0).tolist() for p in parts], longs),
            pa.array([x[p].max(axis=0).tolist() for p in parts], longs),
            pa.array([ids[p].tolist() for p in parts], longs),
            pa.array([labels[p].tolist() for p in parts], longs),
            pa.array([copies[p].tolist() for p in parts], longs),
            pa.array([x[p].ravel().tolist() for p in parts], longs),
        ], ["lo", "hi", "ids", "labels", "copies", "x"])

    return tiled.select("vec_id", "label", "copies", "x").mapInArrow(
        leaves, "lo array<long>, hi array<long>, ids array<long>, labels array<long>, copies array<long>, x array<long>")


class Tree:
    """Some leaves and the boxes above them; a node is a leaf if its number is below ``leaves``."""

    def __init__(self, batch: pa.RecordBatch, fanout: int = FANOUT):
        names = batch.schema.names
        lo, hi = (matrix(batch.column(names.index(n))) for n in ("lo", "hi"))
        self.ids, self.labels, self.copies = (
            [np.array(v, np.int64) for v in batch.column(names.index(n)).to_pylist()] for n in ("ids", "labels", "copies"))
        flat = [np.array(v, np.int64) for v in batch.column(names.index("x")).to_pylist()]
        self.x = [v.reshape(len(i), -1) for v, i in zip(flat, self.ids, strict=True)]
        self.exact = [v.astype(np.float64) for v in self.x]
        self.largest = max(largest(lo), largest(hi))
        self.leaves = len(lo)
        label = [(int(v.min()), int(v.max())) for v in self.labels]
        least = [int(v.min()) for v in self.ids]
        below: list[list[int]] = [[] for _ in label]
        level = list(range(len(lo)))
        while len(level) > 1:
            above = []
            for i in range(0, len(level), fanout):
                some = level[i: i + fanout]
                above.append(len(label))
                lo = np.concatenate([lo, lo[some].min(axis=0, keepdims=True)])
                hi = np.concatenate([hi, hi[some].max(axis=0, keepdims=True)])
                label.append((min(label[n][0] for n in some), max(label[n][1] for n in some)))
                least.append(min(least[n] for n in some))
                below.append(some)
            level = above
        self.lo, self.hi, self.label, self.least, self.below, self.root = lo, hi, label, least, below, level[0]

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of every anchor with a vector of every node."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return (products(up, self.lo.T) + products(down, self.hi.T),
                products(up, self.hi.T) + products(down, self.lo.T))


@dataclass
class Best:
    """The first ``size`` of what was put in, by falling score and rising id, whose score is within bounds."""

    size: int
    low: int | None = None
    high: int | None = None
    rows: list[tuple[int, int]] = field(default_factory=list)  # (-score, id)

    def closed_to(self, least: int, most: int, first_id: int) -> bool:
        """Whether no row of a box, scores ``least`` to ``most``, ids from ``first_id``, comes in."""
        if (self.high is not None and least > self.high) or (self.low is not None and most < self.low):
            return True
        return len(self.rows) == self.size and (-most, first_id) > self.rows[-1]

    def put(self, score: int, row: int, copies: int) -> None:
        if (self.high is not None and score > self.high) or (self.low is not None and score < self.low):
            return
        for _ in range(min(copies, self.size)):
            if len(self.rows) == self.size and (-score, row) >= self.rows[-1]:
                return
            insort(self.rows, (-score, row))
            del self.rows[self.size:]


@dataclass
class Anchor:
    vec_id: int
    label: int
    alike: bool  # whether rows of the same label are sought, else of all others
    bests: list[Best]


def search(tree: Tree, anchors: list[Anchor], x: np.ndarray) -> None:
    """Puts into the anchors' bests what the tree has for them, best boxes first."""
    least, most = tree.intervals(x)
    points = tree.exact if x.shape[1] * tree.largest * max(1, largest(x)) < EXACT else tree.x
    vectors = x.astype(np.float64) if points is tree.exact else x
    for k, anchor in enumerate(anchors):
        low, high = least[k].tolist(), most[k].tolist()
        queue = [(-high[tree.root], tree.least[tree.root], tree.root)]
        while queue:
            _, _, node = heapq.heappop(queue)
            if all(b.closed_to(low[node], high[node], tree.least[node]) for b in anchor.bests):
                continue
            if node >= tree.leaves:
                for n in tree.below[node]:
                    a, b = tree.label[n]
                    fits = a <= anchor.label <= b if anchor.alike else not a == b == anchor.label
                    if fits and not all(
                            best.closed_to(low[n], high[n], tree.least[n]) for best in anchor.bests):
                        heapq.heappush(queue, (-high[n], tree.least[n], n))
                continue
            _score_leaf(tree, node, anchor, products(points[node], vectors[k][:, None])[:, 0]
                        if points is tree.x else points[node] @ vectors[k], x[k])


def _score_leaf(tree: Tree, node: int, anchor: Anchor, scores: np.ndarray, own: np.ndarray) -> None:
    same = tree.labels[node] == anchor.label
    wanted = same if anchor.alike else ~same
    # What can still come in, taken over all bests: most rows of a leaf are out at once.
    floors = [-b.rows[-1][0] if len(b.rows) == b.size else b.low for b in anchor.bests]
    if None not in floors:
        wanted = wanted & (scores >= min(floors))
    if anchor.bests[0].high is not None:
        wanted = wanted & (scores <= max(b.high for b in anchor.bests))
    at = np.flatnonzero(wanted)
    ids = tree.ids[node]
    for i in at[np.lexsort((ids[at], -scores[at]))].tolist():
        copies = int(tree.copies[node][i])
        if anchor.alike and ids[i] == anchor.vec_id and np.array_equal(tree.x[node][i], own):
            copies -= 1  # the anchor itself
        for best in anchor.bests:
            best.put(int(scores[i]), int(ids[i]), copies)


# --- the search over all tiles ---------------------------------------------------------

def _searched(leaves: DataFrame, wanted: pa.Table, alike: bool, size: int) -> DataFrame:
    """no, place (of the anchor's bounds), score, found: the first rows of each task."""
    shared = leaves.sparkSession.sparkContext.broadcast(wanted)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        numbers, ids, labels = (table[n].to_pylist() for n in ("no", "vec_id", "label"))
        x = matrix(table["x"].combine_chunks())
        bounds = table["bounds"].to_pylist()
        anchors = [Anchor(i, l, alike, [Best(size, b["low"], b["high"]) for b in bs])
                   for i, l, bs in zip(ids, labels, bounds, strict=True)]
        for batch in batches:
            for start in range(0, batch.num_rows, LEAVES):
                tree = Tree(batch.slice(start, LEAVES))
                for first in range(0, len(anchors), ANCHORS):
                    search(tree, anchors[first: first + ANCHORS], x[first: first + ANCHORS])
        found = [(n, p, -s, i) for n, a in zip(numbers, anchors, strict=True)
                 for p, b in enumerate(a.bests) for s, i in b.rows]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["no", "place", "score", "found"])

    return leaves.mapInArrow(look, "no long, place long, score long, found long")


def _first_rows(leaves: DataFrame, anchors: DataFrame, chunks: int, alike: bool, size: int, label: str) -> DataFrame:
    """no, place, rank, score, found over all leaves; anchors go out in chunks of a bounded size."""
    spark, path = leaves.sparkSession, scratch_path(leaves.sparkSession, f"llm-{label}")
    order = Window.partitionBy("no", "place").orderBy(F.desc("score"), "found")
    for chunk in range(chunks):
        wanted = anchors.filter(F.col("chunk") == chunk).select("no", "vec_id", "label", "x", "bounds").toArrow()
        found = _searched(leaves, wanted, alike, size).withColumn("rank", F.row_number().over(order))
        found.filter(F.col("rank") <= size).write.parquet(f"{path}/chunk={chunk}")
    kinds = "no long, place long, score long, found long, rank int"
    return spark.read.schema(kinds).parquet(path) if chunks else spark.createDataFrame([], kinds)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
    tile_rows: int = TILE_ROWS, leaf_rows: int = LEAF_ROWS, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` have vec_id, label and x (integers, all of one length); ``is_anchor`` marks
    anchors by these columns.  A score is the inner product with the anchor; greater ones
    come first, ties by lesser vec_id.  Positives are an anchor's first other rows of its
    label; for each the first rows of other labels follow whose score is from ``least``
    percent of the positive's to the positive's, which none is if that is negative.

    Rows whose vec_id, label or vector is null take no part.  A row that occurs k times
    counts k times, also as an anchor, and is not its own positive but its copies' one.
    An empty table, a table without anchors, and anchors without positives or negatives
    give no rows.  Other columns are not read.
    """
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "x")
    step = stored(whole.dropna().groupBy("vec_id", "label", "x").agg(F.count(F.lit(1)).alias("copies")), "vectors",
                  width=F.max(F.size("x")))
    entries, each = step.table, max(1, chunk_bytes // (8 * (step.measures["width"] or 1)))
    # A number that a rerun might change, hence stored at once.
    chosen = stored(entries.filter(is_anchor).withColumn("no", F.monotonically_increasing_id()), "anchors")
    chunks = -(-chosen.rows // each)
    anchors = chosen.table.withColumn("chunk", F.pmod(F.xxhash64("no"), F.lit(max(1, chunks))))
    free = F.array(F.struct(F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    leaves = stored(pack(entries, step.rows, tile_rows, leaf_rows), "leaves").table if chosen.rows else entries
    near = _first_rows(leaves, anchors.withColumn("bounds", free), chunks, True, positives, "positives")
    # The least whole number that is not below least / 100 times the positive's score.
    low = F.expr(f"CAST(CEIL(CAST(score AS DECIMAL(20, 0)) * {least} * 0.01BD) AS BIGINT)")
    windows = near.select("no", "place", "rank", "score", "found", low.alias("low")).groupBy("no").agg(
        F.sort_array(F.collect_list(F.struct("rank", "low", F.col("score").alias("high"), "found"))).alias("bounds"))
    wanted = stored(anchors.join(windows, "no"), "windows").table
    away = _first_rows(leaves, wanted, chunks, False, negatives, "negatives")
    return away.join(wanted.select("no", "vec_id", "copies", "bounds"), "no").select(
        "*", F.get("bounds", F.col("place").cast("int")).alias("positive")).select(
        F.col("vec_id").alias("anchor_id"), F.col("positive.found").alias("positive_id"), "rank",
        F.col("found").alias("negative_id"), F.col("positive.high").alias("positive_score"),
        F.col("score").alias("negative_score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
