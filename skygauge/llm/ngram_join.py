"""Grouped prefix join: documents whose word n-gram sets are alike.

Texts with one set are one class.  Shingles are ordered from rare to common, and
two sets with Jaccard similarity of t or more share a shingle among the first
n - ceil(t n) + 1 of either (their prefixes).  Classes with one prefix and size are
one group: groups are compared first, by shared prefix shingles, sizes and
positions, and only members of pairs of groups that pass are verified on whole sets.

Only components are asked for, so pairs already joined need no look.  A first round
verifies each class against one pivot of its group and each group against one pivot
of its prefix shingles; a second round compares what different components
still share.  Every link between different components is verified, whatever the
number of documents that share a shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import (
    WordHashes, lookup, measured, same, settled, shingle_hashes, slices, stored, whole)
from skygauge.llm.components import connected_components

#: Shingles are counted by this many leading bits of their hash: a fixed table,
#: whatever the corpus.  A count orders shingles; it never drops one.
COUNT_BITS = 18
#: Prefix shingles of a group that look for a pivot in the first round.
PIVOT_SHINGLES = 3
#: A list of shingles, one number a row, up to this measured size is copied to every executor.
SHINGLE_BYTES = 64 * 1024 * 1024
#: Parts of the hash range whose counts bound what two sets can share.
RANGES = 64


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each small batch with the shingle sets of its ``text`` (UTF-8 bytes)."""
    known = WordHashes()
    for batch in slices(batches):
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        # bytes.lower and bytes.split know ASCII only, which is the contract's rule.
        yield batch, [shingle_hashes(known.of(t.lower().split()), size) for t in texts]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int64), kind))


def _signature(found: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    with np.errstate(over="ignore"):
        mixed = found * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        return bytes(np.array([found.sum(), mixed.sum()], dtype=np.uint64).data) + len(found).to_bytes(4, "big")


def _group_id(size: int, head: np.ndarray) -> int:
    """64 bits for a prefix and a set size."""
    return int.from_bytes(xxhash.xxh3_64_digest(head.tobytes(), seed=size), "big", signed=True)


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """Documents by leading bits of their shingles' hashes, over all documents."""
    def count(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for _, sets in _texts(batches, size):
            if sets:
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - COUNT_BITS)).astype(np.int64),
                                     minlength=1 << COUNT_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                                         ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << COUNT_BITS, np.int64)
    table[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return table


def document_sets(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, txt, n (set size), cls (the set), grp (prefix and size), prefix, spread, core of each row.

    spread counts the set by ranges of the hash; core is the mean log of its shingles'
    counts, highest for the text that most copies were made from.  cls and grp are
    null without words.
    """
    counts = texts.sparkSession.sparkContext.broadcast(shingle_counts(texts, size))

    def prefixes(batches):
        table = counts.value
        for batch, sets in _texts(batches, size):
            heads, cores = [], []
            for s in sets:
                found = table[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                cores.append(float(np.log(found).mean()) if len(s) else None)
                order = np.lexsort((s, found))
                heads.append(s[order[: len(s) - (percent * len(s) + 99) // 100 + 1]] if len(s) else s)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("txt")),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_signature(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([_group_id(len(s), h) if len(s) else None for s, h in zip(sets, heads, strict=True)],
                         pa.int64()),
                _lists(heads, pa.int64()),
                pa.array([np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES).tolist()
                          for s in sets], pa.list_(pa.int32())),
                pa.array(cores, pa.float64()),
            ], ["doc_id", "txt", "n", "cls", "grp", "prefix", "spread", "core"])

    return texts.mapInArrow(prefixes, "doc_id long, txt long, n long, cls binary, grp long, prefix array<long>, "
                            "spread array<int>, core double")


def class_sets(texts: DataFrame, size: int) -> DataFrame:
    """cls and the whole set (array of hashes) of each text with words."""
    def sets_of(batches):
        for _, sets in _texts(batches, size):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_signature(s) for s in sets], pa.binary()), _lists(sets, pa.int64())], ["cls", "hashes"])

    return texts.select("text").mapInArrow(sets_of, "cls binary, hashes array<long>")


def _sizes_fit(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are alike.

    What two sets can share is at most the sum of the lesser counts over the ranges
    of the hash, which rules out most pairs.  The sets of the rest are made again from
    one text of each class.
    """
    seen = stored(pairs.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "set-candidates").table
    left = classes.select(F.col("cls").alias("a"), F.col("n").alias("m"), F.col("spread").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("k"), F.col("spread").alias("y"))
    most = F.aggregate(F.zip_with("x", "y", lambda c, d: F.least(c, d)), F.lit(0), lambda total, c: total + c)
    held = stored(seen.join(left, "a").join(right, "b").filter(
        (100 + percent) * most >= percent * (F.col("m") + F.col("k"))).select("a", "b"), "set-pairs")
    ends = held.table.select(F.col("a").alias("cls")).union(held.table.select("b")).distinct()
    wanted = measured(ends.join(classes.select("cls", "doc_id"), "cls"), "wanted-sets")
    ids = lookup(wanted).select("doc_id").distinct()
    ids = F.broadcast(ids) if wanted.measures["bytes"] <= (1 << 24) else ids
    there = texts.join(ids, same(texts, ids, "doc_id"), "left_semi")
    sets = stored(class_sets(there, size).join(lookup(wanted).select("cls"), "cls", "left_semi")
                  .dropDuplicates(["cls"]), "sets").table
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("y"))
    both = held.table.join(left, "a").join(right, "b").withColumn(
        "shared", F.size(F.array_intersect("x", "y")))
    return both.filter(100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared"))
                       ).select("a", "b")


def shared_prefixes(named: DataFrame) -> DataFrame:
    """grp, token, n, pos, core: the prefix shingles that several groups have.

    Rare shingles come first, so most of a prefix is in one group only and joins
    nothing.  What is left is a small part of all prefixes, so that only
    (shingle, group) pairs are shuffled whole, combined in the map tasks.
    """
    every = named.select("grp", "n", "core", F.posexplode("prefix").alias("pos", "token"))
    several = measured(every.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
                       .filter("lo < hi").select("token"), "shared-shingles")
    return every.join(lookup(several, SHINGLE_BYTES), "token", "left_semi").groupBy("grp", "token").agg(
        F.min("n").alias("n"), F.min("pos").alias("pos"), F.max("core").alias("core"))


def _pivot_pairs(classes: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """Each class with its group's lead; each group with pivots of its prefix shingles.

    The lead of a group and the pivot of a shingle are those of highest core: copies that
    were edited apart are often like their common origin only.  A group
    meets the pivots of its rarest shingles and the one of highest core among all its pivots.
    """
    top = F.struct("core", "cls")
    first = classes.groupBy("grp").agg(F.max(top).alias("top")).select("grp", F.col("top.cls").alias("lead"))
    within = classes.join(first, "grp").filter("cls != lead").select(
        F.col("lead").alias("a"), F.col("cls").alias("b"))
    pivots = index.groupBy("token").agg(
        F.max(F.struct("core", F.col("grp").alias("pivot"), F.col("n").alias("m"))).alias("best"))
    met = index.join(pivots, "token").filter(
        (F.col("grp") != F.col("best.pivot")) & _sizes_fit("n", "best.m", percent)).groupBy("grp").agg(
        F.max("best").alias("best"),
        F.collect_set(F.when(F.col("pos") < PIVOT_SHINGLES, F.col("best.pivot"))).alias("near"))
    across = met.select("grp", F.explode(F.array_union("near", F.array("best.pivot"))).alias("pivot"))
    return within.union(
        across.join(first, "grp").withColumnRenamed("lead", "b")
        .join(first.select(F.col("grp").alias("pivot"), F.col("lead").alias("a")), "pivot").select("a", "b"))


def _cross_pairs(classes: DataFrame, index: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a prefix shingle or a group."""
    placed = classes.join(parts.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
        "cls", "grp", F.coalesce("component", "cls").alias("part"))
    spans = placed.groupBy("grp").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    split = placed.join(spans.filter("lo < hi").select("grp"), "grp", "left_semi")
    x, y = split.alias("x"), split.alias("y")
    inside = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.part") < F.col("y.part"))).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    reach = index.join(spans, "grp")
    live = reach.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h"),
                                      F.count(F.lit(1)).alias("k")).filter("k > 1 AND l < h").select("token")
    near = stored(reach.join(live, "token", "left_semi"), "live-shingles").table
    x, y = near.alias("x"), near.alias("y")
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    groups = x.join(
        y, (F.col("x.token") == F.col("y.token")) & (F.col("x.grp") < F.col("y.grp"))
        & _sizes_fit("x.n", "y.n", percent)
        # All that may be shared from this shingle on must make up the least overlap.
        & ((100 + percent) * rest >= percent * (F.col("x.n") + F.col("y.n")))
        & ~((F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi"))
            & (F.col("x.lo") == F.col("y.lo")))
    ).select(F.col("x.grp").alias("g"), F.col("y.grp").alias("h")).distinct()
    members = placed.alias("m")
    others = placed.alias("o")
    expanded = groups.join(members, F.col("g") == F.col("m.grp")).join(
        others, (F.col("h") == F.col("o.grp")) & (F.col("m.part") != F.col("o.part"))).select(
        F.col("m.cls").alias("a"), F.col("o.cls").alias("b"))
    return inside.union(expanded)


def _named_parts(named: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """cls, part, least (doc_id of the part) of all classes."""
    classes = stored(named.groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.min("grp").alias("grp"), F.min("n").alias("n"),
        F.first("spread").alias("spread"), F.min("core").alias("core")), "classes").table
    index = settled(lambda: shared_prefixes(named), "prefixes").table
    near = settled(lambda: verified(_pivot_pairs(classes, index, percent), classes, texts, size, percent), "pivots")
    parts = settled(lambda: connected_components(near.table, "a", "b"), "near-parts").table
    rest = settled(lambda: verified(_cross_pairs(classes, index, parts, percent), classes, texts, size, percent), "cross")
    if rest.rows:
        parts = connected_components(near.table.union(rest.table), "a", "b")
    joined = classes.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "part", F.coalesce("component", "cls"))
    least = joined.groupBy("part").agg(F.min("doc_id").alias("least"))
    return joined.join(least, "part").select("cls", "part", "least")


def ngram_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, txt (the text's hash), n_shingles, part (the component), component_id of every row.

    Two texts link when 100 * shared >= percent * union of their sets of word
    ``size``-grams (A-Z lower-cased); component_id is the least doc_id reachable by
    links, null doc_ids aside.  A text of fewer words is one shingle; a null or
    empty text, or one without words, has none and links with nothing, so its
    component is its own doc_id.  Rows may repeat doc_ids and texts: each row is
    answered by its own text.  An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole("text")).alias("txt"),
                        whole("text").cast("binary").alias("text"))
    rows = stored(document_sets(texts, size, percent), "doc-sets").table
    answer = settled(lambda: _named_parts(rows.filter("cls IS NOT NULL"), texts, size, percent), "parts").table
    return rows.join(answer, "cls", "left").select(
        "doc_id", "txt", F.col("n").alias("n_shingles"), "part",
        F.coalesce("least", "doc_id").alias("component_id"))
