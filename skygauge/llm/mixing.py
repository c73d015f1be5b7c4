"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target of words.  Whole epochs come first: every document is
taken floor(target / source size) times.  What is left is filled without
replacement: documents get the key -ln(u) / weight, u a hash of the document and
weight its quality, and the least keys are taken until their sizes reach the rest.

The order within a source is not made in one task: keys fall into slices of about
``SLICE_ROWS`` documents, slices are summed, and only the slice in which a source's
budget ends is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skygauge.llm.common import GAP, lookup, measured, stored, whole

#: Documents of a source that are sorted in one task, about.
SLICE_ROWS = 20_000
#: Least and largest quality weight; their ratio bounds how uneven slices are.
LEAST_WEIGHT, MOST_WEIGHT = 0.25, 1.0
#: Passes over the slice in which a budget ends, to fill it up.
FILL_PASSES = 4
#: Times that a document may be taken.
MOST_EPOCHS = 3


def n_words(text: Column) -> Column:
    """Words of a text: runs of other characters than space and tab to carriage return."""
    return F.size(F.array_remove(F.split(whole(text), GAP), "")).cast("long")


def quality_weight(text: Column) -> Column:
    """Weight of a document: less the more of its text is symbols."""
    symbols = F.length(F.regexp_replace(whole(text), r"[^#*$%&|<>]+", ""))
    share = symbols / F.greatest(F.length(whole(text)), F.lit(1))
    return F.greatest(F.lit(LEAST_WEIGHT), F.lit(MOST_WEIGHT) - 5 * share)


def source_targets(sizes: DataFrame, cap: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target: weights 1, 2, 3, 1, ... by code point, null last.

    ``sizes`` has one row for each source (source, source_size).  Targets share the
    sum of all sizes by weight.  A target stops at ``cap`` times its source's size
    and the excess is shared again: sources are filled in order of cap by weight,
    and each takes its weight's part of what the ones before it left.
    """
    everything = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighted = sizes.withColumn("weight", 1 + (F.row_number().over(everything) - 1) % 3).withColumn(
        "most", F.lit(cap) * F.col("source_size"))
    filling = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.partitionBy())
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levelled = weighted.withColumn("level", level).withColumn("capped", F.col("most") < F.col("level") * F.col("weight"))
    # The first source that is not capped settles the level of all after it.
    settled = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        filling.rowsBetween(W.unboundedPreceding, 0))
    return levelled.withColumn("settled", settled).select(
        "source", "source_size",
        F.coalesce(F.least(F.col("settled") * F.col("weight"), F.col("most").cast("double")),
                   F.col("most").cast("double")).alias("target"))


def draw(digest: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, txt, source, size, source_size, target, epochs, extra of every row.

    ``digest``: stored rows of doc_id, txt (hash of the text), source, size, weight.
    A document is taken ``epochs`` times, and once more where ``extra``: in order of
    key up to the budget, then, in a few passes, what still fits beside it.
    """
    sizes = stored(digest.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "source-sizes").table
    targets = source_targets(sizes.select("source", "source_size"))
    plan = measured(targets.join(sizes.select(F.col("source").alias("s"), "docs"),
                                 F.col("source").eqNullSafe(F.col("s"))).drop("s").select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12))
        .otherwise(0).cast("long").alias("epochs"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / SLICE_ROWS)).cast("long").alias("slices"),
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    table = lookup(plan).withColumnRenamed("source", "s")
    uniform = (F.pmod(F.xxhash64("doc_id", "txt", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = digest.join(table, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "key", -F.log(uniform) / F.col("weight")).withColumn(
        # Uniform for the least weight, and at most their ratio denser for the largest.
        "slice", F.floor(F.col("slices") * (1 - F.exp(-F.lit(LEAST_WEIGHT) * F.col("key")))))
    sums = keyed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy("slice")
    spans = measured(sums.select("source", "slice", "words", F.sum("words").over(upto).alias("after")), "slices")
    at = lookup(spans).select(F.col("source").alias("s"), F.col("slice").alias("k"),
                              (F.col("after") - F.col("words")).alias("before"), "after")
    placed = keyed.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("k"))).drop("s", "k")
    columns = ["doc_id", "txt", "source", "size", "source_size", "target", "epochs"]
    sure = placed.filter((F.col("after") <= F.col("budget")) | (F.col("before") >= F.col("budget"))).select(
        *columns, (F.col("after") <= F.col("budget")).alias("extra"))
    order = W.partitionBy("source").orderBy("key", "doc_id", "txt").rowsBetween(W.unboundedPreceding, 0)
    edge = placed.filter((F.col("after") > F.col("budget")) & (F.col("before") < F.col("budget"))).withColumn(
        "extra", F.lit(False)).withColumn("room", F.col("budget") - F.col("before"))
    for _ in range(FILL_PASSES):
        fits = F.when(~F.col("extra") & (F.col("size") <= F.col("room")), F.col("size"))
        edge = edge.withColumn("upto", F.sum(fits).over(order)).withColumn(
            "now", fits.isNotNull() & (F.col("upto") <= F.col("room"))).withColumn(
            "room", F.col("room") - F.coalesce(F.sum(F.when(F.col("now"), F.col("size"))).over(
                W.partitionBy("source")), F.lit(0))).withColumn("extra", F.col("extra") | F.col("now"))
    edge = edge.select(*columns, "extra")
    return sure.union(edge)


def mix(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, txt, size, source_size, target, epochs, extra, taken of every row.

    A null text has no words and a null source is a source of its own, the last.
    Documents without words are never taken to fill a target but cost nothing:
    taken is 0.  Rows that repeat doc_id and text get one key and are taken in turn.
    No document is taken more than three times; an empty table gives no rows.
    """
    digest = stored(docs.select(
        "doc_id", F.xxhash64(whole("text")).alias("txt"), "source", n_words(F.col("text")).alias("size"),
        quality_weight(F.col("text")).alias("weight")), "sizes").table
    return draw(digest, seed).withColumn(
        "taken", F.col("size") * (F.col("epochs") + F.col("extra").cast("long")))
