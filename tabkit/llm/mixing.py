"""Mixing sources to target weights by systematic sampling.

Targets.  A mix of ``share`` times all sizes is divided among the sources by
weight; no source gets more than ``cap`` times its own size, and what it
cannot take is divided again among the others.  The level at which this
settles is found exactly, in integers, from running sums over the sources in
the order in which they fill up.

Copies.  Within a source every document expects ``target / source size``
copies.  The documents stand in a fixed order, their expected copies are summed
up, one seeded offset per source is added, and a document is emitted once per
integer boundary that its part of the running sum crosses.  So no document is
emitted more than ``ceil(cap)`` times, and a source's emitted documents differ
from its expectation by less than one.  The order goes by size class (a
sixteenth of an octave), so that the sample takes its share of every size and
the emitted words come near the target too.

Spark work.  Ranks inside a source never need the source in one task: rows
fall into cells (source, size class, one of ``SPREAD`` hashes of the id), one
aggregate counts the cells, running sums over the counts of the cells (at most
``SPREAD`` times the size classes for one source, however many rows it has)
give each cell its start, and rows are ranked inside their cell.  A source with
a third of all rows is spread over all its cells.  Only one row per source
passes through the single task that divides the targets.

Results for odd input: a null source is a source of its own, after all others;
a null or empty text has size 0 and takes part like any document; rows that
tie in id and size are ordered by their other columns, and equal rows are
interchangeable; an empty table gives an empty table; an output name of
``systematic_copies`` that clashes with a column is an error, ``mix`` takes any
columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.llm.common import WORD, check_free, col, packed, unpacked

#: Hash cells per source and size class.
SPREAD = 1024


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _uniform(text: Column, seed: int) -> Column:
    """32 bits of md5, as a whole number."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(f"-{seed}"))), 1, 8), 16, 10).cast("bigint")


def _size_class(size: Column) -> Column:
    """Whole-number class, rising with the size: the leading bit's place and
    the four bits after it."""
    places = F.length(F.bin(size)) - 1
    return F.when(size < 16, size).otherwise(
        places * 16 + F.call_function("shiftright", size, places - 4).bitwiseAND(F.lit(15))).cast("int")


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], cap: int) -> DataFrame:
    """``sources`` (key, source_size) with ``weight`` and ``target``.

    Sources in order of their key weigh ``weights``, repeating.  ``share`` is
    a fraction (numerator, denominator).  Whole numbers throughout, so source
    order and ties cannot change the result.
    """
    whole, step = "decimal(38,0)", math.lcm(*weights)
    top, bottom = share
    index = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    by_level = Window.orderBy("level")  # equal levels count together
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (index + 1).cast("int")))
             .withColumn("limit", F.col("source_size") * cap)
             .withColumn("level", F.col("limit") * (F.lit(step) / F.col("weight")).cast("bigint"))
             .withColumn("limits_up_to", F.sum("limit").over(by_level).cast(whole))
             .withColumn("weights_up_to", F.sum("weight").over(by_level).cast(whole))
             .withColumn("all_weights", F.sum("weight").over(everything).cast(whole))
             .withColumn("mix", (F.sum("source_size").over(everything) * top).cast(whole)))
    full = level.withColumn("full", (F.col("limits_up_to") * F.col("weight") + F.col("limit").cast(whole)
                                     * (F.col("all_weights") - F.col("weights_up_to"))) * bottom
                            <= F.col("mix") * F.col("weight"))
    rest = (full.withColumn("left", F.col("mix") - bottom * F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything))
            .withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)))
    open_target = F.col("left").cast("double") * F.col("weight").cast("double") / (F.col("open") * bottom).cast("double")
    return rest.select("key", "source_size", "weight",
                       F.when(F.col("full"), F.col("limit").cast("double")).otherwise(open_target).alias("target"))


def systematic_copies(df: DataFrame, size: str, source: str = "source", doc_id: str = "doc_id",
                      weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), cap: int = 2,
                      seed: int = 42) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``copies``: how often each
    row is in the mix.  ``size`` names a whole-number column."""
    check_free(df, "source_size", "target", "copies", "_key", "_class", "_cell", "_tie", "_start", "_ratio", "_offset")
    cell = ["_key", "_class", "_cell"]
    placed = (df.withColumn("_key", F.coalesce(F.concat(F.lit("0"), col(source).cast("string")), F.lit("1")))
              .withColumn("_class", _size_class(col(size)))
              .withColumn("_cell", (_uniform(F.coalesce(col(doc_id).cast("string"), F.lit("")), seed) % SPREAD).cast("int")))
    cells = materialize(placed.groupBy(*cell).agg(F.count("*").alias("n"), F.sum(col(size)).alias("s")))
    sources = cells.groupBy(F.col("_key").alias("key")).agg(F.sum("s").alias("source_size"))
    plan = targets(sources, weights, share, cap).withColumnRenamed("key", "_key")
    before = Window.partitionBy("_key").orderBy("_class", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
              .join(plan, "_key")
              .select(*cell, "_start", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double"))
                      .otherwise(0.0).alias("_ratio"),
                      (_uniform(F.col("_key"), seed) / F.lit(4294967296.0)).alias("_offset")))
    in_cell = Window.partitionBy(*cell).orderBy(col(doc_id), col(size), "_tie")
    place = F.col("_start") + F.col("_rank")
    crossed = lambda k: F.floor(F.col("_offset") + F.col("_ratio") * k.cast("double"))
    return (placed.withColumn("_tie", F.xxhash64(*(col(c) for c in df.columns)))
            .withColumn("_rank", F.row_number().over(in_cell))
            .join(starts, cell)
            .withColumn("copies", (crossed(place) - crossed(place - 1)).cast("bigint"))
            .select(*(col(c) for c in df.columns), "source_size", "target", "copies"))


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken."""
    rows = packed(df, source=col(source), doc_id=col(doc_id), size=word_count(text))
    planned = systematic_copies(rows, "size", **options)
    taken = planned.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return unpacked(taken, df.columns)
