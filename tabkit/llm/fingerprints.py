"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A document is the multiset of its paragraphs (the parts between newlines).
Every paragraph is hashed to a wide vector, and a document's vector is the sum
of its paragraphs' vectors, lane by lane modulo 2^32:

* ``EXACT`` lanes hashed from the whole paragraph: equal multisets have equal
  lanes whatever the order.  All lanes of a paragraph follow from its one
  64-bit hash, so two given paragraphs have equal lanes in about 2^-64 of cases;
* ``SKETCH`` lanes that hold, for each word pair of the paragraph, a plus or
  minus one in the lane that the pair's hash names.  They are a linear sketch
  of the word pairs, whose cosine estimates how alike two documents are
  (standard error about 0.09).

Inserting a paragraph adds its vector and deleting one subtracts it.  The query
uses this for edited texts: paragraphs before the edit are hashed once, the old
and the new rest are hashed apart, and both fingerprints are sums of two of the
three parts (``KEPT`` + ``OLD``, ``KEPT`` + ``NEW``).

A lane's sum is one group of an aggregate with two sums (a sum per lane in one
wide aggregate is too large a method for the JVM to compile).

Successors by id need no window over the whole table: rows are cut into ranges
of the id at approximate quantiles, each range is ordered by itself, and the
first row of each range also visits the range before it.  Texts are shuffled
once; the sums of a document are made where its text lies, without a further
shuffle, because its range is part of the grouping.  Ranges hold about
``RANGE_ROWS`` rows, so a hot source or group of copies is spread.

Results for odd input: a null text is an empty one, which has one empty
paragraph; null ids come after all others; rows that tie in id are ordered by
a hash of the text, and equal rows are interchangeable; an only row follows
itself; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.functions.prefix import BUCKET, add_buckets
from tabkit.llm.common import col

EXACT = 8
SKETCH = 128
RANGE_ROWS = 1024
MAX_RANGES = 16_384
KEPT, OLD, NEW = 0, 1, 2

_MASK = 0xFFFFFFFF


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def lane_values(rows: DataFrame, keys: list[str], paragraph: str = "paragraph") -> DataFrame:
    """``keys``, ``lane`` and ``value``: what each paragraph adds to the lanes.
    A null paragraph adds a zero to every lane, so that each lane is there."""
    text, words = F.col(paragraph), F.col("_words")
    # a column of its own: inside the lambda it would be split again for each pair
    rows = rows.select(*keys, paragraph, F.split(text, " ", -1).alias("_words"))
    pairs = F.greatest(F.size(words) - 1, F.lit(1))
    hashes = F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    exact = F.array(*(F.xxhash64(text, F.lit(j)).bitwiseAND(F.lit(_MASK)) for j in range(EXACT)))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), SKETCH + EXACT)
    unit = rows.select(*keys, F.when(text.isNull(), -1).otherwise(pairs).alias("_pairs"),
                       F.posexplode(F.when(text.isNull(), zeros).otherwise(F.concat(hashes, exact))).alias("_at", "_h"))
    sketched, seed = F.col("_at") < F.col("_pairs"), F.col("_pairs") < 0
    sign = 1 - 2 * F.shiftrightunsigned("_h", 40).bitwiseAND(F.lit(1))
    return unit.select(*keys, F.when(seed, F.col("_at")).when(sketched, F.pmod(F.col("_h"), F.lit(SKETCH)).cast("int"))
                       .otherwise(SKETCH + F.col("_at") - F.col("_pairs")).alias("lane"),
                       F.when(sketched, sign).otherwise(F.col("_h")).alias("value"))


def vectors(pieces: DataFrame, keys: list[str], wanted: dict[str, tuple[int, ...]]) -> DataFrame:
    """Per ``keys`` and name in ``wanted``: the vector of the paragraphs in the
    named parts, as a struct of ``exact`` and ``sketch``.  ``pieces``: keys,
    ``part`` and ``paragraph``, with one null paragraph per ``keys``."""
    sums = lane_values(pieces, [*keys, "part"]).groupBy(*keys, "lane").agg(*(
        F.coalesce(F.sum(F.when(F.col("part").isin(*parts), F.col("value"))), F.lit(0)).alias(name)
        for name, parts in wanted.items()))
    lanes = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lane", *wanted))).alias("_lanes"))

    def vector(name: str) -> Column:
        values = F.transform("_lanes", lambda x: x[name])
        return F.struct(F.transform(F.slice(values, SKETCH + 1, EXACT), lambda x: x.bitwiseAND(F.lit(_MASK))).alias("exact"),
                        F.slice(values, 1, SKETCH).alias("sketch"))

    return lanes.select(*keys, *(vector(name).alias(name) for name in wanted))


def as_text(vector: Column) -> Column:
    """The fingerprint as hexadecimal text: exact lanes, then the sketch."""
    pad = lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(_MASK))), 8, "0")
    return F.concat(F.array_join(F.transform(vector["exact"], pad), ""), F.lit(":"),
                    F.array_join(F.transform(vector["sketch"], pad), ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal multisets; else the cosine that the sketches give, from 0
    to 1."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x["sketch"], y["sketch"], lambda p, q: p.cast("double") * q.cast("double")),
                           F.lit(0.0), lambda t, v: t + v)

    norm = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / norm))).otherwise(0.0)
    return F.when(a["exact"] == b["exact"], 1.0).otherwise(cosine)


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (empty for null), ``next_text`` and the place of
    the row: ``range`` and ``rank`` in it; ``next_range`` is another range
    where the next row is that range's first."""
    docs = df.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    n = max(1, min(MAX_RANGES, math.ceil(docs.select("doc_id").count() / RANGE_ROWS)))
    ranged, (bucket,) = add_buckets(docs, ["doc_id"], n)
    assert bucket == f"{BUCKET}0"
    ranged = ranged.withColumn("range", F.coalesce(F.col(bucket).cast("int"), F.lit(MAX_RANGES))).drop(bucket)
    # first id of each range, and the range before: one row per range
    heads = sorted(ranged.groupBy("range").agg(F.min("doc_id").alias("head")).collect(), key=lambda r: r.range)
    guards = [(r.range, r["head"], heads[k - 1].range) for k, r in enumerate(heads)]
    guard = df.sparkSession.createDataFrame(guards, "range int, head bigint, visits int")
    same = (F.col("d.range") == F.col("g.range")) & F.col("d.doc_id").eqNullSafe(F.col("g.head"))
    placed = (ranged.alias("d").join(F.broadcast(guard).alias("g"), same, "left")
              .select("d.doc_id", "d.text", F.col("d.range").alias("home"), "g.visits",
                      F.xxhash64("d.text").alias("tie")))
    own = F.struct(F.col("home").alias("range"), F.lit(False).alias("visitor"))
    rows = placed.withColumn("at", F.explode(F.when(F.col("visits").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.col("visits").alias("range"), F.lit(True).alias("visitor"))))))
    rows = rows.select("doc_id", "text", "home", "tie", F.col("at.range").alias("range"), F.col("at.visitor").alias("visitor"))
    order = Window.partitionBy("range").orderBy("visitor", F.col("doc_id").asc_nulls_last(), "tie")
    after = F.lead(F.struct("text", "home", "visitor")).over(order)
    return (rows.withColumn("rank", F.row_number().over(order)).withColumn("after", after).where("not visitor")
            .select("doc_id", "text", "range", "rank", F.col("after.text").alias("next_text"),
                    F.when(F.col("after.visitor"), F.col("after.home")).alias("next_range")))


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form: the last quarter of
    the characters replaced by as many first ones of the next text.

    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.
    """
    rows = with_next(df, doc_id, text).withColumn("n_chars", F.length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    stay = (F.col("n_chars") - quarter).cast("int")
    rows = rows.withColumn("stays", F.substring("text", F.lit(1), stay)) \
        .withColumn("edited", F.concat("stays", F.substring("next_text", F.lit(1), quarter)))
    # whole paragraphs before the edit, with the newline that ends the last one
    whole = (F.length("stays") - F.length(F.substring_index("stays", "\n", -1))).cast("int")
    rows = rows.withColumn("whole", whole)
    rest = F.col("whole") + 1
    long = F.lit(2147483647)
    tagged = lambda part, array: F.transform(array, lambda p: F.struct(F.lit(part).alias("part"), p.alias("paragraph")))
    seed = F.array(F.lit(None).cast("string"))
    before = F.when(F.col("whole") > 0, paragraphs(F.substring("text", F.lit(1), F.col("whole") - 1))).otherwise(
        F.array().cast("array<string>"))
    parts = F.concat(tagged(KEPT, seed), tagged(KEPT, before), tagged(OLD, paragraphs(F.substring("text", rest, long))),
                     tagged(NEW, paragraphs(F.substring("edited", rest, long))))
    keys = ["range", "rank", "doc_id", "n_chars", "edited_sha256", "next_range"]
    pieces = (rows.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keys, F.explode(parts).alias("p"))
              .select(*keys, "p.part", "p.paragraph"))
    found = materialize(vectors(pieces, keys, {"now": (KEPT, OLD), "then": (KEPT, NEW)}))
    heads = found.where("rank = 1").select(F.col("range").alias("next_range"), F.col("now").alias("head"))
    follows = F.lead("now").over(Window.partitionBy("range").orderBy("rank"))
    # one row per range: MAX_RANGES rows and the one of null ids at most
    met = found.withColumn("follows", follows).join(F.broadcast(heads), "next_range", "left")
    other = F.when(F.col("next_range").isNotNull(), F.col("head")).otherwise(F.col("follows"))
    return met.withColumn("after", other).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("now")).alias("fingerprint"),
        as_text(F.col("then")).alias("edited_fingerprint"),
        likeness(F.col("now"), F.col("then")).alias("near_edited"), likeness(F.col("now"), F.col("after")).alias("near_next"))


def fingerprints(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and the ``fingerprint`` of the text of each row (rows that
    share all keys are added up)."""
    pieces = F.concat(F.array(F.lit(None).cast("string")), paragraphs(F.coalesce(col(text), F.lit(""))))
    rows = df.select(*map(col, keys), F.lit(KEPT).alias("part"), F.explode(pieces).alias("paragraph"))
    return vectors(rows, keys, {"v": (KEPT,)}).select(*keys, as_text(F.col("v")).alias("fingerprint"))
