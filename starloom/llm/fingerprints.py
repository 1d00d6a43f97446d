"""Threshold-scaled document sketches.

A text's sketch holds every hash of its shingles (five words; a shorter text is one shingle)
below a fixed fraction of the hash range, and its smallest hash, so that no text with a word has
an empty sketch.  What is kept does not depend on the text's length or on other texts: the
sketch of a union is the (re-thresholded) union of sketches, and the share of the smaller sketch
found in the larger estimates containment also between very unequal documents.

Only DataFrame operations.  Neighbours in the order of ids are found by a window per range of
ids; the first document of a range is also placed, as a ghost, at the end of the range before it
in that order, so that no window spans the table.

Defined cases: null text counts as empty; a text without a word has the empty sketch; likeness
of two empty sketches is 1, of an empty and another one 0; equal ids follow each other in the
order of their text's hash; a row without an id comes after all others; after the last document
comes the first (a single one is its own next); an empty table gives no rows; other columns are
ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: Words of a shingle, and the fraction of hashes kept: one in so many.
WORDS, RATE = 5, 4

_SPACE = " \t\n\x0b\f\r"
#: Hashes of shingles have this many bits.
_BITS = 31
_NO_ID = -(1 << 63)


def _threshold(rate: int) -> int:
    return (1 << _BITS) // rate


def with_sketch(df: DataFrame, text: str, out: str, rate: int = RATE) -> DataFrame:
    """``df`` with the sketch of ``text`` as ``out`` (ascending array<int>).

    Each array is a projection of its own, used more than once by the next one: it is made
    once a row, not once an element."""
    keep = df.columns
    words = F.split(F.btrim(F.col(text), F.lit(_SPACE)), "[\\x20\\x09-\\x0D]+")
    df = df.withColumn("__words", words)
    df = df.select(*keep, F.when(F.element_at("__words", 1) == "", F.array().cast("array<bigint>"))
                   .otherwise(F.transform("__words", lambda w: F.xxhash64(w))).alias("__words"))
    w, n = F.col("__words"), F.size("__words")

    def shingle(i: Column) -> Column:
        return _hash(F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)]))

    df = df.select(*keep, F.when(n >= WORDS, F.transform(F.sequence(F.lit(0), n - WORDS), shingle))
                   .when(n > 0, F.array(_hash(F.xxhash64(w))))
                   .otherwise(F.array().cast("array<int>")).alias("__shingles"))
    return df.select(*keep, _thresholded(F.col("__shingles"), rate).alias(out))


def _hash(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - _BITS).cast("int")


def _thresholded(hashes: Column, rate: int) -> Column:
    low = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < _threshold(rate))))
    return F.when((F.size(hashes) > 0) & (F.array_min(hashes) >= _threshold(rate)), F.array(F.array_min(hashes))).otherwise(low)


def merged(a: Column, b: Column, rate: int = RATE) -> Column:
    """The sketch of two texts' shingles together."""
    return _thresholded(F.concat(a, b), rate)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller one's shingles that the other one has too."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least) \
        .otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def as_string(sketch: Column) -> Column:
    return F.array_join(sketch.cast("array<string>"), ",")


def with_next(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``docs`` (with doc_id and ``carry``) with the ``carry`` columns of the next document in
    descending order of ids as next_<column>."""
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("__id"))
    ranges = 2 * shuffle_partitions(spark)
    # At most one id per range: existing ids, the largest among them.
    bounds = ids.agg(F.percentile_approx("__id", [i / ranges for i in range(1, ranges)], F.lit(20 * ranges)).alias("b"),
                     F.max("__id").alias("m")).first()
    bounds = sorted({*(bounds["b"] or []), bounds["m"]} - {None})
    if not bounds:
        bounds = [0]
    m, ends = len(bounds), F.array(*[F.lit(b) for b in bounds])
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    ranged = docs.withColumn("__id", at).withColumn("__range", F.size(F.filter(ends, lambda b: b < F.col("__id"))))
    # The range before it in descending order is the next higher one; the highest id of all
    # follows the lowest range.
    ghost_in = F.pmod(F.col("__range") + 1, F.lit(m))
    places = F.when(F.array_contains(ends, F.col("__id")), F.array(
        F.struct(F.col("__range").alias("r"), F.lit(0).alias("g")), F.struct(ghost_in.alias("r"), F.lit(1).alias("g")))) \
        .otherwise(F.array(F.struct(F.col("__range").alias("r"), F.lit(0).alias("g"))))
    placed = ranged.withColumn("__place", F.explode(places)) \
        .withColumns({"__range": F.col("__place.r"), "__ghost": F.col("__place.g")}).drop("__place")
    order = Window.partitionBy("__range").orderBy("__ghost", F.col("__id").desc(), F.xxhash64("text"))
    return placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carry}) \
        .where(F.col("__ghost") == 0).drop("__range", "__ghost", "__id")


def report(docs: DataFrame, rate: int = RATE) -> DataFrame:
    """Fingerprints of every text and of its edit: the last third of its code points replaced
    by the first as many of the next document, with the likeness to it and to that document."""
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = with_sketch(base, "text", "sketch", rate)
    pairs = with_next(own, ["text", "sketch"])
    n = F.char_length("text").cast("int")
    third = F.floor(n / 3).cast("int")
    edited = pairs.select("doc_id", "sketch", "next_sketch", n.cast("long").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = with_sketch(edited, "edited", "edited_sketch", rate)
    return both.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
