"""Line deduplication with levelled sorted runs of line hashes.

An index of the line keys seen so far is kept as sorted runs of (128-bit key hash, first
document).  Documents come in batches in the order of their ids; each batch reduces its lines to
distinct keys, merge-anti-joins them with the runs, and adds those that are new as a run of its
own.  When a level holds ``FANOUT`` runs they are merged into one run of the next level.  As
batches go by ascending id, the first holder of a key is its smallest doc_id.

A line's key is the line without white space (space and U+0009 to U+000D) at both ends, A-Z in
lower case.  Keys of at least ``MIN_KEY`` code points lose their lines in every document but
the first holder; all other lines stay as they are.

Only DataFrame operations.  A very common line is reduced before the shuffle (``min`` per key)
and only meets its index entry in a join, which adaptive execution splits.

Defined cases: null or empty text is one empty line; a document keeps repeats of its own
lines; rows with one id are one document; a row without an id is never a first holder and
comes last; a document may end empty; repeated rows get equal results; an empty table gives no
rows; other columns are carried along or ignored.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Code points of the shortest key that counts.
MIN_KEY = 10
#: Batches of a whole table, and runs of a level before they are merged.
BATCHES, FANOUT = 4, 2

_SPACE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["__k1", "__k2"]


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(_SPACE))
    # For ASCII text the (faster) Unicode lower case is the same.
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(stripped)) \
        .otherwise(F.translate(stripped, _UPPER, _UPPER.lower()))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, text hash, line number and key hashes of every line that counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64(text).alias("__row"),
                        F.posexplode(F.split(text, "\n", -1)).alias("__line", "__text"))
    keyed = lines.select("__doc", "__row", "__line", line_key(F.col("__text")).alias("__key"))
    return keyed.where(F.char_length("__key") >= MIN_KEY).select(
        "__doc", "__row", "__line", F.xxhash64("__key").alias("__k1"),
        F.xxhash64(F.lit("second"), F.col("__key")).alias("__k2"))


@dataclass
class LineIndex:
    """Levels of sorted runs: (key hashes, first document)."""
    levels: list[list[DataFrame]] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (of later documents than all before); return its lines that an
        earlier document, or an earlier one of the batch, holds."""
        new = lines.groupBy(*_KEY).agg(F.min("__doc").alias("__first"))
        for run in self.runs():
            new = new.join(run.select(*_KEY).hint("merge"), _KEY, "left_anti")
        self._push(0, new)
        drops = [lines.join(run.hint("merge"), _KEY)
                 .where(F.col("__first").isNotNull() & (F.col("__doc").isNull() | (F.col("__doc") > F.col("__first"))))
                 .select("__doc", "__row", "__line") for run in self.runs()]
        out = drops[0]
        for d in drops[1:]:
            out = out.unionByName(d)
        return out

    def _push(self, level: int, keys: DataFrame) -> None:
        run = stage(keys.repartition(*_KEY).sortWithinPartitions(*_KEY), f"line-run-{level}")
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FANOUT:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(level + 1, merged)


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(__doc, __row, __drops: line numbers) of the documents that lose lines."""
    bounds = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)]).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    batch = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        batch = F.when(F.col("__doc") <= F.lit(bounds[i]), F.lit(i)).otherwise(batch)
    lines = stage(lines_of(docs).withColumn("__batch", batch), "lines")
    index, found = LineIndex(), None
    for b in range(len(bounds) + 1):
        drops = index.add(lines.where(F.col("__batch") == b).drop("__batch"))
        found = drops if found is None else found.unionByName(drops)
    return found.groupBy("__doc", "__row").agg(F.collect_set("__line").alias("__drops"))


def dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with __n_lines, __n_dropped and __kept (the text that stays)."""
    drops = dropped_lines(docs, batches)
    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.withColumn("__of", F.xxhash64(text)).join(
        drops, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__of") == F.col("__row")), "left")
    # A projection of its own, so that a text is split once and not for every line.
    split = joined.withColumn("__lines", F.split(text, "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drops"))
    kept = F.when(F.col("__drops").isNull(), text) \
        .otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n"))
    return split.select(
        *[F.col(c) for c in docs.columns], F.size("__lines").cast("long").alias("__n_lines"),
        F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")).cast("long").alias("__n_dropped"), kept.alias("__kept"))


def report(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 per document."""
    done = dedup(docs.select("doc_id", "text"), batches)
    return done.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"))
