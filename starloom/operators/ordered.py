"""Operations over one global order without a one-partition window and without letting a hot
key land in a single task.

``range_layout`` range-partitions rows on a sort order (Spark samples the whole sort key, so a
value that holds a third of the rows is split across partitions by the following columns),
sorts inside each partition, tags rows with (partition id, position) and writes that layout
once.  The last column of every order is a number that was written with the rows, so even rows
alike in every column, a third of the table maybe, are split like any others.  Per-partition
facts (row count, first row) are one small aggregate whose size is bounded by the number of
partitions, not by the data.  On top of it:

* ``number_rows``   - global row numbers (dense surrogate keys): arithmetic on the position and
  the partition's offset, no further shuffle;
* ``lead_in_key``   - ``LEAD(col) OVER (PARTITION BY key ORDER BY ...)``: a window per range
  partition (so every window group is one balanced partition), plus a fix-up for the last row
  of a partition whose key continues in the next non-empty partition.

Both the numbered rows and the layout are Parquet files in ``spark.checkpoint.dir``.  The
partition ids that the offsets refer to live in those files: whatever the consumer does later -
re-running the result, losing executors - it re-reads the same rows with the same numbers, so
counts and numbering always agree.
"""
from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

PID, POS = "__sl_pid", "__sl_pos"

# A window by key keeps a key's rows in one task.  Above this many rows of one key, what goes by
# key is done on a range layout.
KEY_MAX_ROWS = 1 << 20

# A written row number: the last column of every layout's order.
TIE = "__sl_tie"

# What was persisted or written on the way to a result; released after its consumer (a publish,
# a bench run) is done.
_MATERIALIZED: list[DataFrame] = []
_WRITTEN: list[tuple] = []

# DataFrames that only read files written by a load.
_FILES: weakref.WeakSet = weakref.WeakSet()


# Highest key of facts whose load counted them.
_MAX_KEYS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def know_max_key(df: DataFrame, n: int) -> DataFrame:
    _MAX_KEYS[df] = n
    return df


def known_max_key(df: DataFrame) -> int | None:
    return _MAX_KEYS.get(df)


@dataclass
class Versions:
    """What is known of a dimension's versions from making them."""
    check_disjoint: Callable[[], bool]      # False: not known
    rows: int | None = None
    most: int | None = None                 # versions of the key with the most
    _disjoint: list = field(default_factory=list)

    @property
    def disjoint(self) -> bool:
        """Whether no two versions of a key are known to hold at one instant; looked up once."""
        if not self._disjoint:
            self._disjoint.append(self.check_disjoint())
        return self._disjoint[0]


_VERSIONS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def know_versions(dim: DataFrame, versions: Versions) -> DataFrame:
    _VERSIONS[dim] = versions
    return dim


def known_versions(dim: DataFrame) -> Versions | None:
    """Of a dimension as its load returned it, or that was ``written`` then."""
    return _VERSIONS.get(dim)


def is_files(df: DataFrame) -> bool:
    """Whether ``df`` only reads files that a load wrote, so that reading it again costs a scan."""
    return df in _FILES


def mark_files(df: DataFrame) -> DataFrame:
    _FILES.add(df)
    return df


def materialized_mark() -> tuple[int, int]:
    """What is materialised by now, for ``release_materialized(since=...)``."""
    return len(_MATERIALIZED), len(_WRITTEN)


def release_materialized(since: tuple[int, int] = (0, 0)) -> None:
    """Drop caches and written rows (those after ``since``).  DataFrames that read them must
    have been consumed."""
    while len(_MATERIALIZED) > since[0]:
        _MATERIALIZED.pop().unpersist()
    while len(_WRITTEN) > since[1]:
        fs, path = _WRITTEN.pop()
        fs.delete(path, True)


def cache_deterministic(df: DataFrame) -> DataFrame:
    """Persist a DataFrame whose *content* is deterministic (no ids, no sampling), so several
    small actions and the final job share one computation.  Releasing it is always safe: a
    re-run recomputes the same rows."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _MATERIALIZED.append(df)
    return df


def written(df: DataFrame, name: str, tie: bool = False) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.  With ``tie`` rows
    carry ``TIE``, a number of their own that is part of what was written: later passes over the
    rows, and tasks that are run again, see the same numbers.

    ``release_materialized`` deletes the folder, else the driver's end does."""
    spark = df.sparkSession
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows = df.withColumn(TIE, F.monotonically_increasing_id()) if tie else df
    rows.write.option("compression", "zstd").parquet(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(path)
    _WRITTEN.append((fs, path))
    read = mark_files(spark.read.schema(rows.schema).parquet(target))
    return know_versions(read, _VERSIONS[df]) if df in _VERSIONS else read


def most_rows(df: DataFrame, *key: str) -> int:
    """Rows of the key with the most rows (NULL is a key): one aggregate, partial per task."""
    return int(df.groupBy(*key).count().agg(F.max("count")).first()[0] or 0)


def most_rows_of(df: DataFrame, *keys: list[str]) -> list[int]:
    """``most_rows`` of several keys, in one pass."""
    columns = list(dict.fromkeys(c for key in keys for c in key))
    counts = df.groupingSets([[F.col(c) for c in key] for key in keys], *columns).agg(F.grouping_id().alias("__of"), F.count(F.lit(1)).alias("__n"))
    most = dict(counts.groupBy("__of").agg(F.max("__n")).collect())
    # grouping_id has a bit per column, the first one highest, that is set where the key lacks it
    return [int(most.get(int("".join("01"[c not in key] for c in columns), 2), 0)) for key in keys]


@dataclass
class RangeLayout:
    rows: DataFrame            # input columns + PID + POS, sorted by the order inside PID
    offsets: DataFrame         # PID, rows before this partition, next partition's first row
    first_cols: list[str]


def range_layout(df: DataFrame, order: list[Column], first_cols: list[str] | None = None,
                 num_partitions: int | None = None) -> RangeLayout:
    """Rows in ``order``.  They are written first, with ``TIE`` (unless ``df`` has that column and
    so is ``written`` already): the range partitioner's sampling pass and the shuffle itself then
    read files, and don't compute what is upstream twice."""
    df = df if TIE in df.columns else written(df, "rows", tie=True)
    order = [*order, F.col(TIE).asc()]
    # A stated number: adaptive execution would merge ranges up to its target size, and what
    # follows a layout works by range.
    num_partitions = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(num_partitions, *order)
    tagged = written(ranged.sortWithinPartitions(*order)
                     .withColumn(PID, F.spark_partition_id())
                     .withColumn(POS, F.monotonically_increasing_id()), "layout")
    first_cols = first_cols or []
    aggs = [F.count(F.lit(1)).alias("__n")]
    if first_cols:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in first_cols]), F.col(POS)).alias("__first"))
    per_part = tagged.groupBy(PID).agg(*aggs).collect()     # one row per non-empty partition
    per_part.sort(key=lambda r: r[PID])
    rows, seen = [], 0
    for i, r in enumerate(per_part):
        nxt = per_part[i + 1]["__first"] if first_cols and i + 1 < len(per_part) else None
        rows.append((r[PID], seen, *([nxt[c] if nxt is not None else None for c in first_cols])))
        seen += r["__n"]
    schema = [f"{PID} int", "__off long"]
    dtypes = dict(df.dtypes)
    schema += [f"`__nf_{c}` {dtypes[c]}" for c in first_cols]
    offsets = df.sparkSession.createDataFrame(rows, ", ".join(schema))
    return RangeLayout(tagged, offsets, first_cols)


def _row_number() -> Column:
    """1-based row number from a partition's offset and the position in it."""
    return F.col("__off") + F.col(POS) - F.shiftleft(F.col(PID).cast("long"), 33) + 1


def number_rows(layout: RangeLayout, key_col: str, start: int = 0) -> DataFrame:
    """Global 1-based row number in the layout's order, plus ``start``."""
    j = layout.rows.join(F.broadcast(layout.offsets), PID)
    return j.withColumn(key_col, F.lit(start).cast("long") + _row_number())


def lead_in_key(layout: RangeLayout, key: str, value: str, out: str, with_row_number: str | None = None) -> DataFrame:
    """``LEAD(value) OVER (PARTITION BY key ORDER BY <layout order>)`` as column ``out``.

    The layout must have been built with ``first_cols=[key, value]``.  The window runs per
    range partition (bounded, balanced groups); the last row of a partition takes the first
    row of the next non-empty partition when that row has the same key (null-safe, as SQL
    groups NULL keys together).  ``with_row_number`` also adds the global row number.
    """
    w = Window.partitionBy(PID).orderBy(POS)
    j = layout.rows.join(F.broadcast(layout.offsets), PID)
    nk, nv = F.lead(key).over(w), F.lead(value).over(w)
    has_next = F.lead(F.lit(1)).over(w).isNotNull()
    cross = F.col(f"__nf_{key}").eqNullSafe(F.col(key))
    lead = (F.when(has_next, F.when(nk.eqNullSafe(F.col(key)), nv))
             .otherwise(F.when(cross, F.col(f"__nf_{value}"))))
    res = j.withColumn(out, lead)
    return res.withColumn(with_row_number, _row_number()) if with_row_number else res


def key_offsets(counts: DataFrame, key: str, n: str, out: str) -> DataFrame:
    """(key, ``out``): rows of all keys before it, of one row per key with its number of rows ``n``."""
    layout = range_layout(counts.select(key, n, *[c for c in counts.columns if c == TIE]), [F.col(key).asc_nulls_first()])
    sums = sorted(layout.rows.groupBy(PID).agg(F.sum(n)).collect(), key=lambda r: r[PID])
    rows, seen = [], 0
    for pid, of_part in sums:
        rows.append((pid, seen))
        seen += of_part
    parts = layout.rows.sparkSession.createDataFrame(rows, f"{PID} int, __before long")
    before = Window.partitionBy(PID).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    return layout.rows.join(F.broadcast(parts), PID) \
        .select(key, (F.col("__before") + F.coalesce(F.sum(n).over(before), F.lit(0))).alias(out))


def lead_by_key(rows: DataFrame, counts: DataFrame, key: str, order: list[Column], value: str, out: str,
                with_row_number: str | None = None) -> DataFrame:
    """What ``lead_in_key`` returns, by a window per key: one shuffle of the rows, which are not
    written again.  For keys of at most ``KEY_MAX_ROWS`` rows; ``counts`` is (key, count).

    A key's row numbers begin after those of the keys before it (NULL is the first).  Those are
    joined to the windows: rows that come partitioned by key are not shuffled at all, and what goes
    on by key needs no further shuffle.  Only rows alike in every column can change places."""
    w = Window.partitionBy(key).orderBy(*order)
    if not with_row_number:
        return rows.withColumn(out, F.lead(value).over(w))
    marks = key_offsets(counts, key, "count", "__before").withColumnRenamed(key, "__mark").hint("merge")
    placed = rows.withColumns({out: F.lead(value).over(w), "__at": F.row_number().over(w)})
    return placed.join(marks, F.col(key) == F.col("__mark"), "left") \
        .withColumn(with_row_number, F.coalesce(F.col("__before"), F.lit(0).cast("long")) + F.col("__at")) \
        .drop("__mark", "__before", "__at")
