"""Surrogate-key lookups: SCD1 equality, SCD2 current and point-in-time, and the star chain.

Every lookup side is projected to (business key, surrogate key[, start, end]) before it is
joined.  Its bytes are measured first: within the bound it is broadcast and the fact is never
shuffled; beyond it the join is a shuffle join that AQE can still split for skew.

Point-in-time lookups check how many versions the hottest key has.  A fact row probes every
version of its key in a hash join, so with a key that has very many versions the lookup
switches to a bucketed plan: each version is copied into the months it overlaps, each fact
row goes to its own month, and the join is on (key, month) plus the interval.  The matches
are exactly those of the plain join (a version covering an instant overlaps that instant's
month), but a fact row only probes the versions of one month, and the hot key's rows are
spread over many join keys.

Where those copies are too many to broadcast and no two versions of a key overlap, the lookup
becomes a merge in time order (``operators.asof``): linear in versions plus facts, no copies.
"""
from __future__ import annotations

import concurrent.futures as cf
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ts_lit
from ..schemas import OPEN_END, UNKNOWN_KEY, DimSpec
from .asof import merge_as_of, versions_overlap
from . import ordered
from .ordered import TIE, cache_deterministic, is_files, known_versions, most_rows, written
from .sizing import BROADCAST_MAX_BYTES, broadcast_if_small

# Above this many versions for one key, point-in-time lookups use the month-bucketed plan.
PIT_MAX_VERSIONS_PER_KEY = 64

# From this many dimensions that the facts would be shuffled to, keys go there instead of rows.
KEYS_GO_FROM = 3

# Keys are counted in so many groups: few rows, and no key has more rows than its group.
KEY_GROUPS = 1 << 16


# Bytes of a row of a point-in-time side: key, surrogate key, start, end, bucket.
PIT_ROW_BYTES = 48


def _month_index(c):
    return (F.year(c) * 12 + F.month(c) - 1).cast(T.IntegerType())


def _day_index(c):
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast(T.IntegerType())


@dataclass
class KeySide:
    """An equality lookup side, and whether it is broadcast."""
    side: DataFrame
    small: bool


def prepare_scd1_side(dim: DataFrame, spec: DimSpec, max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
                      frozen: bool = False) -> KeySide:
    """The (key, surrogate key) lookup side, broadcast when measured small.  A ``frozen`` dimension is
    read from its own files; any other is persisted."""
    side = dim.select(F.col(spec.bk).alias("__lk"), F.col(spec.sk).alias("__lsk"))
    side, small = broadcast_if_small(side if frozen or is_files(dim) else cache_deterministic(side), max_broadcast_bytes)
    return KeySide(side if small else side.hint("merge"), small)     # files are smaller than their rows


def lookup_scd1(fact: DataFrame, dim: DataFrame, fact_bk: str, spec: DimSpec,
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES, side: KeySide | None = None) -> DataFrame:
    """LEFT join on the business key; a miss becomes -1."""
    side = (side if side is not None else prepare_scd1_side(dim, spec, max_broadcast_bytes)).side
    j = fact.join(side, fact[fact_bk] == side["__lk"], "left")
    return j.withColumn(spec.sk, F.coalesce(F.col("__lsk"), F.lit(UNKNOWN_KEY).cast("bigint"))) \
            .drop("__lk", "__lsk")


def lookup_scd2_current(fact: DataFrame, dim: DataFrame, fact_bk: str, spec: DimSpec,
                        max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """LEFT join to the current version only (IsCurrent); a miss becomes -1."""
    return lookup_scd1(fact, dim.filter(F.col("IsCurrent")), fact_bk, spec, max_broadcast_bytes)


def _pit_side(dim: DataFrame, spec: DimSpec) -> DataFrame:
    return dim.select(F.col(spec.bk).alias("__lk"), F.col(spec.sk).alias("__lsk"),
                      F.col("RowStartDateTime").alias("__ls"),
                      F.coalesce(F.col("RowEndDateTime"), ts_lit(OPEN_END)).alias("__le"))


def _before_end(t, end, half_open: bool):
    return (t < end + F.expr("INTERVAL 1 SECOND")) if half_open else (t <= end)


def time_bounds(df: DataFrame, time_col: str):
    """(min, max) of the event time: one global aggregate over a single column."""
    b = df.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    return b.lo, b.hi


class FactRows:
    """What point-in-time plans ask of the facts: the span of their times, and rows of the key with the
    most (at least that many, if below ``ordered.KEY_MAX_ROWS``).  The facts may be costly to make,
    so a key's pass gives both.  Keys are counted in groups, which hardly shuffles; one by one only
    where a group is large enough to hold a hot key."""

    def __init__(self, fact: DataFrame, time_col: str):
        self.fact, self.time_col, self.passes, self.span = fact, time_col, {}, None

    def _pass(self, key: str):
        if key not in self.passes:
            groups = self.fact.groupBy(F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS)).alias("__group")).agg(
                F.count(F.lit(1)).alias("__n"), F.min(self.time_col).alias("__lo"), F.max(self.time_col).alias("__hi"))
            r = groups.agg(F.max("__n").alias("most"), F.min("__lo").alias("lo"), F.max("__hi").alias("hi")).first()
            most = int(r.most or 0)
            self.passes[key] = r.lo, r.hi, most if most <= ordered.KEY_MAX_ROWS else most_rows(self.fact, key)
        return self.passes[key]

    def bounds(self, key: str | None = None):
        """(min, max) of the time: of what is known, else of a pass by ``key``, if given."""
        if self.span is None:
            passes = [*self.passes.values()] or ([self._pass(key)] if key is not None else [])
            self.span = passes[0][:2] if passes else time_bounds(self.fact, self.time_col)
        return self.span

    def most(self, key: str) -> int:
        return self._pass(key)[2]


@dataclass
class PitSide:
    """A point-in-time lookup side and what its plan depends on."""
    side: DataFrame
    rows: int
    most: int                  # versions of the key with the most
    overlaps: dict = field(default_factory=dict)
    made: bool = True          # the side is files or cached; else it is made whenever it is read
    known: ordered.Versions | None = None

    def disjoint(self, half_open: bool) -> bool:
        """Whether no two versions of a key are known to overlap, without looking."""
        return self.overlaps.get(half_open) is False

    def overlap(self, half_open: bool) -> bool:
        """Whether versions of a key overlap; looked up once."""
        if half_open not in self.overlaps and self.known is not None and self.known.disjoint:
            self.overlaps = {False: False, True: False}
        if half_open not in self.overlaps:
            self.overlaps[half_open] = versions_overlap(self.side, half_open, self.most)
        return self.overlaps[half_open]


def prepare_pit_side(dim: DataFrame, spec: DimSpec, frozen: bool = False, disjoint: bool = False,
                     max_broadcast_bytes: int = BROADCAST_MAX_BYTES, span=None) -> PitSide:
    """The point-in-time lookup side with its row count and most versions on one key - one
    pass over the side gives both bounds the plan depends on.  ``frozen``: as in
    ``prepare_scd1_side``; ``disjoint``: no two versions of a key are known to overlap; ``span``:
    (min, max) of the facts' times, outside of which no version is needed.

    A dimension as its load returned it tells this itself.  If it is large and its versions don't
    overlap, its side is not kept: it is read once, partitioned by key as the load left it."""
    side, known = _pit_side(dim, spec), known_versions(dim)
    counted = known is not None and known.rows is not None
    large = counted and known.rows * PIT_ROW_BYTES > max_broadcast_bytes
    disjoint = disjoint or (large and known.disjoint)
    overlaps = {False: False, True: False} if disjoint else {}
    if disjoint:       # a row that meets the unknown member's version alone gets -1 all the same
        side = side.where(F.col("__lsk") != UNKNOWN_KEY)
    files = frozen or is_files(dim)
    if large and disjoint and not files and known.most <= ordered.KEY_MAX_ROWS:
        return PitSide(side, known.rows, known.most, overlaps, made=False)
    if span is not None and span[0] is not None:
        lo, hi = (ts_lit(t.isoformat(sep=" ")) for t in span)
        side = side.where((F.col("__ls") <= hi) & (F.col("__le") + F.expr("INTERVAL 1 SECOND") >= lo))
    side = side if files else cache_deterministic(side) if counted and not large else written(side, "side")
    stats = side.groupBy("__lk").count().agg(F.sum("count").alias("rows"), F.max("count").alias("mx")).first()
    return PitSide(side, int(stats.rows or 0), int(stats.mx or 0), overlaps, known=known)


def _bucketed(side: DataFrame, index, lo, hi, half_open: bool) -> tuple[DataFrame, object]:
    """Each version copied into the buckets (months or days) of [lo, hi] that it overlaps, and
    the number of its copies."""
    first = F.greatest(index(F.col("__ls")), index(ts_lit(lo.isoformat(sep=" "))))
    # The last instant a version matches lies in its last bucket.
    end = F.col("__le") + F.expr("INTERVAL 1 SECOND") if half_open else F.col("__le")
    last = F.least(index(end), index(ts_lit(hi.isoformat(sep=" "))))
    spans = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return side.withColumn("__lb", F.explode(spans)), F.greatest(last - first + 1, F.lit(0))


def _choose_buckets(side: DataFrame, lo, hi, half_open: bool, bucket: str, max_versions: int, enough=None):
    """(index function, copied side, its number of rows): months, or days where one key crowds
    more than ``max_versions`` versions into a month.  Where ``enough`` says of the number of
    copies by month that they won't be used, months are as good as days and are not made."""
    index = _day_index if bucket == "day" else _month_index
    copies, span = _bucketed(side, index, lo, hi, half_open)
    if bucket == "auto":
        n_copies = int(side.agg(F.sum(span)).first()[0] or 0)
        if enough is not None and enough(n_copies):
            return index, copies, n_copies
        crowd = copies.groupBy("__lk", "__lb").count().agg(F.max("count")).first()[0] or 0
        if crowd > max_versions:
            index = _day_index
            copies, span = _bucketed(side, index, lo, hi, half_open)
        else:
            return index, copies, n_copies
    return index, copies, int(side.agg(F.sum(span)).first()[0] or 0)


def lookup_scd2_pit(fact: DataFrame, dim: DataFrame, fact_bk: str, time_col: str, spec: DimSpec,
                    strategy: str = "auto", max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
                    max_versions_per_key: int = PIT_MAX_VERSIONS_PER_KEY, bounds=None,
                    half_open: bool = False, bucket: str = "auto", prepared: PitSide | None = None,
                    staged: FactRows | None = None) -> DataFrame:
    """LEFT join on key and ``start <= t <= ISNULL(end, 9999-12-31 23:59:59)``; a miss is -1.

    Overlapping versions multiply the fact row, as the SQL join does.  A time between a
    version's end (next start - 1 s) and the next start matches nothing; ``half_open=True``
    matches it to the earlier version (``t < end + 1 s``).  ``strategy`` is

    * ``"equi"``: key join with the interval as residual;
    * ``"bucketed"``: versions copied into the months or days (``bucket``) they overlap, join on
      key and bucket;
    * ``"merge"``: versions and facts in one time order, each fact takes the last version before
      it.  Versions of a key must not overlap (``versions_overlap``);
    * ``"auto"``: equi while no key has more than ``max_versions_per_key`` versions; bucketed
      where the copies can be broadcast (the fact is not shuffled) or versions overlap; else merge.

    ``prepared``: ``prepare_pit_side`` of ``dim``.  ``staged``: the fact before other lookups, which
    is cheaper to count; counts only decide how the merge is laid out.  ``bounds``: (min, max) of
    the fact's time, if known.
    """
    prepared = prepared if prepared is not None else prepare_pit_side(dim, spec, max_broadcast_bytes=max_broadcast_bytes)
    side, rows, mx = prepared.side, prepared.rows, prepared.most
    staged = staged if staged is not None else FactRows(fact, time_col)
    large = rows * PIT_ROW_BYTES > max_broadcast_bytes
    if strategy == "auto":
        strategy = "equi" if mx <= max_versions_per_key else "merge" if large and prepared.disjoint(half_open) else "hot"
    t = F.col(time_col)
    if not prepared.made and (strategy not in ("equi", "merge") or strategy == "equi" and staged.most(fact_bk) > ordered.KEY_MAX_ROWS):
        side = written(side, "side")     # read several times, or a join of hot keys, which splits what was shuffled for it
    if strategy in ("bucketed", "hot"):
        lo, hi = bounds if bounds is not None else staged.bounds(fact_bk if strategy == "hot" else None)
        if lo is None:                 # no fact row has a time: nothing can match
            return fact.withColumn(spec.sk, F.lit(UNKNOWN_KEY).cast("bigint"))
        def beyond(n):                 # a version has at least as many copies by day as by month
            return n * PIT_ROW_BYTES > max_broadcast_bytes

        def merges(n):
            return strategy == "hot" and beyond(n) and not prepared.overlap(half_open)
        index, copies, n_copies = _choose_buckets(side, lo, hi, half_open, bucket, max_versions_per_key, merges)
        small = not beyond(n_copies)
        if merges(n_copies):
            strategy = "merge"
    if strategy == "merge":
        return merge_as_of(fact, side, fact_bk, time_col, spec.sk, half_open, mx + staged.most(fact_bk))
    if strategy == "equi":
        side = side.hint("merge") if large else F.broadcast(side)
        cond = (fact[fact_bk] == side["__lk"]) & (t >= side["__ls"]) & _before_end(t, side["__le"], half_open)
        j = fact.join(side, cond, "left")
        drop = ["__lk", "__lsk", "__ls", "__le"]
    else:
        copies = F.broadcast(copies) if small else copies
        f = fact.withColumn("__fb", index(t))
        cond = ((f[fact_bk] == copies["__lk"]) & (f["__fb"] == copies["__lb"])
                & (t >= copies["__ls"]) & _before_end(t, copies["__le"], half_open))
        j = f.join(copies, cond, "left")
        drop = ["__lk", "__lsk", "__ls", "__le", "__lb", "__fb"]
    return j.withColumn(spec.sk, F.coalesce(F.col("__lsk"), F.lit(UNKNOWN_KEY).cast("bigint"))).drop(*drop)


def prepare_sides(dims: dict[str, DataFrame], lookups, max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
                  frozen: bool = False, disjoint=(), span=None) -> list:
    """The measured sides of a star, for ``star_lookup``: those of dimensions that many batches of
    facts are looked up in are prepared once.  ``frozen``: the dimensions are files;
    ``disjoint``: the tables known to have no two versions of a key that overlap; ``span``: as in
    ``prepare_pit_side``."""
    # All sides together stay within the bound.
    max_broadcast_bytes //= max(1, len(lookups))

    # The side checks are independent small jobs: submit them together.
    def prepare(item):
        _, spec = item
        dim = dims[spec.table]
        return (prepare_scd1_side(dim, spec, max_broadcast_bytes, frozen) if spec.scd == 1
                else prepare_pit_side(dim, spec, frozen, spec.table in disjoint, max_broadcast_bytes, span))
    with cf.ThreadPoolExecutor(max_workers=max(1, len(lookups))) as ex:
        return list(ex.map(prepare, lookups))


def star_lookup(fact: DataFrame, dims: dict[str, DataFrame], lookups, time_col: str,
                pit_strategy: str = "auto", max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
                prepared: list | None = None) -> DataFrame:
    """Swap every business key for its surrogate key: SCD1 by equality, SCD2 point in time.

    ``dims`` maps table name -> gold DataFrame; ``lookups`` is ``[(fact_bk, DimSpec), ...]``;
    ``prepared`` are their ``prepare_sides``.

    Where several dimensions are too large to be broadcast, rows are written with a number of
    their own (unless they are, with ``ordered.TIE``), by which the keys found come back to them.
    """
    if not prepared:
        span = time_bounds(fact, time_col) if is_files(fact) and any(spec.scd == 2 for _, spec in lookups) else None
        prepared = prepare_sides(dims, lookups, max_broadcast_bytes, span=span)
    large = large_lookups(lookups, prepared, max_broadcast_bytes) if pit_strategy == "auto" else []
    if len(large) >= KEYS_GO_FROM:
        numbered = fact if TIE in fact.columns else written(fact, "facts", tie=True)
        out = star_lookup_by(numbered, dims, lookups, time_col, TIE, large, pit_strategy, max_broadcast_bytes, prepared, unique=True)
        return out.select(*fact.columns, *[spec.sk for _, spec in lookups])
    return _look_up(fact, FactRows(fact, time_col), dims, lookups, time_col, pit_strategy,
                    max_broadcast_bytes // max(1, len(lookups)), prepared)


def _look_up(out: DataFrame, staged: FactRows, dims, lookups, time_col: str, pit_strategy: str, max_broadcast_bytes: int,
             prepared: list) -> DataFrame:
    """The star's lookups, one after the other; ``staged`` is counted if needed, and then once."""
    for (fact_bk, spec), prep in zip(lookups, prepared):
        dim = dims[spec.table]
        if spec.scd == 1:
            out = lookup_scd1(out, dim, fact_bk, spec, max_broadcast_bytes, side=prep)
        else:
            out = lookup_scd2_pit(out, dim, fact_bk, time_col, spec, pit_strategy, max_broadcast_bytes,
                                  prepared=prep, staged=staged)
    return out


def _is_large(prep, max_broadcast_bytes: int) -> bool:
    """Whether facts are shuffled to meet a side."""
    return not prep.small if isinstance(prep, KeySide) else prep.rows * PIT_ROW_BYTES > max_broadcast_bytes


def large_lookups(lookups, prepared: list, max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> list[int]:
    """Which of a star's lookups shuffle the facts."""
    return [i for i, prep in enumerate(prepared) if _is_large(prep, max_broadcast_bytes // max(1, len(lookups)))]


def one_match(prep) -> bool:
    """Whether a fact row meets at most one row of a side."""
    if isinstance(prep, KeySide):
        return most_rows(prep.side.where(F.col("__lk").isNotNull()), "__lk") <= 1
    return not prep.overlap(False)


def star_lookup_by(fact: DataFrame, dims: dict[str, DataFrame], lookups, time_col: str, by: str, large: list[int],
                   pit_strategy: str, max_broadcast_bytes: int, prepared: list, one_time: bool = False,
                   unique: bool = False) -> DataFrame:
    """``star_lookup`` for facts that several dimensions are too large to be broadcast to: instead of
    whole fact rows to every one of them, (``by``, key, time) goes there and comes back with the
    surrogate key, and the facts are shuffled once, by ``by``.

    ``large`` are the places of those lookups, each with ``one_match``.  ``by`` is never NULL and has few
    rows per value: within one, a row finds its keys by comparing.  ``one_time``: rows alike in ``by``
    are alike in time, which then need not come back.  ``unique``: no two rows are alike in ``by``, so
    nothing else has to come back, and a row that meets several versions is multiplied as it is
    in ``star_lookup``.  ``fact`` is read once per large lookup, so it should be files."""
    each = max_broadcast_bytes // max(1, len(lookups))
    staged, out = FactRows(fact, time_col), fact
    for i in large:
        bk, spec = lookups[i]
        cols = [by, bk] if spec.scd == 1 else [by, bk, time_col]
        keys = fact.select(*cols).dropna()
        if unique:
            keys = keys.sortWithinPartitions(*cols[1:])
            met = _look_up(keys, staged, dims, [lookups[i]], time_col, pit_strategy, each, [prepared[i]]) \
                .select(F.col(by).alias("__f_by"), spec.sk)
            if not isinstance(prepared[i], KeySide) and prepared[i].disjoint(False):
                met = met.where(F.col(spec.sk) != UNKNOWN_KEY)
            out = out.join(met, out[by] == met["__f_by"], "left").drop("__f_by") \
                .withColumn(spec.sk, F.coalesce(F.col(spec.sk), F.lit(UNKNOWN_KEY).cast("bigint")))
            continue
        n, distinct = keys.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*cols))).first()
        # Lines of a trip that ask the same ask once; rows alike in key travel side by side.
        keys = keys.distinct() if distinct * 2 < n else keys.sortWithinPartitions(*cols[1:])
        if one_time:
            cols = cols[:2]
        found = _look_up(keys, staged, dims, [lookups[i]], time_col, pit_strategy, each, [prepared[i]]) \
            .where(F.col(spec.sk) != UNKNOWN_KEY).select(*[F.col(c).alias(f"__f_{c}") for c in cols], spec.sk) \
            .repartition(f"__f_{by}").dropDuplicates([f"__f_{c}" for c in cols])
        # The rest of the key is compared, not joined on: all these joins are by the same column.
        same = out[by] == found[f"__f_{by}"]
        for c in cols[1:]:
            same = same & (out[c] >= found[f"__f_{c}"]) & (out[c] <= found[f"__f_{c}"])
        out = out.join(found, same, "left").drop(*[f"__f_{c}" for c in cols]) \
            .withColumn(spec.sk, F.coalesce(F.col(spec.sk), F.lit(UNKNOWN_KEY).cast("bigint")))
    return small_lookups(out, dims, lookups, time_col, large, pit_strategy, max_broadcast_bytes, prepared)


def small_lookups(fact: DataFrame, dims: dict[str, DataFrame], lookups, time_col: str, large: list[int],
                  pit_strategy: str, max_broadcast_bytes: int, prepared: list) -> DataFrame:
    """The lookups of a star that don't shuffle the facts."""
    small = [i for i in range(len(lookups)) if i not in large]
    return _look_up(fact, FactRows(fact, time_col), dims, [lookups[i] for i in small], time_col, pit_strategy,
                    max_broadcast_bytes // max(1, len(lookups)), [prepared[i] for i in small])
