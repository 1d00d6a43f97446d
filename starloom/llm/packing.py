"""Best-fit packing by linear grouping.

Documents become pieces of at most ``capacity`` tokens.  Lengths are at most ``capacity``, so
the exact length histogram has a fixed size however many documents there are; the packing is
planned on the histogram and then dealt out to the pieces by rank within their length:

1. Pieces longer than ``large`` are put in groups of equal cardinality by length, and each
   group's lengths are rounded up to its longest: a few sizes.
2. The configuration problem of the few sizes (how many sequences hold which multiset of
   sizes) is optimised as a linear programme by column generation, and rounded down.
3. Actual lengths replace the rounded ones, which gives back the rounding slack.
4. What remains - large pieces left by rounding down, then the small ones - goes, longest
   first, each where it leaves the least room (best fit).

The plan is a list of runs: a multiset of lengths and the number of sequences made like it.
Pieces of one length are interchangeable, so piece number r of length l takes slot number r of
length l: a lookup in the plan, which is bounded by the capacity and not by the data.

Defined cases: null text is empty text, one piece holding the end token only; equal documents
are pieces like any other; repeated rows are packed as often as they occur; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stage
from .word_tokenizer import word_tokenizer

#: Groups of the linear grouping scheme.
GROUPS = 64


# --- pieces -------------------------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and (blk, rank): the number
    of earlier pieces of this length in the same input block."""
    small_batches(docs.sparkSession)
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
              "length long, ids_crc32 long, blk int, rank long")
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, blk = word_tokenizer(tokenizer_path).encode, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array([blk] * len(rows), pa.int32()), pa.array(rank, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "blk", "rank"])

    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(cut, schema)


# --- plan ---------------------------------------------------------------------------------

@dataclass
class Run:
    """``count`` sequences, each holding ``items``: (length, how many)."""
    count: int
    items: tuple = ()
    room: int = 0


@dataclass
class _Rooms:
    """Runs by the room left in their sequences."""
    runs: dict = field(default_factory=lambda: defaultdict(list))
    sizes: list = field(default_factory=list)

    def add(self, run: Run) -> None:
        if run.count:
            if not self.runs[run.room]:
                bisect.insort(self.sizes, run.room)
            self.runs[run.room].append(run)

    def tightest(self, length: int) -> Run | None:
        at = bisect.bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        room = self.sizes[at]
        run = self.runs[room].pop()
        if not self.runs[room]:
            self.sizes.pop(at)
        return run


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Column generation for the cutting-stock relaxation: (units of each size, sequences),
    rounded down.  ``sizes`` are few, so this is a fixed amount of work."""
    m = len(sizes)
    n = np.asarray(demand, dtype=float)
    columns = [np.eye(m)[g] * (capacity // sizes[g]) for g in range(m)]
    basis = np.column_stack(columns)
    x = n / np.diag(basis)
    for _ in range(60 * m):
        price = np.linalg.solve(basis.T, np.ones(m))
        column = _best_column(price, sizes, capacity)
        if price @ column <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        x = x - ratio[out] * step
        x[out] = ratio[out]
        basis[:, out] = column
    found = [(tuple(int(v) for v in basis[:, j]), int(x[j] + 1e-9)) for j in range(m)]
    return [(c, k) for c, k in found if k > 0]


def _best_column(price: np.ndarray, sizes: list[int], capacity: int) -> np.ndarray:
    """Knapsack by number of units: the multiset of sizes of the highest price that fits."""
    worth, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        better, pick = worth.copy(), np.full(capacity + 1, -1)
        for g, s in enumerate(sizes):
            with_unit = worth[:-s] + price[g]
            wins = with_unit > better[s:] + 1e-12
            better[s:][wins] = with_unit[wins]
            pick[s:][wins] = g
        worth = better
        picks.append(pick)
    column, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            column[pick[room]] += 1
            room -= sizes[pick[room]]
    return column


def plan(hist: dict[int, int], capacity: int, groups: int = GROUPS, large: int | None = None) -> list[Run]:
    """Runs that hold exactly the pieces of ``hist`` (length -> number)."""
    large = capacity // 3 if large is None else large
    done = [Run(hist[capacity], ((capacity, 1),))] if hist.get(capacity) else []
    left = {n: c for n, c in hist.items() if c and n < capacity}
    rooms = _Rooms()
    big = sorted((n, c) for n, c in left.items() if n > large)
    if big:
        queues = _linear_groups(big, groups)
        sizes = [q[-1][0] for q in queues]
        for config, count in configurations(sizes, [sum(c for _, c in q) for q in queues], capacity):
            slots = [g for g, k in enumerate(config) for _ in range(k)]
            for run in _substitute(slots, queues, count, capacity, left):
                rooms.add(run)
    for length in sorted(left, reverse=True):
        _best_fit(rooms, length, left[length], capacity)
    return done + [r for runs in rooms.runs.values() for r in runs]


def _linear_groups(big: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Split (length, number), ascending, into groups of equal cardinality.  Neighbouring
    groups that round to the same length are one."""
    total = sum(c for _, c in big)
    out, at, g = [[]], 0, 1
    for n, c in big:
        while c:
            take = min(c, -(-total * g // groups) - at)
            if take:
                out[-1].append([n, take])
                at, c = at + take, c - take
            if at >= -(-total * g // groups) and g < groups:
                out.append([])
                g += 1
    merged: list[list[list[int]]] = []
    for q in filter(None, out):
        if merged and merged[-1][-1][0] == q[-1][0]:
            merged[-1].extend(q)
        else:
            merged.append(q)
    return merged


def _substitute(slots, queues, count, capacity, left) -> list[Run]:
    """Deal actual lengths, longest first, to ``count`` sequences with these group slots."""
    dealt = []
    for g in slots:
        segments, need = [], count
        while need and queues[g]:
            n, c = queues[g][-1]
            k = min(c, need)
            segments.append([n, k])
            need -= k
            left[n] -= k
            if k == c:
                queues[g].pop()
            else:
                queues[g][-1][1] -= k
        if need:
            segments.append([0, need])
        dealt.append(segments)
    runs, done = [], 0
    while done < count:
        k = min(s[0][1] for s in dealt)
        lengths = [s[0][0] for s in dealt if s[0][0]]
        if lengths:
            runs.append(Run(k, tuple((n, 1) for n in lengths), capacity - sum(lengths)))
        for s in dealt:
            s[0][1] -= k
            if not s[0][1]:
                s.pop(0)
        done += k
    return runs


def _best_fit(rooms: _Rooms, length: int, n: int, capacity: int) -> None:
    """Put ``n`` pieces of ``length``, each into the tightest room: a sequence that took one
    is the tightest as long as another fits."""
    while n:
        run = rooms.tightest(length) or Run(-(-n // (capacity // length)), (), capacity)
        each = run.room // length
        whole = min(run.count, n // each)
        rooms.add(Run(whole, run.items + ((length, each),), run.room - length * each))
        n -= whole * each
        rest = run.count - whole
        if rest and n:
            some = min(n, each)
            rooms.add(Run(1, run.items + ((length, some),), run.room - length * some))
            n -= some
            rest -= 1
        if run.items:
            rooms.add(Run(rest, run.items, run.room))


def slot_table(runs: list[Run]) -> dict[str, np.ndarray]:
    """Slots by length: from rank ``first`` on, ``each`` pieces go to a sequence from number
    ``sequence`` on, the first of them at ``offset``."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length, each in run.items:
            rows.append((length, taken[length], sequence, each, offset))
            taken[length] += run.count * each
            offset += length * each
        sequence += run.count
    rows.sort()
    t = np.asarray(rows, dtype=np.int64).reshape(-1, 5)
    return {"key": (t[:, 0] << 44) | t[:, 1], "first": t[:, 1], "sequence": t[:, 2], "each": t[:, 3], "offset": t[:, 4]}


# --- operator -----------------------------------------------------------------------------

def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         groups: int = GROUPS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    cut = stage(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    by_block = cut.groupBy("blk", "length").agg(F.count(F.lit(1)).alias("n"))
    hist = {r["length"]: r["n"] for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(plan(hist, capacity, groups))

    before = Window.partitionBy("length").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_block.select("blk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["blk", "length"]).withColumn("rank", F.col("rank") + F.col("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(slots["key"], (n << 44) | r, side="right") - 1
        x, each = r - slots["first"][at], slots["each"][at]
        return pd.DataFrame({"sequence_id": slots["sequence"][at] + x // each,
                             "offset": slots["offset"][at] + x % each * n})

    return (ranked.withColumn("p", place("length", "rank"))
                  .select("doc_id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset"))
