"""The as-of merge against the interval join."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from starloom.operators import asof, lookup
from starloom.operators.ordered import range_layout, written
from starloom.schemas import VENDOR

DIM = "VendorKey long, VendorID int, VendorName string, RowStartDateTime timestamp_ntz, RowEndDateTime timestamp_ntz, IsCurrent boolean"
FACT = "id int, VendorID int, t timestamp_ntz, VendorName string"
START = dt.datetime(2020, 1, 1)


def history(rng, key, n, first_sk, gaps=True):
    """Versions without overlap, with empty ones (equal dates) and sub-second or longer gaps."""
    out, at = [], START + dt.timedelta(days=rng.randrange(5))
    for i in range(n):
        nxt = at + dt.timedelta(seconds=rng.choice([0, 1, 1, 3600, 86400 * 3]))
        end = None if i == n - 1 and rng.random() < .7 else nxt - dt.timedelta(seconds=1)
        out.append((first_sk + i, key, f"v{i}", at, end, end is None))
        at = nxt + dt.timedelta(days=rng.choice([0, 0, 0, 4])) if gaps else nxt
    return out


def trips(rng, n, keys):
    times = [None] + [START + dt.timedelta(milliseconds=rng.randrange(0, 40 * 86400 * 1000, 250)) for _ in range(60)]
    return [(i, rng.choice(keys), rng.choice(times), f"x{i % 3}") for i in range(n)]


def by_hand(facts, versions, half_open):
    out = []
    for f in facts:
        hits = [v[0] for v in versions if f[1] is not None and v[1] == f[1] and f[2] is not None and v[3] <= f[2]
                and (v[4] is None or (f[2] < v[4] + dt.timedelta(seconds=1) if half_open else f[2] <= v[4]))]
        assert len(hits) <= 1
        out.append((*f, hits[0] if hits else -1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_interval_join(spark, seed, half_open):
    rng = random.Random(seed)
    versions = [v for k in range(6) for v in history(rng, k, rng.choice([1, 3, 80]), 1000 * k)]
    versions += [(9001, None, "null key", START, None, True)]
    facts = trips(rng, 600, [0, 0, 0, 1, 2, 3, 4, 5, 77, None])
    facts += [(1000, v[1], v[3], "at start") for v in versions] + [(1001, v[1], v[4], "at end") for v in versions]
    dim, fact = spark.createDataFrame(versions, DIM), spark.createDataFrame(facts, FACT)
    assert not asof.versions_overlap(lookup._pit_side(dim, VENDOR), half_open)
    want = by_hand(facts, versions, half_open)
    for how in ("merge", "equi", "bucketed"):
        got = lookup.lookup_scd2_pit(fact, dim, "VendorID", "t", VENDOR, strategy=how, half_open=half_open)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want, how


def test_one_key_over_many_partitions(spark):
    """A key with all facts and versions: the state is carried over partition borders, and rows
    alike in key and time are split."""
    rng = random.Random(3)
    versions = history(rng, 5, 40, 1, gaps=False)
    facts = [(i, 5, START + dt.timedelta(days=30), "copy") for i in range(4000)] + trips(rng, 2000, [5])
    fact, side = spark.createDataFrame(facts, FACT), lookup._pit_side(spark.createDataFrame(versions, DIM), VENDOR)
    got = asof.merge_as_of(fact, side, "VendorID", "t", "VendorKey")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(facts, versions, False)
    rows = written(fact, "t", tie=True)
    layout = range_layout(rows, [F.col("VendorID"), F.col("t"), F.col("__sl_tie")], num_partitions=8)
    sizes = [r["count"] for r in layout.rows.groupBy("__sl_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8


def test_overlap_is_seen(spark):
    day = lambda d: START + dt.timedelta(days=d)
    for second, overlaps in (((day(2), day(4)), True), ((day(3), day(4)), True), ((day(3) + dt.timedelta(seconds=1), None), False)):
        rows = [(1, 1, "a", day(0), day(3), False), (2, 1, "b", *second, False), (3, 2, "c", day(1), None, True),
                (4, 1, "empty", day(1), day(1) - dt.timedelta(seconds=1), False)]
        assert asof.versions_overlap(lookup._pit_side(spark.createDataFrame(rows, DIM), VENDOR)) is overlaps


def test_auto_merges_when_copies_are_too_many(spark, monkeypatch):
    rng = random.Random(4)
    versions = history(rng, 1, 200, 1, gaps=False)
    facts = trips(rng, 300, [1])
    dim, fact = spark.createDataFrame(versions, DIM), spark.createDataFrame(facts, FACT)
    used = []
    monkeypatch.setattr(lookup, "merge_as_of", lambda *a: used.append(1) or asof.merge_as_of(*a))
    got = lookup.lookup_scd2_pit(fact, dim, "VendorID", "t", VENDOR, max_broadcast_bytes=100)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(facts, versions, False) and used
    # Overlapping versions keep the interval join, which multiplies.
    both = spark.createDataFrame(versions + [(999, 1, "all", START, None, True)], DIM)
    used.clear()
    got = lookup.lookup_scd2_pit(fact, both, "VendorID", "t", VENDOR, max_broadcast_bytes=100)
    assert got.where("VendorKey = 999").count() == sum(f[2] is not None for f in facts) and not used


def test_nothing(spark):
    fact, dim = spark.createDataFrame([], FACT), spark.createDataFrame([], DIM)
    assert lookup.lookup_scd2_pit(fact, dim, "VendorID", "t", VENDOR, strategy="merge").count() == 0
    some = spark.createDataFrame([(1, 1, START, "x")], FACT)
    assert [r["VendorKey"] for r in lookup.lookup_scd2_pit(some, dim, "VendorID", "t", VENDOR, strategy="merge").collect()] == [-1]


def test_merge_without_a_hot_key_writes_nothing(spark, monkeypatch):
    """By key or on a range layout: the same rows, keys and times of any type."""
    from starloom.operators import ordered
    rng = random.Random(6)
    versions = [v for k in range(5) for v in history(rng, k, rng.choice([1, 90]), 1000 * k)]
    facts = trips(rng, 400, [0, 0, 1, 2, 3, 4, 9, None])
    dim, fact = spark.createDataFrame(versions, DIM), spark.createDataFrame(facts, FACT).withColumn("VendorID", F.col("VendorID").cast("long"))
    written, real = [], ordered.written
    monkeypatch.setattr(ordered, "written", lambda *a, **k: written.append(a[1]) or real(*a, **k))
    for most in (1 << 20, 10):
        monkeypatch.setattr(ordered, "KEY_MAX_ROWS", most, raising=False)
        got = lookup.lookup_scd2_pit(fact, dim, "VendorID", "t", VENDOR, max_broadcast_bytes=100)
        assert got.columns == [*fact.columns, "VendorKey"] and got.schema["VendorID"].dataType == fact.schema["VendorID"].dataType
        assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(facts, versions, False)
        assert bool(written) == (most == 10)
