"""Stars over dimensions too large to be broadcast: what is shuffled, written and looked up, and how often."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import fact as fact_ops
from starloom.operators import lookup, ordered, scd2, sizing
from starloom.plans import backfill as B
from starloom.plans import loads as L
from starloom.plans import publish as P
from starloom.schemas import FACTTRIP, SCD1_DIMS, SCD2_DIMS, VENDOR
from test_fact_by_trip import NOW, day, exchanges_with, loaded, made, sources, trips

LOOKUPS = FACTTRIP.lookups


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    return made(spark, str(tmp_path_factory.mktemp("dims")))


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_star_sends_keys_and_shuffles_rows_once(spark, dims, tmp_path):
    """Also where trips have no id, rows come twice, versions overlap or a key is there twice."""
    more = [(None, 1, 1, 1, 1, 1, 1, Decimal(1), Decimal(1), day(4))] * 2
    extra = {"VENDOR": [(1, "a", None), (1, "b", None)], "TRUCK": [(-1, "a", "b", day(0))]}
    stg, over = trips(spark, more), dims | made(spark, str(tmp_path / "more"), extra)
    for d in (dims, over):
        whole = lookup.star_lookup(stg, d, LOOKUPS, "TripDate", "equi")
        by_key = lookup.star_lookup(stg, d, LOOKUPS, "TripDate", max_broadcast_bytes=0)
        assert by_key.columns == whole.columns and rows_of(by_key) == rows_of(whole)
    assert exchanges_with(lookup.star_lookup(stg, dims, LOOKUPS, "TripDate", max_broadcast_bytes=0), "Revenue") <= 1


def test_loaded_histories_are_read_as_the_load_left_them(spark, dims, monkeypatch):
    """Large versions that follow each other are neither written as a side nor compared for overlaps;
    those of undated rows, which overlap, are."""
    stg = trips(spark)
    want = loaded(stg, dims)
    src = sources(spark)
    fresh = {s.table: dims[s.table] if s.scd == 1 else scd2.scd2_full(src[s.table], s, frozen=True) for s in SCD1_DIMS + SCD2_DIMS}
    monkeypatch.setattr(lookup, "versions_overlap", lambda *a: pytest.fail("compared"))
    seen, write = [], ordered.written
    monkeypatch.setattr(lookup, "written", lambda df, name, *a, **k: seen.append(name) or write(df, name, *a, **k))
    assert loaded(stg, fresh, max_broadcast_bytes=0) == want and not seen
    undated = spark.createDataFrame([(1, "a", None), (1, "b", None)], VENDOR.staging_schema())
    side = lookup.prepare_pit_side(scd2.scd2_full(undated, VENDOR), VENDOR, max_broadcast_bytes=0)
    assert seen == ["side"] and not side.disjoint(False)


def test_increment_of_loaded_history(spark):
    """Overlaps are known not to be there only while a change is no earlier than the version it ends."""
    src = sources(spark)["VENDOR"]
    base = scd2.scd2_full(src, VENDOR, frozen=True)

    def after(*rows):
        return scd2.scd2_inc(base, spark.createDataFrame(list(rows), VENDOR.staging_schema()), VENDOR)
    later, early, undated = (1, "new", day(500)), (1, "new", day(1)), (1, "new", None)
    for rows, disjoint in (([later], True), ([later, (99, "first", day(0))], True), ([early], False), ([undated], False)):
        dim = after(*rows)
        assert ordered.known_versions(dim).disjoint is disjoint
        if disjoint:
            assert not lookup.versions_overlap(lookup._pit_side(dim, VENDOR))


def test_keys_of_rows_without_one_and_numbers_by_join(spark):
    """NULL is the first key; numbers go on from it."""
    rows = spark.createDataFrame([(None, "n", day(1)), (None, "n", day(2)), (2, "b", day(0)), (1, "a", day(3))], VENDOR.staging_schema())
    got = scd2.scd2_full(rows, VENDOR, add_unknown=False, frozen=True).orderBy("VendorKey").collect()
    assert [(r.VendorKey, r.VendorID) for r in got] == [(1, None), (2, None), (3, 1), (4, 2)]
    assert got[0].RowEndDateTime == day(2) - dt.timedelta(seconds=1)


def test_increments_are_numbered_by_trip_too(spark, dims, monkeypatch):
    stg = trips(spark)
    full = fact_ops.fact_full(stg, dims, FACTTRIP, NOW, max_broadcast_bytes=0)
    assert ordered.known_max_key(full) == 46 and fact_ops.next_key_base(full, FACTTRIP.sk) == 46
    want = rows_of(full.withColumn(FACTTRIP.sk, F.col(FACTTRIP.sk) + 1000))
    monkeypatch.setattr(fact_ops, "dense_key", lambda *a, **k: pytest.fail("laid out"))
    more = fact_ops.keyed_facts(stg, dims, FACTTRIP, NOW, 1000, max_broadcast_bytes=0)
    assert rows_of(more) == want and ordered.known_max_key(more) == 1046


def test_facts_are_counted_in_groups_unless_one_is_hot(spark, monkeypatch):
    facts = spark.range(500).select((F.col("id") % 5).alias("k"), F.lit(day(0)).alias("t"))
    exact, real = [], lookup.most_rows
    monkeypatch.setattr(lookup, "most_rows", lambda *a: exact.append(1) or real(*a))
    assert lookup.FactRows(facts, "t").most("k") >= 100 and not exact
    monkeypatch.setattr(ordered, "KEY_MAX_ROWS", 50)
    assert lookup.FactRows(facts, "t").most("k") == 100 and exact


def test_keys_of_millions_of_changes_are_not_broadcast(spark):
    """At 5 million changed keys the driver was to hold several times 170 MB, for three tables at once."""
    first = spark.range(5_400_000).select(F.col("id").cast("int").alias("__bk"), F.lit(day(0)).alias("FirstNewDate"), F.lit(True).alias("__hit"))
    assert not sizing.broadcast_if_small(first)[1]
    assert sizing.broadcast_if_small(first.limit(100_000))[1]


def test_a_run_looks_its_later_slices_up_at_once(spark, tmp_path, monkeypatch):
    root, row = str(tmp_path / "wh"), {"TABLENAME": "FACTTRIP", "LOADTYPE": "FACT"}
    src = sources(spark)
    L.bulk_load_all(spark, lambda name, lo, hi: src[name.upper()], root, NOW, NOW,
                    control=L.control_seed(spark, "full").where("LOADTYPE <> 'FACT'"))
    stg = trips(spark, [(None, 1, 1, 1, 1, 1, 1, Decimal(1), Decimal(1), day(4))])
    source = stg.withColumn("ModifiedDate", F.when(F.col("TripID") > 0, F.expr("make_timestamp_ntz(2000 + pmod(TripID, 5), 1, 1, 0, 0, 0)"))
                            .when(F.col("TripID").isNull(), F.lit(dt.datetime(2003, 5, 5))))
    calls, real = [], fact_ops.star_lookup
    monkeypatch.setattr(fact_ops, "star_lookup", lambda *a, **k: calls.append(1) or real(*a, **k))
    with pytest.raises(Exception, match="NOT NULL business key"):
        B.backfill_table(spark, row, source, root, NOW, NOW)
    m = P.read_manifest(spark, root, "FACTTRIP")
    assert m["backfill"]["done"] == ["undated", "2000", "2001", "2002"] and len(calls) == 2
    part = P.read_table(spark, root, "FACTTRIP")
    assert part.count() == m["max_key"] == part.select("TripFactKey").distinct().count()
    B.backfill_table(spark, row, source, root, NOW, NOW, on_null_key="quarantine")
    assert len(calls) == 3
    dims = {s.table: P.read_table(spark, root, s.table) for _, s in LOOKUPS}
    got, want = P.read_table(spark, root, "FACTTRIP"), fact_ops.fact_full(stg.where("TripID IS NOT NULL"), dims, FACTTRIP, NOW)
    assert rows_of(got.drop("TripFactKey")) == rows_of(want.drop("TripFactKey"))
    assert sorted(r[0] for r in got.select("TripFactKey").collect()) == list(range(1, got.count() + 1))
    assert spark.read.parquet(f"{root}/_quarantine/FACTTRIP").count() == 1


def test_snapshot_is_summed_once_for_its_lookups(spark, monkeypatch):
    from starloom.operators import marts as M
    from test_marts import LINES, TRIPS, line, trip
    seen = []
    with_keys = M.with_keys
    monkeypatch.setattr(M, "with_keys", lambda fact, *a: seen.append(fact) or with_keys(fact, *a))
    lines = spark.createDataFrame([line(1, 1, 7, 70, "2020-01-02"), line(1, 2, 8, 71, "2020-01-03"), line(9, 1, 7, 70, "2020-01-05")], LINES)
    of_trips, places = spark.createDataFrame([trip(1, "A"), trip(2, "A")], TRIPS), spark.createDataFrame([(5, "A")], "Location_SKey long, Branch_ID string")
    keys = {"Location_SKey": ("Branch_ID", M.conformed("PLACE", "Branch_ID", "Location_SKey"))}
    got = M.fact_fleet_utilization(lines, of_trips, {"Location_SKey": places}, keys)
    assert sorted((r.Vehicle_ID, r.Date_SKey, r.Trips_Count_Daily, r.Location_SKey) for r in got.collect()) == \
        [(7, 20200102, 1, 5), (7, 20200103, 0, 5), (7, 20200104, 0, 5), (7, 20200105, 1, 5), (8, 20200103, 1, 5)]
    assert seen[0].inputFiles()
