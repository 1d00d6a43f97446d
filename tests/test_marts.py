"""Marts against plain Python on small rows: snapshots, shifts, allocation, seasons, hierarchies."""
import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from starloom import catalog
from starloom.operators import marts as M
from starloom.operators import ordered, shifts
from starloom.operators.allocation import allocate, unallocated
from starloom.operators.keys import unknown_member
from support import ts

LINES = ("Trip_ID long, Line_No int, Vehicle_ID int, Driver_ID int, Commodity string, Ownership_Type string, Weight decimal(10,2), "
         "Distance decimal(10,2), Amount decimal(18,2), Fuel_Rate decimal(4,2), Driver_Rate decimal(4,2), Delivered timestamp_ntz")
TRIPS = ("Trip_ID long, Trip_Date timestamp_ntz, Customer_ID int, Address_ID int, Trip_Type string, Billed decimal(18,2), "
         "Branch_ID string")


def line(trip, no, vehicle, driver, delivered, km="20.00", tons="5.00", commodity="ore"):
    return (trip, no, vehicle, driver, commodity, "OWN", D(tons), D(km), D("100.00"), D("0.05"), D("0.10"), ts(delivered))


def trip(i, branch, date="2020-01-01"):
    return (i, ts(date), 1, 11, "T", D("500.00"), branch)


# --- daily snapshot -----------------------------------------------------------------------

def test_snapshot_fills_forward_and_keeps_unknown_vehicles(spark):
    lines = [line(1, 1, 7, 70, "2020-01-01 08:00:00"), line(1, 2, 7, 71, "2020-01-01 08:00:00"),
             line(2, 1, 7, None, "2020-01-04"), line(3, 1, 7, 72, "2020-01-06"),
             line(4, 1, None, 90, "2020-01-02"), line(4, 2, None, 90, "2020-01-02"), line(5, 1, 8, 80, None)]
    trips = [trip(1, "A"), trip(2, None), trip(3, "C"), trip(4, "Z"), trip(5, "Z")]
    rows = M.daily_snapshot(spark.createDataFrame(lines, LINES), spark.createDataFrame(trips, TRIPS)).collect()
    got = {(r.Vehicle_ID, r.Date_SKey): (r.Driver_ID, r.Branch_ID, r.Trips_Count_Daily, str(r.Distance_KM_Daily)) for r in rows}
    assert got == {
        (7, 20200101): (71, "A", 2, "40.00"), (7, 20200102): (71, "A", 0, "0.00"), (7, 20200103): (71, "A", 0, "0.00"),
        (7, 20200104): (71, "A", 1, "20.00"), (7, 20200105): (71, "A", 0, "0.00"), (7, 20200106): (72, "C", 1, "20.00"),
        (None, 20200102): (90, "Z", 2, "40.00")}
    assert {str(r.Snapshot_Time) for r in rows if r.Date_SKey == 20200101} == {"2020-01-01 23:59:59"}


def test_snapshot_keys_and_drill_across(spark):
    lines = [line(1, 1, 7, 70, "2020-01-01"), line(2, 1, 7, 70, "2020-01-03"), line(3, 1, None, 5, "2020-01-03"),
             line(4, 1, 99, 70, "2020-01-03")]
    trips = [trip(i, "A") for i in range(1, 5)]
    fleet = spark.createDataFrame([(1, 7, "OWN", ts("2020-01-01"), ts("2020-01-02 11:59:59")), (2, 7, "VENDOR", ts("2020-01-02 12:00:00"), None)],
                                  "Fleet_SKey long, Vehicle_ID int, Ownership_Type string, RowStartDateTime timestamp_ntz, RowEndDateTime timestamp_ntz")
    places = spark.createDataFrame([(5, "A")], "Location_SKey long, Branch_ID string")
    keys = {"Fleet_SKey": ("Vehicle_ID", M.conformed("FLEET", "Vehicle_ID", "Fleet_SKey", 2)),
            "Location_SKey": ("Branch_ID", M.conformed("PLACE", "Branch_ID", "Location_SKey"))}
    util = M.fact_fleet_utilization(spark.createDataFrame(lines, LINES), spark.createDataFrame(trips, TRIPS),
                                    {"Fleet_SKey": fleet, "Location_SKey": places}, keys)
    got = {r.DD_Snapshot_ID: (r.Fleet_SKey, r.Location_SKey, r.Trips_Count_Daily) for r in util.collect()}
    assert got == {"7-20200101": (1, 5, 1), "7-20200102": (2, 5, 0), "7-20200103": (2, 5, 1), "UNKNOWN-20200103": (-1, 5, 1),
                   "99-20200103": (-1, 5, 1)}
    own = {r.Ownership_Type: (r.Vehicle_Days, str(r.Idle_Hours)) for r in M.hours_by_ownership(util, fleet).collect()}
    assert own == {"OWN": (1, "23.60"), "VENDOR": (2, "47.60"), None: (2, "47.20")}


# --- day and night ------------------------------------------------------------------------

def cut(a, b, day_start=6, night_start=18):
    """Pieces of [a, b) at shift and midnight borders, second by border."""
    out, at = defaultdict(int), a
    while at < b:
        midnight = dt.datetime.combine(at.date(), dt.time())
        borders = [midnight + dt.timedelta(hours=h) for h in (day_start, night_start, 24)]
        end = min([x for x in borders if x > at] + [b])
        end = min(end, b)
        shift = "DAY" if day_start <= (at - midnight).total_seconds() / 3600 < night_start else "NIGHT"
        out[at.date(), shift] += (end - at) // dt.timedelta(microseconds=1)
        at = end
    return out


def some_intervals(seed, n):
    rng = random.Random(seed)
    t0 = dt.datetime(1969, 12, 29)
    rows = []
    for i in range(n):
        a = t0 + dt.timedelta(seconds=rng.choice([0, 6 * 3600, 18 * 3600, 86400, rng.randrange(9 * 86400)]), microseconds=rng.choice([0, 1, 999_999]))
        rows.append((i, rng.choice(["x", "y"]), a, a + dt.timedelta(seconds=rng.choice([0, 1, 3600 * 12, rng.randrange(5 * 86400)]))))
    return rows + [(900, "x", None, t0), (901, "x", t0, None), (902, "y", t0 + dt.timedelta(1), t0)]


@pytest.mark.parametrize("day_start,night_start", [(6, 18), (7, 22)])
def test_shift_hours_are_the_cut_pieces(spark, day_start, night_start):
    rows = some_intervals(1, 60)
    df = spark.createDataFrame(rows, "i int, g string, a timestamp_ntz, b timestamp_ntz")
    want = defaultdict(int)
    for _, g, a, b in rows:
        if a and b and a <= b:
            for (day, shift), us in cut(a, b, day_start, night_start).items():
                want[g, day, shift] += us
    got = {(r.g, r.Full_Date, r.Shift): r.Micros for r in shifts.shift_hours(df, "a", "b", ["g"], day_start, night_start).collect()}
    assert {k: v for k, v in got.items() if v} == dict(want)
    total = sum((b - a) // dt.timedelta(microseconds=1) for _, _, a, b in rows if a and b and a <= b)
    assert sum(got.values()) == total
    assert shifts.shift_hours(df, "a", "b").agg(F.sum("Micros")).first()[0] == total


def test_trip_hours_divide_exactly(spark):
    rows = some_intervals(2, 80)
    df = spark.createDataFrame(rows, "i int, g string, a timestamp_ntz, b timestamp_ntz")
    for r in shifts.with_shift_hours(df, "a", "b").collect():
        if not r.a or not r.b or r.b < r.a:
            assert r.Total_Hours is r.Day_Hours is r.Night_Hours is None
            continue
        day = sum(us for (_, s), us in cut(r.a, r.b).items() if s == "DAY")
        half_up = lambda us: D((us // 10 ** 6 * 100 * 2 + 3600) // 7200) / 100
        assert r.Total_Hours == half_up((r.b - r.a) // dt.timedelta(microseconds=1))
        assert r.Day_Hours == half_up(day) and r.Day_Hours + r.Night_Hours == r.Total_Hours and r.Night_Hours >= 0


def test_rollup_reaches_shifts(spark):
    df = spark.createDataFrame([(1, ts("2020-03-31 05:00:00"), ts("2020-04-01 07:00:00"))], "i int, a timestamp_ntz, b timestamp_ntz")
    rows = {(r.Fiscal_Year, r.Full_Date, r.Shift, r.Grouping_Level): str(r.Trip_Hours)
            for r in shifts.calendar_shift_rollup(shifts.shift_hours(df, "a", "b")).collect()}
    day = dt.date(2020, 3, 31)
    assert rows[None, None, None, 31] == "26.00"
    assert rows[2020, day, "DAY", 0] == "12.00" and rows[2020, day, "NIGHT", 0] == "7.00" and rows[2020, day, None, 1] == "19.00"
    assert rows[2021, dt.date(2020, 4, 1), "NIGHT", 0] == "6.00" and rows[2021, dt.date(2020, 4, 1), "DAY", 0] == "1.00"


# --- allocation ---------------------------------------------------------------------------

def by_largest_remainder(parts, costs):
    groups = defaultdict(list)
    for i, p, w in parts:
        groups[p].append((i, max(0, int((w or D(0)) * 100))))
    owed = defaultdict(lambda: None)
    for p, a in costs:
        owed[p] = (owed[p] or 0) + int(a * 100)
    out = {}
    for p, members in groups.items():
        cents = abs(owed[p] or 0)
        total = sum(w for _, w in members)
        if not total:
            members, total = [(i, 1) for i, _ in members], len(members)
        shares = [(i, cents * w // total, cents * w % total) for i, w in members]
        left = cents - sum(s[1] for s in shares)
        order = sorted(shares, key=lambda s: (-s[2], s[0]))
        for n, (i, base, _) in enumerate(order):
            out[i] = (1 if (owed[p] or 0) >= 0 else -1) * D(base + (n < left)) / 100
    return out


def test_allocation_is_largest_remainder(spark):
    rng = random.Random(5)
    parts = [(i, rng.choice(["hot", "hot", "hot", "a", "b", None, "unpaid", "idle"]),
              rng.choice([None, D("0"), D("-3"), D("0.01"), D(rng.randrange(1, 10 ** 6)) / 100])) for i in range(700)]
    parts = [(i, p, D(0) if p == "idle" else w) for i, p, w in parts]
    costs = [("hot", D("1234567.89")), ("a", D("0.07")), ("b", D("-55.55")), (None, D("10.00")), ("idle", D("1.00")),
             ("a", D("0.04")), ("nobody", D("9.99"))]
    p = spark.createDataFrame(parts, "i int, period string, w decimal(10,2)")
    c = spark.createDataFrame(costs, "period string, Amount decimal(18,2)")
    got = {r.i: r.share for r in allocate(p, c, ["period"], "w", ["i"], "share").collect()}
    assert got == by_largest_remainder(parts, costs)
    sums = defaultdict(D)
    for i, period, _ in parts:
        sums[period] += got[i]
    assert sums["hot"] == D("1234567.89") and sums["a"] == D("0.11") and sums["b"] == D("-55.55") and sums[None] == D("10.00")
    assert sums["idle"] == D("1.00") and sums["unpaid"] == 0
    assert [tuple(r) for r in unallocated(p, c, ["period"]).collect()] == [("nobody", D("9.99"))]


def test_allocation_writes_nothing_unless_a_period_is_hot(spark, monkeypatch):
    rng = random.Random(6)
    parts = [(i, rng.choice([1, 2, None]), rng.choice([None, 202001, 202002]), D(rng.randrange(-100, 10 ** 4)) / 100) for i in range(300)]
    p = spark.createDataFrame(parts, "i int, k int, m int, w decimal(10,2)")
    for kind in ("int", "long"):                     # keys of another type are compared, not cast
        c = spark.createDataFrame([(1, 202001, D("77.77")), (None, 202002, D("-0.05")), (2, None, None), (9, 202001, D("1.00"))],
                                  f"k {kind}, m {kind}, Amount decimal(18,2)")
        got = []
        for most in (1 << 20, 10):
            monkeypatch.setattr(ordered, "KEY_MAX_ROWS", most)
            mark = ordered.materialized_mark()
            shares = allocate(p, c, ["k", "m"], "w", ["i"], "share")
            assert (ordered.materialized_mark() == mark) == (kind == "int" and most > 10)
            assert shares.dtypes == p.dtypes + [("share", "decimal(18,2)")]
            got.append({r.i: r.share for r in shares.collect()})
        assert got[0] == got[1] == by_largest_remainder([(i, (k, m), w) for i, k, m, w in parts],
                                                        [((1, 202001), D("77.77")), ((None, 202002), D("-0.05"))])


def test_most_rows_of_several_keys(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (1, 2, 5), (None, 2, 5)], "a int, b int, c int")
    assert ordered.most_rows_of(df, ["a", "c"], ["b"], ["a", "b"]) == [3, 2, 2]
    assert ordered.most_rows_of(df, ["c"], ["c"]) == [4, 4] and ordered.most_rows_of(df.limit(0), ["a"], ["b"]) == [0, 0]


def test_allocation_of_nothing(spark):
    p, c = spark.createDataFrame([], "i int, period string, w decimal(10,2)"), spark.createDataFrame([], "period string, Amount decimal(18,2)")
    assert allocate(p, c, ["period"], "w", ["i"], "share").count() == 0
    one = spark.createDataFrame([(1, "x", D("2.00"))], p.schema)
    assert [r.share for r in allocate(one, c, ["period"], "w", ["i"], "share").collect()] == [D("0.00")]


def test_finance_carries_the_period_costs(spark):
    lines = [line(i, 1, i % 3, i % 2, f"2020-0{1 + i % 2}-10", km=f"{i + 1}.00") for i in range(20)]
    trips = spark.createDataFrame([trip(i, "A") for i in range(20)], TRIPS)
    bills = spark.createDataFrame([(v, 202000 + m, D("333.33")) for v in range(3) for m in (1, 2)], "Vehicle_ID int, Month_Key int, Amount decimal(18,2)")
    pay = spark.createDataFrame([(d, 202000 + m, D("1000.01")) for d in range(2) for m in (1, 2)], "Driver_ID int, Month_Key int, Amount decimal(18,2)")
    costed = M.with_allocated_costs(spark.createDataFrame(lines, LINES), bills, pay)
    sums = M.trip_finance(trips, costed).agg(F.sum("Maintenance_Cost_INR"), F.sum("Driver_Cost_INR")).first()
    assert sums[0] == 6 * D("333.33") and sums[1] == 2 * D("1000.01") + 20 * D("10.00")


# --- what is read more than once is written -------------------------------------------------

def test_activity_is_made_once_for_its_lookups(spark, monkeypatch):
    seen = []
    with_keys = M.with_keys
    monkeypatch.setattr(M, "with_keys", lambda fact, *a: seen.append(fact) or with_keys(fact, *a))
    lines = spark.createDataFrame([line(1, 1, 7, 70, "2020-01-02"), line(1, 2, 8, 71, "2020-01-03"), line(9, 1, 7, 70, "2020-01-02")], LINES)
    places = spark.createDataFrame([(5, "A")], "Location_SKey long, Branch_ID string")
    keys = {"Location_SKey": ("Branch_ID", M.conformed("PLACE", "Branch_ID", "Location_SKey"))}
    rows = M.fact_logistics_operations(spark.createDataFrame([trip(1, "A"), trip(2, "A")], TRIPS), lines, {"Location_SKey": places}, keys).collect()
    assert [(r.DD_Trip_ID, r.Vehicle_ID, r.Location_SKey, r.Cargo_Weight_Tons, r.Trip_Duration_Hours) for r in rows] == \
        [(1, 7, 5, D("10.00"), D("48.00"))]
    assert seen[0].inputFiles()


def test_histories_read_twice_are_written(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(catalog, "dim_full", lambda spark, sf, s: unknown_member(spark, s).distinct())
    monkeypatch.setattr(catalog.fx, "stage_facttrip", lambda spark, sf: spark.range(3))

    def resolve(stg, dims, spec, load_ts):
        seen.update(dims)
        return stg.select(*[F.when(F.col("id") > 0, -1).otherwise(1).alias(d.sk) for _, d in spec.lookups])
    monkeypatch.setattr(catalog.fact_ops, "resolve_keys", resolve)
    rows = catalog.QUERIES["unknown_member"](spark, "").collect()
    assert sorted((r.Dimension, r.Orphan_Facts) for r in rows) == sorted((t, 2) for t in seen)
    assert {t for t, d in seen.items() if d.inputFiles()} == {"CUSTOMER", "PRODUCT", "VENDOR"}
    fleet = spark.createDataFrame([(1, "OWN")], "Fleet_SKey long, Ownership_Type string")
    for name in ("mart_lines", "mart_trips"):
        monkeypatch.setattr(catalog.fx, name, lambda spark, sf: None)
    monkeypatch.setattr(catalog, "_key_dims", lambda spark, sf, keys: {"Fleet_SKey": fleet})
    monkeypatch.setattr(catalog.M, "fact_fleet_utilization", lambda lines, trips, dims, keys: None)
    monkeypatch.setattr(catalog.M, "hours_by_ownership", lambda util, dim: dim)
    read = catalog.QUERIES["hours_by_ownership"](spark, "")
    assert read.inputFiles() and [tuple(r) for r in read.collect()] == [(1, "OWN")]


# --- seasons ------------------------------------------------------------------------------

def test_season_counts_gaps_as_nothing(spark):
    rows = [("coal", (2018 + y) * 100 + m, D("100.00") if m != 7 else D("400.00"), 1) for y in range(3) for m in range(1, 13) if m != 2]
    rows += [("rare", 201905, D("12.00"), 1), ("undated", None, D("5.00"), 1)]
    df = spark.createDataFrame(rows, "Commodity string, Month_Key int, Tonnage decimal(18,2), Trips long")
    got = {(r.Commodity, r.Month_Key): r for r in M.seasonal_demand(df).collect()}
    assert len(got) == 72 and got["coal", 201902].Tonnage == 0
    # a year of coal: 10 months of 100, none in February, 400 in July
    assert got["coal", 201812].Trend == D("116.67") and got["coal", 201801].Trend is None
    assert got["coal", 201907].Ratio == D("3.4286") and got["coal", 201902].Seasonal_Index == 0
    year = [got["coal", 201900 + m].Seasonal_Index for m in range(1, 13)]
    assert abs(sum(year) - 12) < D("0.001") and year[6] > 3
    assert got["rare", 201905].Trend == D("1.00") and got["rare", 201905].Ratio == 12


# --- hierarchies --------------------------------------------------------------------------

NODES = "Branch_ID string, Branch_Name string, Parent_Branch_ID string, Branch_Level string"


def test_hierarchy_of_any_depth(spark):
    rows = [(f"n{i}", f"name {i}", f"n{i - 1}" if i else None, "L") for i in range(1000)] + [("x", "x", "missing", "L"), ("y", "y", "x", "L")]
    got = {r.Branch_ID: (r.Parent_Branch_Name, r.Hub_Name) for r in M.dim_geography(spark.createDataFrame(rows, NODES)).collect()}
    assert len(got) == 1002 and got["n999"] == ("name 998", "name 0") and got["y"] == ("x", "x") and got["x"] == (None, "x")


@pytest.mark.parametrize("cycle", [["a"], ["a", "b"], ["a", "b", "c"]])
def test_cycles_are_named(spark, cycle):
    rows = [(n, n, cycle[i - 1], "L") for i, n in enumerate(cycle)] + [("ok", "ok", None, "L"), ("tail", "tail", "a", "L"), ("t2", "t2", "tail", "L")]
    with pytest.raises(ValueError) as e:
        M.dim_geography(spark.createDataFrame(rows, NODES))
    named = str(e.value).split("through ")[1].split(", ")
    assert named == sorted(cycle)


# --- customers ----------------------------------------------------------------------------

def test_customer_sites(spark):
    customers = spark.createDataFrame([(1, "Tata", "F", D("5.00")), (2, "Rungta", "M", None)],
                                      "Customer_ID int, Customer_Name string, Customer_Type string, Credit_Limit decimal(18,2)")
    sites = spark.createDataFrame([(1, 11, "gate 1", 3), (1, 12, "gate 2", 9)], "Customer_ID int, Address_ID int, Site_Name string, Nation_ID int")
    nations = spark.createDataFrame([(3, "IN", 0)], "Nation_ID int, Nation_Name string, Region_ID int")
    regions = spark.createDataFrame([(0, "ASIA")], "Region_ID int, Region_Name string")
    rows = M.dim_customer_enterprise(customers, sites, nations, regions).orderBy("Customer_SKey").collect()
    assert [(r.Customer_SKey, r.Customer_ID, r.Address_ID, r.Nation_Name, r.Region_Name) for r in rows] == [
        (1, 1, 11, "IN", "ASIA"), (2, 1, 12, None, None), (3, 2, None, None, None)]


def test_shift_rollup_of_more_microseconds_than_a_long_holds(spark):
    """2000 trips of two centuries: 1.3e19 microseconds in all."""
    from starloom.operators import shifts
    trips = spark.range(2000).select(F.expr("TIMESTAMP_NTZ'1900-01-01 00:00:00'").alias("a"), F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'").alias("b"))
    total = shifts.calendar_shift_rollup(shifts.shift_hours(trips, "a", "b")).where("Grouping_Level = 31").first()
    assert total.Trip_Hours == D(2000 * 73049 * 24)
