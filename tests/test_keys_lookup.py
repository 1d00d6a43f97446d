import datetime as dt
import random

from pyspark.sql import functions as F

from support import ts
from starloom.operators import lookup
from starloom.operators.keys import dense_key
from starloom.schemas import CUSTOMER, VENDOR


def test_dense_key_equals_row_number_with_hot_value(spark):
    rnd = random.Random(1)
    rows = [(1 if i % 2 else rnd.randint(0, 1000), rnd.randint(0, 5)) for i in range(20000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(9)
    out = dense_key(df, "k", [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()], start=100).collect()
    exp = sorted(rows)
    got = sorted(((r.a, r.b), r.k) for r in out)
    assert [k for _, k in sorted(got, key=lambda x: x[1])] == list(range(101, 100 + len(rows) + 1))
    # the k-th key carries the k-th row of the sorted order
    assert [ab for ab, _ in sorted(got, key=lambda x: x[1])] == exp


def test_dense_key_stable_under_repartitioning(spark):
    df = spark.range(5000).select((F.col("id") % 97).alias("a"), (F.col("id") % 13).alias("b"), "id")
    order = [F.col("a").asc(), F.col("b").asc(), F.col("id").asc()]
    one = {r.id: r.k for r in dense_key(df.repartition(3), "k", order).collect()}
    two = {r.id: r.k for r in dense_key(df.repartition(11), "k", order).collect()}
    assert one == two


def _dim(spark):
    rows = [(-1, -1, "u", "u", ts("1900-01-01 00:00:00"), ts("9999-12-31 00:00:00"), True),
            (1, 1, "a", "r", ts("2024-01-01 00:00:00"), ts("2024-01-31 23:59:59"), False),
            (2, 1, "b", "r", ts("2024-02-01 00:00:00"), None, True),
            (3, 2, "c", "r", ts("2024-01-01 00:00:00"), ts("2023-12-31 23:59:59"), False)]
    return spark.createDataFrame(rows, "CustomerKey long, CustomerID int, CustomerName string, Region string, "
                                       "RowStartDateTime timestamp_ntz, RowEndDateTime timestamp_ntz, IsCurrent boolean")


def test_pit_lookup_semantics_both_plans(spark):
    facts = spark.createDataFrame([
        (10, 1, ts("2024-01-15 00:00:00")), (11, 1, ts("2024-02-15 00:00:00")),
        (12, 1, ts("2024-01-31 23:59:59.500000")),   # Q10: sub-second gap -> -1
        (13, 1, None),                                 # Q20: NULL time -> -1
        (14, 2, ts("2024-01-01 00:00:00")),            # tie version (end < start) never matches
        (15, 9, ts("2024-01-01 00:00:00"))], "TripID int, CustomerID int, TripDate timestamp_ntz")
    exp = {10: 1, 11: 2, 12: -1, 13: -1, 14: -1, 15: -1}
    for strategy in ("equi", "bucketed"):
        out = lookup.lookup_scd2_pit(facts, _dim(spark), "CustomerID", "TripDate", CUSTOMER, strategy=strategy)
        assert {r.TripID: r.CustomerKey for r in out.collect()} == exp, strategy


def test_pit_lookup_hot_key_bucketed_equals_equi(spark):
    rnd = random.Random(3)
    vers = []
    k = 0
    for key in range(5):
        t = dt.datetime(2020, 1, 1)
        n = 400 if key == 0 else 5
        for _ in range(n):
            nxt = t + dt.timedelta(hours=rnd.randint(1, 200))
            k += 1
            vers.append((k, key, "n", "r", t, nxt - dt.timedelta(seconds=1), False))
            t = nxt
        vers.append((k + 1, key, "n", "r", t, None, True))
        k += 1
    dim = spark.createDataFrame(vers, _dim(spark).schema)
    facts = spark.createDataFrame(
        [(i, rnd.randint(0, 5), dt.datetime(2020, 1, 1) + dt.timedelta(hours=rnd.randint(-100, 20000))) for i in range(3000)],
        "TripID int, CustomerID int, TripDate timestamp_ntz")
    a = {r.TripID: r.CustomerKey for r in lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER, "equi").collect()}
    b = {r.TripID: r.CustomerKey for r in lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER, "bucketed").collect()}
    assert a == b
    auto = lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER)   # picks bucketed (400 versions)
    assert {r.TripID: r.CustomerKey for r in auto.collect()} == a


def test_pit_half_open_option(spark):
    facts = spark.createDataFrame([(12, 1, ts("2024-01-31 23:59:59.500000"))], "TripID int, CustomerID int, TripDate timestamp_ntz")
    for strategy in ("equi", "bucketed"):
        out = lookup.lookup_scd2_pit(facts, _dim(spark), "CustomerID", "TripDate", CUSTOMER, strategy=strategy, half_open=True)
        assert [r.CustomerKey for r in out.collect()] == [1]


def test_pit_half_open_over_the_end_of_a_month(spark):
    facts = spark.createDataFrame([(1, 1, ts("2024-02-01 00:00:00.200000")), (2, 1, ts("2024-02-01 00:00:01.200000"))],
                                  "TripID int, CustomerID int, TripDate timestamp_ntz")
    dim = _dim(spark).filter("CustomerKey = 1").withColumn("RowEndDateTime", F.lit("2024-01-31 23:59:59.5").cast("timestamp_ntz"))
    for kwargs in ({"strategy": "equi"}, {"strategy": "bucketed", "bucket": "month"}, {"strategy": "bucketed", "bucket": "day"}):
        out = lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER, half_open=True, **kwargs)
        assert {r.TripID: r.CustomerKey for r in out.collect()} == {1: 1, 2: -1}, kwargs


def test_group_of_copies_is_spread_and_exact(spark):
    """A third of the rows are copies of one row: keys and timelines stay exact, and no range
    partition gets them all."""
    import datetime as dt
    from starloom.operators import ordered, scd2
    from starloom.schemas import VENDOR
    rows = [(7, 7)] * 1000 + [(i % 50, i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    out = dense_key(df, "k", [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()]).collect()
    got = sorted((r.k, r.a, r.b) for r in out)
    assert [g[0] for g in got] == list(range(1, len(rows) + 1))
    assert [(g[1], g[2]) for g in got] == sorted(rows)

    layout = ordered.range_layout(df, [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()], num_partitions=10)
    assert max(r["count"] for r in layout.rows.groupBy(ordered.PID).count().collect()) < 600

    stg = [(1, "x", dt.datetime(2020, 1, 1))] * 300 + [(1, "y", dt.datetime(2020, 2, 1))] + [(1, "x", None)] * 120
    v = scd2.scd2_timeline(spark.createDataFrame(stg, VENDOR.staging_schema()), VENDOR, key_start=0).collect()
    by_key = {r.VendorKey: r for r in v}
    assert sorted(by_key) == list(range(1, 422))
    # 120 NULL-dated copies first: 119 stay open (current), the last ends before 2020-01-01
    nulls = [by_key[k] for k in range(1, 121)]
    assert sum(r.IsCurrent for r in nulls) == 119 and by_key[120].RowEndDateTime == dt.datetime(2019, 12, 31, 23, 59, 59)
    # 300 dated copies: 299 end one second before their own start, the last before 2020-02-01
    assert by_key[420].RowEndDateTime == dt.datetime(2020, 1, 31, 23, 59, 59)
    assert by_key[121].RowEndDateTime == dt.datetime(2019, 12, 31, 23, 59, 59)
    assert by_key[421].IsCurrent and by_key[421].VendorName == "y"


def test_pit_day_buckets_match_equi(spark):
    """Hundreds of versions of one key inside one month switch the bucketed plan to days;
    matches stay those of the plain join."""
    rnd = random.Random(5)
    vers, k, t = [], 0, dt.datetime(2021, 3, 1)
    for _ in range(300):
        nxt = t + dt.timedelta(minutes=rnd.randint(5, 120))
        k += 1
        vers.append((k, 1, "n", "r", t, nxt - dt.timedelta(seconds=1), False))
        t = nxt
    vers.append((k + 1, 1, "n", "r", t, None, True))
    dim = spark.createDataFrame(vers, _dim(spark).schema)
    facts = spark.createDataFrame(
        [(i, 1, dt.datetime(2021, 3, 1) + dt.timedelta(minutes=rnd.randint(-60, 20000))) for i in range(2000)],
        "TripID int, CustomerID int, TripDate timestamp_ntz")
    a = {r.TripID: r.CustomerKey for r in lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER, "equi").collect()}
    for bucket in ("auto", "day", "month"):
        b = lookup.lookup_scd2_pit(facts, dim, "CustomerID", "TripDate", CUSTOMER, "bucketed", bucket=bucket)
        assert {r.TripID: r.CustomerKey for r in b.collect()} == a, bucket


def test_hot_lookup_counts_the_facts_in_one_pass(spark, monkeypatch):
    def no_pass(*_):
        raise AssertionError("the facts were read for their times alone")
    day = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
    dim = spark.createDataFrame([(i, 1, f"v{i}", day(i), day(i + 1) - dt.timedelta(seconds=1) if i < 79 else None, i == 79) for i in range(80)]
                                + [(100, 2, "w", day(3), None, True)], "VendorKey long, VendorID int, VendorName string, "
                                "RowStartDateTime timestamp_ntz, RowEndDateTime timestamp_ntz, IsCurrent boolean")
    facts = spark.createDataFrame([(i, 1, day(i - 1)) for i in range(90)] + [(200, 2, day(1)), (201, 2, day(9)), (202, None, day(9)), (203, 2, None)],
                                  "TripID int, VendorID int, TripDate timestamp_ntz")
    lookups = [("VendorID", VENDOR)]
    want = sorted(map(tuple, lookup.star_lookup(facts, {"VENDOR": dim}, lookups, "TripDate", "equi").collect()), key=str)
    rows = lookup.FactRows(facts, "TripDate")
    assert rows.bounds() == (day(-1), day(88)) and rows.most("VendorID") == 90 and rows.bounds("VendorID") == (day(-1), day(88))
    monkeypatch.setattr(lookup, "time_bounds", no_pass)
    got = lookup.star_lookup(facts, {"VENDOR": dim}, lookups, "TripDate", max_broadcast_bytes=0)
    assert sorted(map(tuple, got.collect()), key=str) == want
