import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import catalog as C
from starloom.operators import fact as fact_ops
from starloom.operators import quality as Q
from starloom.plans import control, publish as P
from starloom.schemas import CUSTOMER, FACTTRIP
from starloom.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_fixture_counts_sf001(spark):
    dims = C.dims_for_fact_full(spark, SF)
    f = fact_ops.fact_full(fx.stage_full(spark, SF, "facttrip"), dims, FACTTRIP, fx.LOAD_TS)
    n = fx.stage_full(spark, SF, "facttrip").count()
    assert f.count() == n                                   # no fan-out
    keys = [r[0] for r in f.select("TripFactKey").collect()]
    assert sorted(keys) == list(range(1, n + 1))
    assert Q.check_fk(f, dims, FACTTRIP).count() == 0
    assert Q.check_overlap(dims["CUSTOMER"], CUSTOMER).count() == 0


def test_fact_inc_twice_equals_once(spark):
    dims = C.dims_for_fact_full(spark, SF)
    stg = fx.stage_delta(spark, SF, "facttrip")
    target = fact_ops.fact_full(fx.stage_full(spark, SF, "facttrip"), dims, FACTTRIP, fx.LOAD_TS)
    once = fact_ops.fact_inc(target, stg, dims, FACTTRIP, fx.LOAD_TS)
    twice = fact_ops.fact_inc(once, stg, dims, FACTTRIP, fx.LOAD_TS)
    cols = [c for c in FACTTRIP.gold_columns() if c != "TripFactKey"]
    assert sorted(map(tuple, once.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, twice.select(*cols).collect()), key=repr)


def test_publish_failure_keeps_previous_version(spark, tmp_path):
    root = str(tmp_path / "wh")
    dim = C.dim_full(spark, SF, CUSTOMER)
    P.publish_scd2_full(dim, root, CUSTOMER, "1999-01-01 00:00:00", fx.LOAD_TS)
    before = P.read_manifest(spark, root, "CUSTOMER")
    bad = dim.withColumn("CustomerID", F.when(F.col("CustomerKey") > 5, F.raise_error(F.lit("boom")))
                         .otherwise(F.col("CustomerID")))
    with pytest.raises(Exception):
        P.publish_scd2_full(bad, root, CUSTOMER, "2002-01-01 00:00:00", fx.LOAD_TS)
    assert P.read_manifest(spark, root, "CUSTOMER") == before
    assert P.read_table(spark, root, "CUSTOMER").count() == dim.count()


def test_runner_fact_increment_rewrites_only_affected_months(spark, tmp_path):
    root = str(tmp_path / "wh")
    ex = C.fixture_extractor(spark, SF)
    from starloom.plans import loads as L
    L.bulk_load_all(spark, ex, root, C.BULK_CUTOFFS, fx.LOAD_TS)
    m1 = P.read_manifest(spark, root, "FACTTRIP")
    L.incremental_load_all(spark, ex, root, C.INC_CUTOFFS, fx.LOAD_TS)
    m2 = P.read_manifest(spark, root, "FACTTRIP")
    assert m2["watermark"] == fx.DELTA_HI and m1["watermark"] == fx.FULL_CUTOFF
    untouched = [k for k in m1["paths"] if m1["paths"][k] == m2["paths"].get(k)]
    assert 0 < len(m2["paths"])
    # months never touched by the delta keep their old folders
    assert len(untouched) + len([k for k in m2["paths"] if m2["paths"][k] != m1["paths"].get(k)]) == len(m2["paths"])
    wm = P.read_watermarks(spark, root, [r[0] for r in control.CONTROL_ROWS]).collect()
    assert len(wm) == 7


def test_control_plane(spark):
    ctl = control.control_seed(spark, "full")
    assert control.load_tiers(ctl) == [1, 2, 3]
    assert control.control_active_tier(ctl, 2).count() == 3
    assert Q.check_domain(ctl).count() == 0
    wm = control.watermark_seed(ctl)
    assert wm.count() == 7
    assert str(control.watermark_lookup(wm, "CUSTOMER")) == "1900-01-01 00:00:00"
    bad = ctl.withColumn("LOADTYPE", F.lit("SCD3"))
    assert Q.check_domain(bad).count() == 7


def test_null_business_key_fails_load(spark, tmp_path):
    from starloom.plans import loads as L
    from starloom.schemas import EMPLOYEE

    def ex(name, lo, hi):
        return spark.createDataFrame([(None, "x", "y", None)], EMPLOYEE.staging_schema())
    row = {"TABLENAME": "EMPLOYEE", "STAGINGTABLENAME": "employee", "LOADTYPE": "SCD1"}
    with pytest.raises(Q.QualityError):
        L.full_load_table(spark, row, ex, str(tmp_path / "wh"), "2024-01-01 00:00:00", fx.LOAD_TS)


def test_check_fk_reports_each_missing_key(spark):
    dims = C.dims_for_fact_full(spark, SF)
    f = fact_ops.fact_full(fx.stage_full(spark, SF, "facttrip"), dims, FACTTRIP, fx.LOAD_TS)
    broken = f.withColumn("CustomerKey", F.when(F.col("TripFactKey") <= 3, F.lit(10 ** 9)).otherwise(F.col("CustomerKey"))) \
              .withColumn("VendorKey", F.when(F.col("TripFactKey") == 1, F.lit(None)).otherwise(F.col("VendorKey")))
    bad = sorted((r.TripFactKey, r.dimension) for r in Q.check_fk(broken, dims, FACTTRIP).collect())
    assert bad == [(1, "CUSTOMER"), (1, "VENDOR"), (2, "CUSTOMER"), (3, "CUSTOMER")]


def test_streaming_loader_skips_replayed_batch(spark, tmp_path):
    from starloom.schemas import VENDOR
    from starloom.streaming.landing import dimension_batch_loader
    root = str(tmp_path / "wh")
    P.publish_scd2_full(C.dim_full(spark, SF, VENDOR), root, VENDOR, fx.FULL_CUTOFF, fx.LOAD_TS)
    apply = dimension_batch_loader(root, VENDOR, fx.LOAD_TS, stream_id="s1")
    batch = fx.stage_delta(spark, SF, "vendor")
    apply(batch, 0)
    once = P.read_manifest(spark, root, "VENDOR")
    apply(batch, 0)                                # replay after a failure: no change
    assert P.read_manifest(spark, root, "VENDOR") == once
    assert once["streams"] == {"s1": 0}


def test_restarted_stream_and_late_batch(spark, tmp_path):
    """A new stream counts from 0 again and is not a replay; a batch of old rows does not take
    the watermark back; runner loads keep the applied batch ids."""
    from starloom.plans import loads as L
    from starloom.schemas import VENDOR
    from starloom.streaming.landing import dimension_batch_loader
    root = str(tmp_path / "wh")
    P.publish_scd2_full(C.dim_base(spark, SF, VENDOR), root, VENDOR, "2001-01-01 00:00:00", fx.LOAD_TS)

    def batch(name, day):
        return spark.createDataFrame([(1, name, dt.datetime.fromisoformat(day))], VENDOR.staging_schema())
    dimension_batch_loader(root, VENDOR, fx.LOAD_TS, "one")(batch("first", "2003-01-01"), 0)
    dimension_batch_loader(root, VENDOR, fx.LOAD_TS, "two")(batch("second", "2002-06-01"), 0)
    m = P.read_manifest(spark, root, "VENDOR")
    assert m["streams"] == {"one": 0, "two": 0} and m["watermark"].startswith("2003-01-01")
    names = {r.VendorName for r in P.read_table(spark, root, "VENDOR").filter("VendorID = 1").collect()}
    assert {"first", "second"} <= names
    row = {"TABLENAME": "VENDOR", "STAGINGTABLENAME": "vendor", "LOADTYPE": "SCD2"}
    L.full_load_table(spark, row, lambda *a: fx.stage_vendor(spark, SF), root, "2004-01-01 00:00:00", fx.LOAD_TS)
    assert P.read_manifest(spark, root, "VENDOR")["streams"] == {"one": 0, "two": 0}


def test_full_load_keeps_undated_rows_and_empties_staging(spark, tmp_path):
    from starloom.plans import loads as L
    from starloom.schemas import VENDOR
    rows = [(1, "a", None), (2, "b", dt.datetime(2020, 1, 1)), (3, "c", dt.datetime(2031, 1, 1))]

    def extract(name, lo, hi):
        df = spark.createDataFrame(rows, VENDOR.staging_schema())
        return df if lo is None and hi is None else df.filter(fx.window_predicate("ModifiedDate", lo, hi))
    root = str(tmp_path / "wh")
    row = {"TABLENAME": "VENDOR", "STAGINGTABLENAME": "vendor", "LOADTYPE": "SCD2"}
    L.full_load_table(spark, row, extract, root, "2024-01-01 00:00:00", fx.LOAD_TS)
    assert {r.VendorID for r in P.read_table(spark, root, "VENDOR").collect()} == {-1, 1, 2, 3}
    assert list((tmp_path / "wh" / "_staging" / "VENDOR").iterdir()) == []


def test_unchanged_batch_writes_no_data(spark, tmp_path):
    from starloom.plans import loads as L
    from starloom.schemas import VENDOR
    root = str(tmp_path / "wh")
    row = {"TABLENAME": "VENDOR", "STAGINGTABLENAME": "vendor", "LOADTYPE": "SCD2"}
    rows = [(1, "a", dt.datetime(2020, 1, 1)), (2, "b", dt.datetime(2020, 1, 1))]
    L.full_load_table(spark, row, lambda *a: spark.createDataFrame(rows, VENDOR.staging_schema()), root,
                      "2021-01-01 00:00:00", fx.LOAD_TS)
    before = {p.name for p in (tmp_path / "wh" / "VENDOR").iterdir()}
    same = [(i, n, dt.datetime(2021, 6, 1)) for i, n, _ in rows]
    L.inc_load_table(spark, row, lambda *a: spark.createDataFrame(same, VENDOR.staging_schema()), root,
                     "2022-01-01 00:00:00", fx.LOAD_TS)
    assert {p.name for p in (tmp_path / "wh" / "VENDOR").iterdir()} == before
    assert P.read_manifest(spark, root, "VENDOR")["watermark"] == "2022-01-01 00:00:00"


def test_first_increment_own_control_and_empty_fact(spark, tmp_path):
    """An increment into an empty warehouse, tables switched off in the user's control table,
    a fact without rows, and sources read from lake files."""
    from starloom.plans import loads as L
    from starloom.schemas import VENDOR
    from starloom.sources.extract import LakeSource, lake_extractor
    lake, root = str(tmp_path / "lake"), str(tmp_path / "wh")
    fx.stage_vendor(spark, SF).write.option("header", "true").csv(f"{lake}/vendor")
    fx.stage_employee(spark, SF).write.parquet(f"{lake}/employee")
    ex = lake_extractor(spark, {"vendor": LakeSource(f"{lake}/vendor", "csv", VENDOR.staging_schema()),
                                "employee": LakeSource(f"{lake}/employee")})
    active = control.control_seed(spark, "incremental").withColumn("ISACTIVE", F.col("TABLENAME").isin("VENDOR", "EMPLOYEE"))
    done = L.incremental_load_all(spark, ex, root, "2024-01-15 00:00:00", fx.LOAD_TS, control=active)
    assert {r["TABLENAME"] for r in done} == {"VENDOR", "EMPLOYEE"}
    assert P.read_table(spark, root, "VENDOR").count() == fx.stage_vendor(spark, SF).count() + 1
    late = L.incremental_load_all(spark, ex, root, "2024-02-15 00:00:00", fx.LOAD_TS, control=active)
    assert len(late) == 2
    merged = {r.EmployeeID: r.ModifiedDate for r in P.read_table(spark, root, "EMPLOYEE").collect()}
    newest = {r[0]: r[1] for r in fx.stage_employee(spark, SF).groupBy("EmployeeID").agg(F.max("ModifiedDate")).collect()}
    assert {k: v for k, v in merged.items() if k != -1} == newest
    empty = spark.createDataFrame([], fact_base_schema(spark))
    P.publish_fact_full(empty, root, FACTTRIP, fx.FULL_CUTOFF, fx.LOAD_TS)
    assert P.read_table(spark, root, "FACTTRIP").count() == 0
    assert P.read_table(spark, root, "FACTTRIP").columns == FACTTRIP.gold_columns()


def fact_base_schema(spark):
    return C.fact_base_df(spark, SF).schema


def test_lookups_without_any_broadcast(spark):
    from starloom.operators import lookup
    dims = C.dims_for_fact_base(spark, SF)
    stg = fx.stage_full(spark, SF, "facttrip")
    keys = [d.sk for _, d in FACTTRIP.lookups]
    free = lookup.star_lookup(stg, dims, FACTTRIP.lookups, "TripDate")
    none = lookup.star_lookup(stg, dims, FACTTRIP.lookups, "TripDate", max_broadcast_bytes=0)
    sums = [F.sum(k) for k in keys] + [F.count(F.lit(1))]
    assert free.agg(*sums).first() == none.agg(*sums).first()
