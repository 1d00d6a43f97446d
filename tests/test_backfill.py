"""Year-by-year backfill, id ranges of fact months, watermarks that never go back."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from starloom import catalog as C
from starloom.operators import fact as fact_ops
from starloom.operators import scd2
from starloom.plans import backfill as B
from starloom.plans import loads as L
from starloom.plans import publish as P
from starloom.schemas import FACTTRIP, VENDOR
from starloom.sources import fixtures as fx
from support import ts

SF = "/root/testdata/sf0.001"
NOW = fx.LOAD_TS
ROW = {"TABLENAME": "VENDOR", "STAGINGTABLENAME": "vendor", "LOADTYPE": "SCD2"}


def vendor_rows(seed):
    """Several rows a year, equal dates, copies, undated rows (several of one key), year borders."""
    rng = random.Random(seed)
    days = ["2018-12-31 23:59:59.999999", "2019-01-01", "2020-05-05", "2020-05-05", "2022-02-02", "2022-12-31 23:59:59"]
    rows = [(rng.randrange(1, 9), rng.choice("abc"), ts(rng.choice(days))) for _ in range(60)]
    return rows + rows[:10] + [(1, "u", None), (1, "u", None), (1, "v", None), (77, "only undated", None), (78, "x", ts("2020-01-01"))]


def versions(df, sk="VendorKey"):
    return sorted((tuple(r) for r in df.drop(sk).collect()), key=repr)


@pytest.mark.parametrize("step", [1, 2, None])
def test_history_equals_one_full_load(spark, tmp_path, step):
    source = spark.createDataFrame(vendor_rows(step or 0), VENDOR.staging_schema())
    assert B.slices(source, "ModifiedDate") == ["undated", "2018", "2019", "2020", "2021", "2022"]
    root = str(tmp_path / "wh")
    while True:
        m = B.backfill_table(spark, ROW, source, root, "2030-01-01 00:00:00", NOW, max_slices=step)
        if m["backfill"]["complete"]:
            break
    assert m["watermark"] == "2030-01-01 00:00:00"
    got = P.read_table(spark, root, "VENDOR")
    assert versions(got) == versions(scd2.scd2_full(source, VENDOR))
    keys = [r[0] for r in got.where("VendorKey > 0").select("VendorKey").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_failed_run_goes_on_at_the_failed_year(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame(vendor_rows(9), VENDOR.staging_schema())
    root, applied = str(tmp_path / "wh"), []
    real = B._apply

    def failing(spark, kind, table, stg, old, root, watermark, now, ledger, on_null_key):
        name = ledger["backfill"]["done"][-1]
        applied.append(name)
        if name == "2020" and applied.count("2020") == 1:
            raise RuntimeError("lost")
        return real(spark, kind, table, stg, old, root, watermark, now, ledger, on_null_key)
    monkeypatch.setattr(B, "_apply", failing)
    with pytest.raises(RuntimeError):
        B.backfill_table(spark, ROW, source, root, "2030-01-01 00:00:00", NOW)
    m = P.read_manifest(spark, root, "VENDOR")
    assert m["backfill"] == {"done": ["undated", "2018", "2019"], "complete": False} and m["watermark"].startswith("2019-12-31")
    B.backfill_table(spark, ROW, source, root, "2030-01-01 00:00:00", NOW)
    assert applied == ["undated", "2018", "2019", "2020", "2020", "2021", "2022"]
    assert versions(P.read_table(spark, root, "VENDOR")) == versions(scd2.scd2_full(source, VENDOR))
    # A finished backfill starts anew; a full load has no ledger to go on from.
    applied.clear()
    B.backfill_table(spark, ROW, source, root, "2030-01-01 00:00:00", NOW, max_slices=1)
    assert applied == ["undated"]
    L.full_load_table(spark, ROW, lambda *a: source, root, "2030-01-01 00:00:00", NOW)
    assert "backfill" not in P.read_manifest(spark, root, "VENDOR")


def test_fact_by_year_equals_full(spark, tmp_path):
    root, row = str(tmp_path / "wh"), {"TABLENAME": "FACTTRIP", "LOADTYPE": "FACT"}
    L.bulk_load_all(spark, C.fixture_extractor(spark, SF), root, C.INC_CUTOFFS, NOW)
    want = P.read_table(spark, root, "FACTTRIP")
    want = sorted((tuple(r) for r in want.drop("TripFactKey").collect()), key=repr)
    source = fx.stage_facttrip(spark, SF, keep_modified=True)
    source = source.withColumn("ModifiedDate", F.when(F.col("TripID") % 11 > 0, F.col("ModifiedDate")))
    B.backfill_table(spark, row, source, root, fx.DELTA_HI, NOW, max_slices=3, restart=True)
    m = B.backfill_table(spark, row, source, root, fx.DELTA_HI, NOW)
    assert m["backfill"]["complete"] and m["backfill"]["done"][0] == "undated"
    got = P.read_table(spark, root, "FACTTRIP")
    assert sorted((tuple(r) for r in got.drop("TripFactKey").collect()), key=repr) == want
    assert got.select("TripFactKey").distinct().count() == got.count() == m["max_key"]


def test_scd1_and_empty_sources_are_refused(spark, tmp_path):
    empty = spark.createDataFrame([], VENDOR.staging_schema())
    with pytest.raises(ValueError):
        B.backfill_table(spark, ROW, empty, str(tmp_path), "2030-01-01 00:00:00", NOW)
    with pytest.raises(ValueError):
        B.backfill_table(spark, {"TABLENAME": "DRIVER", "LOADTYPE": "SCD1"}, empty, str(tmp_path), "2030-01-01 00:00:00", NOW)


# --- which months are opened --------------------------------------------------------------

def fact_rows(spark, rows):
    cols = ["CAST(id AS INT) TripID", *[f"CAST(-1 AS BIGINT) {d.sk}" for _, d in FACTTRIP.lookups],
            "CAST(id AS DECIMAL(10,2)) TripDistance", "CAST(id AS DECIMAL(18,2)) Revenue", "t AS TripDate",
            "TIMESTAMP_NTZ'2024-01-01' AS LoadDateTime", "CAST(k AS BIGINT) TripFactKey"]
    return spark.createDataFrame(rows, "k long, id int, t timestamp_ntz").selectExpr(*cols).select(*FACTTRIP.gold_columns())


def test_only_months_that_can_hold_an_id_are_opened(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    rows = [(100 * m + i, 100 * m + i, dt.datetime(2020, m, 1 + i)) for m in range(1, 13) for i in range(20)]
    m = P.publish_fact_full(fact_rows(spark, rows + [(9000, None, dt.datetime(2021, 1, 1))]), root, FACTTRIP, "2020-12-31 00:00:00", NOW)
    assert m["ids"]["202003"] == [300, 319] and m["ids"]["202101"] == [None, None]
    # Trip 305 moves to July, 50 is new, 1212 is repeated in its month; nothing lies in the other months.
    new = [(9001, 305, dt.datetime(2020, 7, 9)), (9002, 50, dt.datetime(2022, 1, 1)), (9003, 1212, dt.datetime(2020, 12, 13))]
    stg = spark.createDataFrame([(i,) for _, i, _ in new] + [(None,)], "TripID int")
    read = []
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, _real=type(spark.read).parquet, **k:
                        read.append(paths) or _real(self, *paths, **k))
    m = P.publish_fact_increment(stg, fact_rows(spark, new), root, FACTTRIP, "2021-01-01 00:00:00", NOW)
    monkeypatch.undo()
    opened = {p.rsplit("=", 1)[1] for paths in read for p in paths if "__month=" in p}
    assert m["increment"] == {"opened": ["202003", "202012"], "rewritten": ["202003", "202007", "202012", "202201"]}
    assert opened == {"202003", "202007", "202012"}
    got = {(r.TripFactKey, r.TripID, r.TripDate) for r in P.read_table(spark, root, "FACTTRIP").collect()}
    assert got == {r for r in rows if r[1] not in (305, 1212)} | set(new) | {(9000, None, dt.datetime(2021, 1, 1))}
    assert m["ids"]["202003"] == [300, 319] and m["ids"]["202007"] == [305, 719] and m["max_key"] == 9003


def test_months_without_a_recorded_range_are_opened(spark):
    ids = spark.createDataFrame([(5,)], "__id int")
    assert P.months_that_may_hold({"paths": {"1": "a", "2": "b", "3": "c"}, "ids": {"1": [1, 9], "2": [6, 9]}}, ids) == ["3", "1"]
    assert P.months_that_may_hold({"paths": {"1": "a"}}, ids) == ["1"]
    assert P.months_that_may_hold({"paths": {}, "ids": {}}, ids) == []


# --- watermarks ---------------------------------------------------------------------------

def test_watermark_never_goes_back(spark, tmp_path):
    root = str(tmp_path / "wh")
    rows = [(1, "a", ts("2023-06-01")), (2, "b", ts("2024-06-01"))]

    def extract(name, lo, hi):
        df = spark.createDataFrame(rows, VENDOR.staging_schema())
        return df if lo is None and hi is None else df.filter(fx.window_predicate("ModifiedDate", lo, hi))
    L.full_load_table(spark, ROW, extract, root, "2025-01-01 00:00:00", NOW)
    before = versions(P.read_table(spark, root, "VENDOR"), "none")
    L.inc_load_table(spark, ROW, extract, root, "2024-01-01 00:00:00", NOW)
    assert P.read_manifest(spark, root, "VENDOR")["watermark"] == "2025-01-01 00:00:00"
    L.inc_load_table(spark, ROW, extract, root, "2026-01-01 00:00:00", NOW)
    assert versions(P.read_table(spark, root, "VENDOR"), "none") == before
    L.full_load_table(spark, ROW, extract, root, "2024-01-01 00:00:00", NOW)
    assert P.read_manifest(spark, root, "VENDOR")["watermark"] == "2026-01-01 00:00:00"
    assert P.later("2024-01-01", "2023-12-31 23:00:00") == "2024-01-01"


def test_fact_stream_replaces_trips_once(spark, tmp_path):
    from starloom.streaming.landing import fact_batch_loader
    root = str(tmp_path / "wh")
    L.bulk_load_all(spark, C.fixture_extractor(spark, SF, base=True), root, C.BULK_CUTOFFS, NOW)
    dims = {s.table: P.read_table(spark, root, s.table) for _, s in FACTTRIP.lookups}
    target = P.read_table(spark, root, "FACTTRIP")
    batch = fx.stage_facttrip(spark, SF, fx.FULL_CUTOFF, fx.DELTA_HI, keep_modified=True)
    want = sorted(map(repr, fact_ops.fact_inc(target, batch, dims, FACTTRIP, NOW).collect()))
    apply = fact_batch_loader(root, FACTTRIP, NOW, "s", "ModifiedDate")
    for _ in range(2):                             # the second is a replay
        apply(batch, 0)
    m = P.read_manifest(spark, root, "FACTTRIP")
    assert sorted(map(repr, P.read_table(spark, root, "FACTTRIP").collect())) == want
    assert m["streams"] == {"s": 0} and m["watermark"] > fx.FULL_CUTOFF


def test_a_slice_leaves_the_months_that_are_there(spark, tmp_path):
    """Rows of a later slice in a month that has some stand beside them; an increment then replaces both."""
    root = str(tmp_path / "wh")
    L.bulk_load_all(spark, C.fixture_extractor(spark, SF), root, C.INC_CUTOFFS, NOW, control=C.L.control_seed(spark, "full").where("LOADTYPE <> 'FACT'"))
    row = {"TABLENAME": "FACTTRIP", "STAGINGTABLENAME": "facttrip", "LOADTYPE": "FACT"}
    source = fx.stage_facttrip(spark, SF).withColumn("ModifiedDate", F.expr("make_timestamp_ntz(2000 + pmod(TripID, 3), 1, 1, 0, 0, 0)"))
    first = B.backfill_table(spark, row, source, root, "2003-01-01 00:00:00", NOW, max_slices=1)
    last = B.backfill_table(spark, row, source, root, "2003-01-01 00:00:00", NOW)
    assert all(last["paths"][k] == v for k, v in first["paths"].items()) and len(last["paths"]) > len(first["paths"])
    assert P.read_table(spark, root, "FACTTRIP").count() == source.count()
    batch = source.where("TripID < 300").drop("ModifiedDate")
    m = L.inc_load_table(spark, row, lambda *a: batch, root, "2004-01-01 00:00:00", NOW)
    got = P.read_table(spark, root, "FACTTRIP")
    assert got.count() == source.count() and got.select("TripFactKey").distinct().count() == got.count()
    assert not [k for k in m["paths"] if k.split("+")[0] in m["increment"]["rewritten"] and "+" in k]
