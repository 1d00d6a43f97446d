"""Full fact loads that look large dimensions up, and number the facts, trip by trip."""
import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import asof, fact as fact_ops, lookup, ordered, scd1, scd2
from starloom.plans import loads as L
from starloom.plans import publish as P
from starloom.schemas import FACTTRIP, SCD1_DIMS, SCD2_DIMS, STAGING_FACT_SCHEMA, VENDOR

DAY = dt.datetime(2020, 1, 1)
NOW = "2021-01-01 00:00:00"


def day(n, **more):
    return DAY + dt.timedelta(days=n, **more)


def dim_rows(spec, keys, versions):
    values = ["x"] * len(spec.attrs) if spec.table != "PRODUCT" else ["x", "y", Decimal("1.00")]
    return [(k, *values, day(10 * v + k % 3)) for k in keys for v in range(versions)]


def sources(spark, extra=None):
    rows = {s.table: dim_rows(s, range(1, 8), 3 if s.scd == 2 else 1) + (extra or {}).get(s.table, []) for s in SCD1_DIMS + SCD2_DIMS}
    return {s.table: spark.createDataFrame(rows[s.table], s.staging_schema()) for s in SCD1_DIMS + SCD2_DIMS}


def made(spark, path, extra=None):
    """The dimensions (those with ``extra`` rows, if given) as files."""
    stg = sources(spark, extra)
    out = {}
    for s in SCD1_DIMS + SCD2_DIMS:
        if not extra or s.table in extra:
            (scd1.scd1_full if s.scd == 1 else scd2.scd2_full)(stg[s.table], s).coalesce(1).write.parquet(f"{path}/{s.table}")
            out[s.table] = spark.read.parquet(f"{path}/{s.table}")
    return out


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    return made(spark, str(tmp_path_factory.mktemp("dims")))


def trips(spark, more=()):
    """Trips of some lines: missed keys, keys and times that are NULL, lines that come twice, lines
    of a trip that differ in time, times on and between the ends of versions."""
    rows = []
    for n in range(40):
        trip, k = n // 3, n % 9
        at = None if n == 11 else day(n % 25, seconds=-(n % 4 == 0))
        rows.append((trip, k, k, None if n == 5 else k, (k + 1) % 9, None if n == 7 else (k + 2) % 9, k, Decimal(n % 5), Decimal(n), at))
    return spark.createDataFrame(rows + rows[:6] + list(more), STAGING_FACT_SCHEMA).repartition(4)


def loaded(stg, dims, **bounds):
    return sorted(map(repr, fact_ops.fact_full(stg, dims, FACTTRIP, NOW, **bounds).collect()))


def exchanges_with(df, column):
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = re.split(r"\n\n+", plan)
    return sum(bool(re.match(r"\(\d+\) Exchange", b)) and f"{column}#" in b.split("Arguments")[0] for b in blocks)


def test_by_trip_gives_the_same_facts(spark, dims):
    stg = trips(spark)
    want = loaded(stg, dims)
    assert len(want) == 46 and any("VendorKey=-1" in r for r in want) and any("VendorKey=9" in r for r in want)
    assert loaded(stg, dims, max_broadcast_bytes=0) == want
    assert loaded(stg, dims, max_broadcast_bytes=0, pit_strategy="merge") == want
    assert loaded(stg, dims, max_broadcast_bytes=6 * 400) == want          # some are large
    # One time each, but that some rows of a trip have none.
    one_time = stg.withColumn("TripDate", F.when(F.col("TripDate").isNotNull(), F.min("TripDate").over(Window.partitionBy("TripID"))))
    assert loaded(one_time, dims, max_broadcast_bytes=0) == loaded(one_time, dims)


def test_whole_facts_are_shuffled_once_and_not_written(spark, dims, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    trips(spark).write.parquet(path)
    stg = spark.read.schema(STAGING_FACT_SCHEMA).parquet(path)
    seen, write = [], ordered.written
    monkeypatch.setattr(ordered, "written", lambda df, *a, **k: seen.append(df.columns) or write(df, *a, **k))
    df = fact_ops.fact_full(stg, dims, FACTTRIP, NOW, frozen=True, max_broadcast_bytes=0)
    assert exchanges_with(df, "Revenue") == 1
    assert not [c for c in seen if "Revenue" in c]


@pytest.mark.parametrize("case", ["no id", "many rows", "two versions", "key twice"])
def test_facts_that_cannot_go_by_trip(spark, dims, tmp_path, monkeypatch, case):
    """They take the way of whole rows, and nothing is multiplied or lost."""
    line = (1, 1, 1, 1, 1, 1, 1, Decimal(1), Decimal(1), day(4))
    more = {"no id": [(None, *line[1:])] * 2, "many rows": [line] * 9}.get(case, [line])
    extra = {"two versions": {"VENDOR": [(1, "a", None), (1, "b", None)]}, "key twice": {"TRUCK": [(-1, "a", "b", DAY)]}}.get(case)
    if case == "key twice":
        more = [(1, 1, 1, -1, 1, 1, 1, Decimal(1), Decimal(1), day(4))]
    monkeypatch.setattr(fact_ops, "TRIP_MAX_ROWS", 8)
    monkeypatch.setattr(fact_ops, "star_lookup_by", lambda *a, **k: pytest.fail("went by trip"))
    dims, stg = dims | (made(spark, str(tmp_path), extra) if extra else {}), trips(spark, more)
    want = loaded(stg, dims)
    assert loaded(stg, dims, max_broadcast_bytes=0) == want
    assert len(want) > 46 + len(more) if case == "two versions" else len(want) == 46 + len(more) + (case == "key twice")


def test_full_load_says_whether_versions_follow_each_other(spark, tmp_path):
    """It is known from the rows staged, so the fact load need not shuffle the versions to find out;
    an increment, which may change it, does not carry it on."""
    def load(root, rows):
        extract = lambda name, lo, hi: spark.createDataFrame(rows, VENDOR.staging_schema())     # noqa: E731
        return L.full_load_table(spark, {"TABLENAME": "VENDOR", "STAGINGTABLENAME": "vendor", "LOADTYPE": "SCD2"}, extract,
                                 str(tmp_path / root), NOW, NOW)
    rows = [(1, "a", None), (1, "b", day(1)), (1, "b", day(1)), (2, "c", dt.datetime(1850, 1, 1)), (2, "d", None)]
    for root, more, want in (("a", [], True), ("b", [(1, "e", None)], False), ("c", [(-1, "e", day(1))], False)):
        assert load(root, rows + more)["disjoint"] is want
        side = lookup.prepare_pit_side(P.read_table(spark, str(tmp_path / root), "VENDOR"), VENDOR)
        assert asof.versions_overlap(side.side, False, side.most) is not want
        assert asof.versions_overlap(side.side, True, side.most) is not want
    more = spark.createDataFrame([(1, "z", dt.datetime(1990, 1, 1))], VENDOR.staging_schema())
    root = str(tmp_path / "a")
    closed, inserted = scd2.scd2_inc_parts(P.read_table(spark, root, "VENDOR"), more, VENDOR)
    assert "disjoint" not in P.publish_scd2_increment(closed, inserted, root, VENDOR, NOW, NOW)


def test_staged_versions_are_not_written_again(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "vendors"), []
    sources(spark)["VENDOR"].write.parquet(path)
    stg, write = spark.read.schema(VENDOR.staging_schema()).parquet(path), scd2.written
    monkeypatch.setattr(scd2, "written", lambda df, *a, **k: seen.append(df.columns) or write(df, *a, **k))
    want = sorted(map(repr, scd2.scd2_full(stg, VENDOR).collect()))
    assert len(seen) == 1
    assert sorted(map(repr, scd2.scd2_full(stg, VENDOR, frozen=True).collect())) == want and len(seen) == 1
    monkeypatch.setattr(ordered, "KEY_MAX_ROWS", 2)
    assert sorted(map(repr, scd2.scd2_full(stg, VENDOR, frozen=True).collect())) == want
