"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus the DuckDB SQL that must agree.

Every query reads the driver's tables through the staging fixtures (``sources.fixtures``)
and runs the library's operators over the whole tables.
"""
from __future__ import annotations

import concurrent.futures as cf
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import fact as fact_ops
from .operators import lookup, scd1, scd2
from .operators.keys import dense_key
from .operators.ordered import written
from .schemas import (CUSTOMER, DRIVER, EMPLOYEE, FACTTRIP, OPEN_END, PRODUCT, SCD1_DIMS, SCD2_DIMS,
                      TRUCK, VENDOR, DimSpec)
from .sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared builders (Spark) --------------------------------------------------------------

def dim_full(spark, sf, spec: DimSpec, all_rows: bool = True) -> DataFrame:
    """Full load of the whole source, or of its state beneath an increment (``dim_base``)."""
    stg = fx.STAGERS[spec.staging](spark, sf) if all_rows else fx.stage_full(spark, sf, spec.staging)
    return scd1.scd1_full(stg, spec) if spec.scd == 1 else scd2.scd2_full(stg, spec, frozen=True)


def dim_base(spark, sf, spec: DimSpec) -> DataFrame:
    return dim_full(spark, sf, spec, all_rows=False)


def dim_inc(spark, sf, spec: DimSpec, target: DataFrame | None = None) -> DataFrame:
    target = target if target is not None else dim_base(spark, sf, spec)
    delta = fx.stage_delta(spark, sf, spec.staging)
    return scd1.scd1_merge(target, delta, spec) if spec.scd == 1 else scd2.scd2_inc(target, delta, spec)


def at_once(*work):
    """Results of independent pieces of work, whose Spark jobs run side by side."""
    with cf.ThreadPoolExecutor(max_workers=len(work)) as ex:
        return [f.result() for f in [ex.submit(w) for w in work]]


def _build_all(fn, specs) -> dict[str, DataFrame]:
    """Build independent dimensions concurrently (each is its own Spark jobs)."""
    return dict(zip([s.table for s in specs], at_once(*[lambda s=s: fn(s) for s in specs])))


def dims_for_fact_full(spark, sf) -> dict[str, DataFrame]:
    return _build_all(lambda s: dim_full(spark, sf, s), SCD1_DIMS + SCD2_DIMS)


def dims_for_fact_base(spark, sf) -> dict[str, DataFrame]:
    return _build_all(lambda s: dim_base(spark, sf, s), SCD1_DIMS + SCD2_DIMS)


def dims_after_inc(spark, sf, full: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every dimension after its increment; ``full`` reuses already built base loads."""
    full = full or {}
    return _build_all(lambda s: dim_inc(spark, sf, s, full.get(s.table)), SCD1_DIMS + SCD2_DIMS)


def fact_full_df(spark, sf) -> DataFrame:
    return fact_ops.fact_full(fx.stage_facttrip(spark, sf), dims_for_fact_full(spark, sf), FACTTRIP, fx.LOAD_TS)


def fact_base_df(spark, sf, dims=None) -> DataFrame:
    return fact_ops.fact_full(fx.stage_full(spark, sf, "facttrip"), dims or dims_for_fact_base(spark, sf),
                              FACTTRIP, fx.LOAD_TS)


# --- shared builders (SQL) ----------------------------------------------------------------

def dim_base_sql(spec: DimSpec) -> str:
    return dim_full_sql(spec, all_rows=False)


def dim_full_sql(spec: DimSpec, all_rows: bool = True) -> str:
    stg = O.stage_sql(spec.staging) if all_rows else O.stage_full_sql(spec.staging)
    return O.scd1_full_sql(stg, spec) if spec.scd == 1 else O.scd2_full_sql(stg, spec)


def dim_inc_sql(spec: DimSpec) -> str:
    target = dim_base_sql(spec)
    delta = O.stage_delta_sql(spec.staging)
    return O.scd1_merge_sql(target, delta, spec) if spec.scd == 1 else O.scd2_inc_sql(target, delta, spec)


def dims_for_fact_full_sql() -> dict[str, str]:
    return {s.table: dim_full_sql(s) for s in SCD1_DIMS + SCD2_DIMS}


def dims_for_fact_base_sql() -> dict[str, str]:
    return {s.table: dim_base_sql(s) for s in SCD1_DIMS + SCD2_DIMS}


def dims_after_inc_sql() -> dict[str, str]:
    return {s.table: dim_inc_sql(s) for s in SCD1_DIMS + SCD2_DIMS}


def fact_full_sql() -> str:
    return O.fact_full_sql(O.stage_sql("facttrip"), dims_for_fact_full_sql())


def fact_base_sql() -> str:
    return O.fact_full_sql(O.stage_full_sql("facttrip"), dims_for_fact_base_sql())


# --- S1 / S4: full dimension loads --------------------------------------------------------

def _reg_full(spec: DimSpec):
    name = f"scd{spec.scd}_full_{spec.staging}"
    register(name, dim_full_sql(spec))(lambda spark, sf, spec=spec: dim_full(spark, sf, spec))


for _s in SCD1_DIMS + SCD2_DIMS:
    _reg_full(_s)


# --- S2 / S3: incremental dimension loads -------------------------------------------------

def _reg_inc(spec: DimSpec):
    if spec.scd == 2:
        register(f"scd2_inc_{spec.staging}", dim_inc_sql(spec))(lambda spark, sf, spec=spec: dim_inc(spark, sf, spec))
        return
    base_sql, delta_sql = O.stage_merge_sql(spec.staging)

    def merge(spark, sf, spec=spec):
        """The delta overlaps the base: it holds new keys, newer rows and stale ones."""
        base, delta = fx.merge_windows(spec.staging)
        stager = fx.STAGERS[spec.staging]
        return scd1.scd1_merge(scd1.scd1_full(stager(spark, sf, *base), spec), stager(spark, sf, *delta), spec)
    register(f"scd1_merge_{spec.staging}", O.scd1_merge_sql(O.scd1_full_sql(base_sql, spec), delta_sql, spec))(merge)


for _s in SCD1_DIMS + SCD2_DIMS:
    _reg_inc(_s)


# --- T1 / T2: fact loads -------------------------------------------------------------------

@register("fact_full", fact_full_sql())
def q_fact_full(spark, sf):
    return fact_full_df(spark, sf)


@register("fact_inc", O.fact_inc_sql(fact_base_sql(), O.stage_delta_sql("facttrip"), dims_after_inc_sql()))
def q_fact_inc(spark, sf):
    def base(s):
        """Read for the target, the increment and what stays of the history, so histories are written."""
        dim = dim_base(spark, sf, s)
        return written(dim, "dimension") if s.scd == 2 else dim
    dims = _build_all(base, SCD1_DIMS + SCD2_DIMS)
    target, dims = at_once(lambda: fact_base_df(spark, sf, dims), lambda: dims_after_inc(spark, sf, dims))
    return fact_ops.fact_inc(target, fx.stage_delta(spark, sf, "facttrip"), dims, FACTTRIP, fx.LOAD_TS)


@register("fact_delete_matching",
          O.delete_matching_sql(fact_base_sql(), O.stage_delta_sql("facttrip")))
def q_fact_delete_matching(spark, sf):
    return fact_ops.delete_matching(fact_base_df(spark, sf), fx.stage_delta(spark, sf, "facttrip"), FACTTRIP)


# --- C1 / C3 / C4: lookups -----------------------------------------------------------------

def _lookup_one_sql(spec: DimSpec) -> str:
    stg = O.stage_sql("facttrip")
    bk = dict((d.table, b) for b, d in FACTTRIP.lookups)[spec.table]
    d = dims_for_fact_full_sql()[spec.table]
    if spec.scd == 1:
        on = f"s.{bk} = d.{spec.bk}"
    else:
        on = (f"s.{bk} = d.{spec.bk} AND s.TripDate >= d.RowStartDateTime "
              f"AND s.TripDate <= COALESCE(d.RowEndDateTime, {O.ts(OPEN_END)})")
    return (f"SELECT s.*, CAST(COALESCE(d.{spec.sk}, -1) AS BIGINT) AS {spec.sk} "
            f"FROM ({stg}) s LEFT JOIN ({d}) d ON {on}")


def _reg_lookup(spec: DimSpec):
    bk = dict((d.table, b) for b, d in FACTTRIP.lookups)[spec.table]
    name = f"lookup_scd1_{spec.staging}" if spec.scd == 1 else f"lookup_scd2_pit_{spec.staging}"

    def q(spark, sf, spec=spec, bk=bk):
        stg = fx.stage_facttrip(spark, sf)
        dim = dim_full(spark, sf, spec)
        if spec.scd == 1:
            return lookup.lookup_scd1(stg, dim, bk, spec)
        return lookup.lookup_scd2_pit(stg, dim, bk, "TripDate", spec)
    register(name, _lookup_one_sql(spec))(q)


for _s in SCD1_DIMS + SCD2_DIMS:
    _reg_lookup(_s)


@register("lookup_scd2_pit_bucketed", _lookup_one_sql(CUSTOMER))
def q_pit_bucketed(spark, sf):
    """The month-bucketed point-in-time plan, forced, on the customer lookup."""
    stg = fx.stage_facttrip(spark, sf)
    return lookup.lookup_scd2_pit(stg, dim_full(spark, sf, CUSTOMER), "CustomerID", "TripDate",
                                  CUSTOMER, strategy="bucketed")


@register("lookup_scd2_pit_merge", _lookup_one_sql(VENDOR))
def q_pit_merge(spark, sf):
    """The as-of merge, forced, on the vendors: few keys with very many versions and trips."""
    return lookup.lookup_scd2_pit(fx.stage_facttrip(spark, sf), dim_full(spark, sf, VENDOR), "VendorID", "TripDate",
                                  VENDOR, strategy="merge")


_HALF_OPEN_SQL = _lookup_one_sql(PRODUCT).replace(
    f"s.TripDate <= COALESCE(d.RowEndDateTime, {O.ts(OPEN_END)})",
    f"s.TripDate < COALESCE(d.RowEndDateTime, {O.ts(OPEN_END)}) + INTERVAL 1 SECOND")


@register("lookup_scd2_pit_half_open_bucketed",
          _HALF_OPEN_SQL.replace(f"({O.stage_sql('facttrip')}) s",
                                 f"(SELECT * REPLACE (TripDate - INTERVAL 500 MILLISECOND AS TripDate) "
                                 f"FROM ({O.stage_sql('facttrip')}) x) s"))
def q_pit_half_open_bucketed(spark, sf):
    """The half-open option under the month-bucketed plan, with trips half a second before
    midnight: at the end of a month they fall into a version's last, open second."""
    stg = fx.stage_facttrip(spark, sf).withColumn("TripDate", F.col("TripDate") - F.expr("INTERVAL 0.5 SECOND"))
    return lookup.lookup_scd2_pit(stg, dim_full(spark, sf, PRODUCT), "ProductID", "TripDate", PRODUCT,
                                  strategy="bucketed", half_open=True)


@register("lookup_scd2_pit_half_open", _HALF_OPEN_SQL)
def q_pit_half_open(spark, sf):
    """Point-in-time lookup, option: a time in the last second before the next version
    belongs to the earlier version (Q10 fixed)."""
    stg = fx.stage_facttrip(spark, sf)
    return lookup.lookup_scd2_pit(stg, dim_full(spark, sf, PRODUCT), "ProductID", "TripDate", PRODUCT,
                                  half_open=True)


@register("lookup_scd2_current",
          f"SELECT s.*, CAST(COALESCE(d.CustomerKey, -1) AS BIGINT) AS CustomerKey "
          f"FROM ({O.stage_delta_sql('customer')}) s LEFT JOIN "
          f"(SELECT * FROM ({dim_base_sql(CUSTOMER)}) c WHERE IsCurrent) d ON s.CustomerID = d.CustomerID")
def q_lookup_current(spark, sf):
    """A delta against the current versions of the load before it."""
    return lookup.lookup_scd2_current(fx.stage_delta(spark, sf, "customer"), dim_base(spark, sf, CUSTOMER),
                                      "CustomerID", CUSTOMER)


@register("star_lookup", O.star_sql(O.stage_sql("facttrip"), dims_for_fact_full_sql(), keep_staging=True))
def q_star_lookup(spark, sf):
    return lookup.star_lookup(fx.stage_facttrip(spark, sf), dims_for_fact_full(spark, sf),
                              FACTTRIP.lookups, "TripDate")


# --- A1-A5, A8: extraction ------------------------------------------------------------------

@register("extract_full", O.stage_sql("product"))
def q_extract_full(spark, sf):
    return fx.stage_product(spark, sf)


@register("full_load_null_dates", O.scd1_full_sql(
    "SELECT EmployeeID, EmployeeName, Department, CASE WHEN Department <> 'purchase' AND EmployeeID % 3 > 0 "
    f"THEN ModifiedDate END AS ModifiedDate FROM ({O.stage_sql('employee')}) e", EMPLOYEE))
def q_full_load_null_dates(spark, sf):
    """Full load of a source with rows without a change date, through the runner: none is lost."""
    from .plans import loads, publish

    def extract(name, lo, hi):
        rows = fx.stage_employee(spark, sf).withColumn(
            "ModifiedDate", F.when((F.col("Department") != "purchase") & (F.col("EmployeeID") % 3 > 0), F.col("ModifiedDate")))
        return rows if lo is None and hi is None else rows.filter(fx.window_predicate("ModifiedDate", lo, hi))
    root = _warehouse(spark)
    row = {"TABLENAME": "EMPLOYEE", "STAGINGTABLENAME": "employee", "LOADTYPE": "SCD1"}
    loads.full_load_table(spark, row, extract, root, fx.EMP_FULL_CUTOFF, fx.LOAD_TS)
    return publish.read_table(spark, root, "EMPLOYEE")


@register("extract_delta_bounded", O.stage_delta_sql("product"))
def q_extract_delta_bounded(spark, sf):
    return fx.stage_delta(spark, sf, "product")


@register("extract_delta_unbounded", O.stage_sql("customer", fx.FULL_CUTOFF, None))
def q_extract_delta_unbounded(spark, sf):
    return fx.stage_customer(spark, sf, fx.FULL_CUTOFF, None)


@register("extract_file_formats", O.stage_sql("product"))
def q_extract_file_formats(spark, sf):
    """Stage as CSV, read back through the explicit staging schema (FAILFAST)."""
    from .session import scratch_dir
    from .sources.extract import read_source
    path = scratch_dir(spark, "csv-stage")
    fx.stage_product(spark, sf).write.mode("overwrite").option("header", "true").csv(path)
    return read_source(spark, path, "csv", PRODUCT.staging_schema())


@register("stage_reload", O.stage_sql("customer"))
def q_stage_reload(spark, sf):
    """TRUNCATE + copy into a staging folder, then load from it."""
    from .session import scratch_dir
    from .sources.extract import stage
    return stage(fx.stage_customer(spark, sf), scratch_dir(spark, "stage"))


@register("backfill_by_year",
          f"SELECT *, CAST(year(ModifiedDate) AS INTEGER) AS load_year FROM "
          f"({O.stage_sql('facttrip', keep_modified=True)}) s WHERE ModifiedDate IS NOT NULL")
def q_backfill_by_year(spark, sf):
    """Year-sliced historical load written with dynamic partition overwrite, read back."""
    from .session import scratch_dir
    from .sources.extract import backfill_by_year, write_backfill
    path = scratch_dir(spark, "backfill")
    write_backfill(backfill_by_year(fx.stage_facttrip(spark, sf, keep_modified=True), "ModifiedDate"), path)
    df = spark.read.parquet(path)
    return df.withColumn("load_year", F.col("load_year").cast("int"))


# --- B2, E1, B3, B4, C5, D1, D2, E3 ----------------------------------------------------------

@register("rownum_filter", O.latest_sql(O.stage_sql("driver"), DRIVER))
def q_rownum_filter(spark, sf):
    return scd1.latest_per_key(fx.stage_driver(spark, sf), DRIVER)


@register("latest_per_key", O.latest_sql(O.stage_sql("employee"), EMPLOYEE))
def q_latest_per_key(spark, sf):
    return scd1.latest_per_key(fx.stage_employee(spark, sf), EMPLOYEE)


@register("current_rows", f"SELECT * FROM ({dim_full_sql(CUSTOMER)}) d WHERE IsCurrent")
def q_current_rows(spark, sf):
    return dim_full(spark, sf, CUSTOMER).filter(F.col("IsCurrent"))


def _changed(spark, sf, spec):
    return scd2.changed_rows(fx.stage_delta(spark, sf, spec.staging), dim_base(spark, sf, spec), spec)


def _changed_sql(spec):
    return O.changed_sql(O.stage_delta_sql(spec.staging), dim_base_sql(spec), spec)


@register("mutation_filter", _changed_sql(CUSTOMER))
def q_mutation_filter(spark, sf):
    return _changed(spark, sf, CUSTOMER)


@register("mutation_filter_chain",
          O.changed_sql(O.stage_delta_sql("customer"), dim_base_sql(CUSTOMER), CUSTOMER, chain=True))
def q_mutation_filter_chain(spark, sf):
    """Change filter, option: each row against its predecessor in the batch (Q11 fixed)."""
    return scd2.changed_rows(fx.stage_delta(spark, sf, "customer"), dim_base(spark, sf, CUSTOMER), CUSTOMER,
                             chain_compare=True)


@register("scd2_inc_chain_product",
          O.scd2_inc_sql(dim_base_sql(PRODUCT), O.stage_delta_sql("product"), PRODUCT, chain=True))
def q_scd2_inc_chain(spark, sf):
    """SCD2 increment with the chained change filter."""
    return scd2.scd2_inc(dim_base(spark, sf, PRODUCT), fx.stage_delta(spark, sf, "product"), PRODUCT,
                         chain_compare=True)


@register("scd2_first_change", O.first_change_sql(_changed_sql(PRODUCT), PRODUCT))
def q_first_change(spark, sf):
    return scd2.first_change(_changed(spark, sf, PRODUCT), PRODUCT)


@register("scd2_close_out", O.close_out_sql(dim_base_sql(VENDOR), _changed_sql(VENDOR), VENDOR))
def q_close_out(spark, sf):
    target = dim_base(spark, sf, VENDOR)
    first = scd2.first_change(_changed(spark, sf, VENDOR), VENDOR)
    return scd2.close_out(target.filter(F.col("IsCurrent")), first, VENDOR)


@register("next_watermark",
          f"SELECT 'CUSTOMER' AS TABLENAME, COALESCE(MAX(ModifiedDate), {O.ts(fx.LOAD_TS)}) AS NEXT_WATERMARK "
          f"FROM ({O.stage_delta_sql('customer')}) s")
def q_next_watermark(spark, sf):
    from .plans.control import next_watermark
    return next_watermark(fx.stage_delta(spark, sf, "customer"), "ModifiedDate", fx.LOAD_TS) \
        .select(F.lit("CUSTOMER").alias("TABLENAME"), "NEXT_WATERMARK")


@register("scd2_timeline", O.timeline_sql(O.stage_sql("vendor"), VENDOR))
def q_timeline(spark, sf):
    return scd2.scd2_timeline(fx.stage_vendor(spark, sf), VENDOR)


# --- W1: dense keys ------------------------------------------------------------------------------

@register("dense_key",
          "SELECT CAST(ROW_NUMBER() OVER (ORDER BY l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST, "
          "l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST) AS BIGINT) AS LineKey, "
          "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def q_dense_key(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dense_key(li, "LineKey", [F.col(c).asc_nulls_first() for c in li.columns])


# --- V1-V3, V5: quality checks -------------------------------------------------------------------

# A vendor history whose '/N' rows lost their change date: several open versions per vendor.
_UNDATED_SQL = O.scd2_full_sql(
    f"SELECT VendorID, VendorName, CASE WHEN VendorName NOT LIKE '%/N' THEN ModifiedDate END AS ModifiedDate "
    f"FROM ({O.stage_sql('vendor')}) v", VENDOR)


def _undated_vendors(spark, sf) -> DataFrame:
    rows = fx.stage_vendor(spark, sf)
    return scd2.scd2_full(rows.withColumn("ModifiedDate", F.when(~F.col("VendorName").like("%/N"), F.col("ModifiedDate"))), VENDOR)


@register("check_unique_bk",
          f"SELECT VendorID, COUNT(*) AS rows_per_key FROM ({_UNDATED_SQL}) d WHERE IsCurrent "
          f"GROUP BY VendorID HAVING COUNT(*) > 1")
def q_check_unique_bk(spark, sf):
    from .operators.quality import check_unique_bk
    return check_unique_bk(_undated_vendors(spark, sf), VENDOR)


_NN = ["TruckID", "TruckNumber", "ModifiedDate"]


@register("check_not_null",
          "SELECT *, COALESCE(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _NN)
          + f") AS failed_column FROM ({O.stage_sql('truck')}) s WHERE "
          + " OR ".join(f"{c} IS NULL" for c in _NN))
def q_check_not_null(spark, sf):
    from .operators.quality import check_not_null
    return check_not_null(fx.stage_truck(spark, sf), _NN)


# The raw trips against their employees, by business key: trips of employees nobody knows.
_RAW_EMPLOYEE = replace(EMPLOYEE, sk="EmployeeID")
_RAW_TRIP = replace(FACTTRIP, sk="TripID", lookups=(("EmployeeID", _RAW_EMPLOYEE),))


@register("check_fk",
          f"SELECT s.TripID, 'EMPLOYEE' AS dimension, s.EmployeeID AS missing_key FROM ({O.stage_sql('facttrip')}) s "
          f"WHERE NOT EXISTS (SELECT 1 FROM ({dim_full_sql(EMPLOYEE)}) x WHERE x.EmployeeID = s.EmployeeID)")
def q_check_fk(spark, sf):
    from .operators.quality import check_fk
    return check_fk(fx.stage_facttrip(spark, sf), {"EMPLOYEE": dim_full(spark, sf, EMPLOYEE)}, _RAW_TRIP)


@register("check_overlap",
          f"SELECT VendorKey, VendorID, RowStartDateTime, RowEndDateTime, next_key, next_start FROM ("
          f"SELECT *, LEAD(RowStartDateTime) OVER w AS next_start, LEAD(VendorKey) OVER w AS next_key "
          f"FROM ({_UNDATED_SQL}) d WINDOW w AS (PARTITION BY VendorID ORDER BY "
          f"RowStartDateTime ASC NULLS FIRST, VendorKey ASC NULLS FIRST)) x "
          f"WHERE next_start IS NOT NULL AND next_start <= COALESCE(RowEndDateTime, {O.ts(OPEN_END)})")
def q_check_overlap(spark, sf):
    from .operators.quality import check_overlap
    return check_overlap(_undated_vendors(spark, sf), VENDOR)


# --- multi-star marts (S5-S7, C8-C11, G2, D4-D10, T3-T5) -------------------------------------

from .operators import marts as M  # noqa: E402
from .schemas import CUSTOMER_DOC, DRIVER_HISTORY, FLEET_ASSET, VENDOR_DOC  # noqa: E402


def _dk(x):
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


def _fy(x, m=4):
    return f"CAST(year({x}) + CASE WHEN month({x}) >= {m} THEN 1 ELSE 0 END AS INTEGER)"


def _fq(x, m=4):
    return f"CAST(((month({x}) - {m} + 12) % 12) // 3 + 1 AS INTEGER)"


def _div_half_up(n, d):
    return (f"(CASE WHEN ({n}) < 0 THEN -1 ELSE 1 END * ((2 * ABS(CAST({n} AS BIGINT)) + ({d})) // (2 * ({d}))))")


def _scaled(units, scale, precision=18):
    return f"CAST(CAST({units} AS DECIMAL(20,0)) * CAST('{10 ** -scale:.{scale}f}' AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale}))"


def _ratio(num, den, scale=4):
    n, d = f"CAST(({num}) * 100 AS BIGINT)", f"CAST(({den}) * 100 AS BIGINT)"
    q = _div_half_up(f"{n} * {10 ** scale} * sign({d})", f"ABS({d})")
    return f"CASE WHEN {d} = 0 THEN NULL ELSE {_scaled(q, scale)} END"


@register("dim_date",
          f"SELECT {_dk('d')} AS Date_SKey, d AS Full_Date, CAST(day(d) AS INTEGER) AS Day_Of_Month, "
          f"CAST(dayofweek(d) + 1 AS INTEGER) AS Day_Of_Week, dayname(d) AS Day_Name, "
          f"CAST(weekofyear(d) AS INTEGER) AS Week_Of_Year, CAST(month(d) AS INTEGER) AS Month, "
          f"monthname(d) AS Month_Name, CAST(quarter(d) AS INTEGER) AS Quarter, CAST(year(d) AS INTEGER) AS Year, "
          f"{_fy('d')} AS Fiscal_Year, {_fq('d')} AS Fiscal_Quarter, dayofweek(d) IN (0, 6) AS Is_Weekend "
          f"FROM (SELECT CAST(g AS DATE) AS d FROM generate_series("
          f"(SELECT CAST(CAST(MIN(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders), "
          f"(SELECT CAST(CAST(MAX(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders), INTERVAL 1 DAY) t(g)) x")
def q_dim_date(spark, sf):
    return M.dim_date_from(fx.table(spark, sf, "orders"), "o_orderdate")


_NODES_SQL = ("SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS Branch_ID, r_name AS Branch_Name, "
              "CAST(NULL AS VARCHAR) AS Parent_Branch_ID, 'HUB' AS Branch_Level FROM region UNION ALL "
              "SELECT 'N' || CAST(n_nationkey AS VARCHAR), n_name, 'R' || CAST(n_regionkey AS VARCHAR), "
              "'SUB_LOCATION' FROM nation UNION ALL "
              "SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, 'N' || CAST(s_nationkey AS VARCHAR), 'SITE' FROM supplier")
_GEO_SQL = (f"WITH RECURSIVE nodes AS ({_NODES_SQL}), climb AS ("
            f"SELECT Branch_ID, Branch_Name AS Hub_Name FROM nodes WHERE Parent_Branch_ID IS NULL UNION ALL "
            f"SELECT n.Branch_ID, c.Hub_Name FROM nodes n JOIN climb c ON n.Parent_Branch_ID = c.Branch_ID) "
            f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY c.Branch_ID ASC NULLS FIRST) AS BIGINT) AS Location_SKey, "
            f"c.Branch_ID, c.Branch_Name, c.Branch_Level, c.Parent_Branch_ID, p.Branch_Name AS Parent_Branch_Name, "
            f"h.Hub_Name FROM nodes c LEFT JOIN nodes p ON c.Parent_Branch_ID = p.Branch_ID "
            f"JOIN climb h ON h.Branch_ID = c.Branch_ID")


@register("dim_geography", _GEO_SQL)
def q_dim_geography(spark, sf):
    return M.dim_geography(fx.branch_nodes(spark, sf))


def _derived_sql(expr, src, name, key):
    return (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY v ASC NULLS FIRST) AS BIGINT) AS {key}, v AS {name} "
            f"FROM (SELECT DISTINCT {expr} AS v FROM {src}) d")


_TRIP_TYPE_SQL = _derived_sql("o_orderpriority", "orders", "Trip_Type", "Trip_Type_Key")
_COMMODITY_SQL = _derived_sql("p_type", "part", "Commodity", "Commodity_Key")


@register("dim_trip_type", _TRIP_TYPE_SQL)
def q_dim_trip_type(spark, sf):
    return M.derived_dimension(fx.table(spark, sf, "orders"), "o_orderpriority", "Trip_Type", "Trip_Type_Key")


@register("dim_commodity", _COMMODITY_SQL)
def q_dim_commodity(spark, sf):
    return M.derived_dimension(fx.table(spark, sf, "part"), "p_type", "Commodity", "Commodity_Key")


_SITE = "CAST(o_custkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER)"
_CUST_ENT_SQL = (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY Customer_ID ASC NULLS FIRST, Address_ID ASC NULLS FIRST) AS BIGINT) AS Customer_SKey, * "
                 f"FROM (SELECT CAST(c_custkey AS INTEGER) AS Customer_ID, Address_ID, c_name AS Customer_Name, "
                 f"c_mktsegment AS Customer_Type, CAST(c_acctbal AS DECIMAL(18,2)) AS Credit_Limit, Site_Name, "
                 f"n_name AS Nation_Name, r_name AS Region_Name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, {_SITE} AS Address_ID, "
                 f"'GATE ' || o_orderpriority AS Site_Name FROM orders) a ON c_custkey = o_custkey "
                 f"LEFT JOIN nation ON Address_ID % 25 = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey) c")


def _cust_ent(spark, sf):
    return M.dim_customer_enterprise(*fx.customer_parts(spark, sf))


@register("dim_customer_enterprise", _CUST_ENT_SQL)
def q_dim_customer_enterprise(spark, sf):
    return _cust_ent(spark, sf)


@register("dim_fleet_asset",
          f"SELECT TruckKey AS Fleet_SKey, TruckID AS Vehicle_ID, TruckNumber AS Truck_Number, Model, "
          f"CAST(p_size AS DECIMAL(10,2)) AS Capacity_Tons, p_brand AS Permit_Class, "
          f"CAST(p_retailprice AS DECIMAL(18,2)) AS Insured_Value FROM ({dim_full_sql(TRUCK)}) t "
          f"LEFT JOIN part ON TruckID = p_partkey")
def q_dim_fleet_asset(spark, sf):
    return M.dim_fleet_asset(dim_full(spark, sf, TRUCK), fx.permits(spark, sf))


_DRV_COMP_SQL = (f"SELECT DriverKey AS Driver_SKey, DriverID AS Driver_ID, DriverName AS Driver_Name, "
                 f"LicenseNumber AS License_Number, s_nationkey AS Branch_Nation, "
                 f"TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(s_nationkey * 100 AS INTEGER)) AS License_Expiry_Date FROM ({dim_full_sql(DRIVER)}) d "
                 f"JOIN supplier ON DriverID = s_suppkey")


def _drv_comp(spark, sf):
    return M.dim_driver_compliance(dim_full(spark, sf, DRIVER), fx.licences(spark, sf))


@register("dim_driver_compliance", _DRV_COMP_SQL)
def q_dim_driver_compliance(spark, sf):
    return _drv_comp(spark, sf)


def _doc_scd2_sql(spec):
    inc = O.scd2_inc_sql(O.scd2_full_sql(O.stage_full_sql(spec.staging), spec), O.stage_delta_sql(spec.staging), spec)
    attrs = ", ".join(spec.attr_names)
    return (f"SELECT {spec.sk}, {spec.bk}, {attrs}, RowStartDateTime AS SCD_Row_Start_Date, "
            f"RowEndDateTime AS SCD_Row_End_Date, IsCurrent AS SCD_Row_Active_Flag FROM ({inc}) d")


def _doc_scd2(spark, sf, spec):
    full = scd2.scd2_full(fx.stage_full(spark, sf, spec.staging), spec)
    return M.scd2_doc_columns(scd2.scd2_inc(full, fx.stage_delta(spark, sf, spec.staging), spec), spec)


@register("scd2_fleet_asset", _doc_scd2_sql(FLEET_ASSET))
def q_scd2_fleet_asset(spark, sf):
    return _doc_scd2(spark, sf, FLEET_ASSET)


@register("scd2_driver_compliance", _doc_scd2_sql(DRIVER_HISTORY))
def q_scd2_driver_compliance(spark, sf):
    return _doc_scd2(spark, sf, DRIVER_HISTORY)


def _doc_scd1_sql(spec):
    return O.scd1_merge_sql(O.scd1_full_sql(O.stage_full_sql(spec.staging), spec),
                            O.stage_delta_sql(spec.staging), spec)


def _doc_scd1(spark, sf, spec):
    full = scd1.scd1_full(fx.stage_full(spark, sf, spec.staging), spec)
    return scd1.scd1_merge(full, fx.stage_delta(spark, sf, spec.staging), spec)


@register("scd1_vendor_doc", _doc_scd1_sql(VENDOR_DOC))
def q_scd1_vendor_doc(spark, sf):
    return _doc_scd1(spark, sf, VENDOR_DOC)


@register("scd1_customer_doc", _doc_scd1_sql(CUSTOMER_DOC))
def q_scd1_customer_doc(spark, sf):
    return _doc_scd1(spark, sf, CUSTOMER_DOC)


# How the marts' facts find their conformed keys: key -> (the fact's column, the dimension).
# A vehicle is a supplier's truck, so the vehicle's id also finds the vendor.
TRIP_KEYS = {
    "Customer_SKey": ("Address_ID", M.conformed("CUSTOMER_ENTERPRISE", "Address_ID", "Customer_SKey")),
    "Fleet_SKey": ("Vehicle_ID", M.conformed("FLEET_ASSET", "Vehicle_ID", "Fleet_SKey", 2)),
    "Driver_SKey": ("Driver_ID", M.conformed("DRIVER_COMPLIANCE", "Driver_ID", "Driver_SKey", 2)),
    "Location_SKey": ("Branch_ID", M.conformed("LOGISTICS_GEOGRAPHY", "Branch_ID", "Location_SKey")),
    "Vendor_SKey": ("Vehicle_ID", M.conformed("VENDOR_DOC", "VendorID", "Vendor_SKey")),
    "Trip_Type_Key": ("Trip_Type", M.conformed("TRIP_TYPE", "Trip_Type", "Trip_Type_Key")),
    "Commodity_Key": ("Commodity", M.conformed("COMMODITY", "Commodity", "Commodity_Key")),
}
# Key -> dimension SQL; a history dimension is joined at the fact's time.
_FLEET_SQL = O.scd2_full_sql(O.stage_sql("fleet_asset"), FLEET_ASSET)
_KEY_DIMS_SQL = {
    "Customer_SKey": _CUST_ENT_SQL, "Fleet_SKey": _FLEET_SQL,
    "Driver_SKey": O.scd2_full_sql(O.stage_sql("driver_history"), DRIVER_HISTORY), "Location_SKey": _GEO_SQL,
    "Vendor_SKey": O.scd1_full_sql(O.stage_sql("vendor"), VENDOR_DOC), "Trip_Type_Key": _TRIP_TYPE_SQL,
    "Commodity_Key": _COMMODITY_SQL}
SNAPSHOT_KEYS = ["Fleet_SKey", "Driver_SKey", "Location_SKey"]
PROFIT_KEYS = ["Customer_SKey", "Fleet_SKey", "Driver_SKey", "Location_SKey", "Vendor_SKey", "Commodity_Key"]
ACTIVITY_KEYS = ["Customer_SKey", "Fleet_SKey", "Driver_SKey", "Location_SKey", "Trip_Type_Key", "Commodity_Key"]


def _keyed_sql(base: str, keys: list[str], drop: str, time: str = "Trip_Date") -> str:
    cols, joins = [], []
    for i, k in enumerate(keys):
        column, spec = TRIP_KEYS[k]
        at = (f" AND b.{time} >= d{i}.RowStartDateTime AND b.{time} <= COALESCE(d{i}.RowEndDateTime, {O.ts(OPEN_END)})"
              if spec.scd == 2 else "")
        cols.append(f"CAST(COALESCE(d{i}.{k}, -1) AS BIGINT) AS {k}")
        joins.append(f"LEFT JOIN ({_KEY_DIMS_SQL[k]}) d{i} ON b.{column} = d{i}.{spec.bk}{at}")
    return f"SELECT b.* EXCLUDE ({drop}), {', '.join(cols)} FROM ({base}) b " + " ".join(joins)


def _fleet_dim(spark, sf):
    return scd2.scd2_full(fx.stage_fleet_asset(spark, sf), FLEET_ASSET, frozen=True)


def _key_dims(spark, sf, keys: list[str]) -> dict[str, DataFrame]:
    """The dimensions of a star, built concurrently."""
    make = {
        "Customer_SKey": lambda: _cust_ent(spark, sf),
        "Fleet_SKey": lambda: _fleet_dim(spark, sf),
        "Driver_SKey": lambda: scd2.scd2_full(fx.stage_driver_history(spark, sf), DRIVER_HISTORY, frozen=True),
        "Location_SKey": lambda: q_dim_geography(spark, sf),
        "Vendor_SKey": lambda: scd1.scd1_full(fx.stage_vendor(spark, sf), VENDOR_DOC),
        "Trip_Type_Key": lambda: q_dim_trip_type(spark, sf),
        "Commodity_Key": lambda: q_dim_commodity(spark, sf)}
    return dict(zip(keys, at_once(*[make[k] for k in keys])))


# D4 / D10 / D5 / D6 / D7 / D8 / D9

_KM = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2))"
_RUN = _scaled(f"LEAST({_div_half_up('CAST(Distance_KM_Daily * 100 AS BIGINT)', M.AVG_SPEED_KMH)}, 2400)", 2, 10)
_UTIL_SQL = (f"SELECT Date_SKey, Vehicle_ID, Driver_ID, 'N' || CAST(c_nationkey AS VARCHAR) AS Branch_ID, "
             f"CAST(d AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS Snapshot_Time, "
             f"Trips_Count_Daily, Distance_KM_Daily, {_RUN} AS Running_Hours, "
             f"CAST(CAST(24 AS DECIMAL(10,2)) - {_RUN} AS DECIMAL(10,2)) AS Idle_Hours, "
             f"{_ratio('load', f'Trips_Count_Daily * {M.CAPACITY_TONS}')} AS Load_Factor_Ratio FROM ("
             f"SELECT c.Vehicle_ID, c.d, {_dk('c.d')} AS Date_SKey, COALESCE(n, 0) AS Trips_Count_Daily, "
             f"COALESCE(km, CAST(0 AS DECIMAL(18,2))) AS Distance_KM_Daily, COALESCE(load, CAST(0 AS DECIMAL(18,2))) AS load, "
             f"LAST_VALUE(driver IGNORE NULLS) OVER w AS Driver_ID, LAST_VALUE(trip IGNORE NULLS) OVER w AS trip FROM ("
             f"SELECT Vehicle_ID, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM ("
             f"SELECT CAST(l_suppkey AS INTEGER) AS Vehicle_ID, CAST(CAST(MIN(l_shipdate) AS DATE) AS TIMESTAMP) AS lo, "
             f"CAST(CAST(MAX(l_shipdate) AS DATE) AS TIMESTAMP) AS hi FROM lineitem GROUP BY 1) v) c LEFT JOIN ("
             f"SELECT Vehicle_ID, d, COUNT(*) AS n, CAST(SUM({_KM}) AS DECIMAL(18,2)) AS km, "
             f"CAST(SUM(CAST(l_quantity AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS load, "
             f"MAX(CASE WHEN rn = 1 THEN CAST(l_partkey AS INTEGER) END) AS driver, MAX(CASE WHEN rn = 1 THEN l_orderkey END) AS trip "
             f"FROM (SELECT *, CAST(l_suppkey AS INTEGER) AS Vehicle_ID, CAST(l_shipdate AS DATE) AS d, ROW_NUMBER() OVER ("
             f"PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, "
             f"l_partkey DESC) AS rn FROM lineitem) l GROUP BY 1, 2) g ON c.Vehicle_ID = g.Vehicle_ID AND c.d = g.d "
             f"WINDOW w AS (PARTITION BY c.Vehicle_ID ORDER BY c.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) x "
             f"LEFT JOIN orders ON trip = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey")
_SNAPSHOT_SQL = ("SELECT CAST(Vehicle_ID AS VARCHAR) || '-' || CAST(Date_SKey AS VARCHAR) AS DD_Snapshot_ID, * FROM ("
                 + _keyed_sql(_UTIL_SQL, SNAPSHOT_KEYS, "Driver_ID, Branch_ID, Snapshot_Time", "Snapshot_Time") + ") k")


def _util(spark, sf):
    return M.daily_snapshot(fx.mart_lines(spark, sf), fx.mart_trips(spark, sf))


@register("fact_fleet_utilization", _SNAPSHOT_SQL)
def q_fact_fleet_utilization(spark, sf):
    return M.fact_fleet_utilization(fx.mart_lines(spark, sf), fx.mart_trips(spark, sf),
                                    _key_dims(spark, sf, SNAPSHOT_KEYS), TRIP_KEYS)


@register("hours_by_ownership",
          f"SELECT Ownership_Type, CAST(Date_SKey // 100 AS INTEGER) AS Month_Key, COUNT(*) AS Vehicle_Days, "
          f"CAST(SUM(Running_Hours) AS DECIMAL(18,2)) AS Running_Hours, CAST(SUM(Idle_Hours) AS DECIMAL(18,2)) AS Idle_Hours "
          f"FROM ({_SNAPSHOT_SQL}) u LEFT JOIN ({_FLEET_SQL}) f ON u.Fleet_SKey = f.Fleet_SKey GROUP BY 1, 2")
def q_hours_by_ownership(spark, sf):
    """Idle and running time, owned against vendor fleet, through the snapshot's fleet key."""
    dims = _key_dims(spark, sf, SNAPSHOT_KEYS)
    dims["Fleet_SKey"] = written(dims["Fleet_SKey"], "dimension")      # read twice
    util = M.fact_fleet_utilization(fx.mart_lines(spark, sf), fx.mart_trips(spark, sf), dims, TRIP_KEYS)
    return M.hours_by_ownership(util, dims["Fleet_SKey"])


@register("uptime_ratio",
          f"SELECT Vehicle_ID, Month_Key, Running_Hours, Idle_Hours, "
          f"{_ratio('Running_Hours', 'Running_Hours + Idle_Hours')} AS Uptime_Ratio FROM ("
          f"SELECT Vehicle_ID, CAST(Date_SKey // 100 AS INTEGER) AS Month_Key, "
          f"CAST(SUM(Running_Hours) AS DECIMAL(18,2)) AS Running_Hours, CAST(SUM(Idle_Hours) AS DECIMAL(18,2)) AS Idle_Hours "
          f"FROM ({_UTIL_SQL}) u GROUP BY 1, 2) g")
def q_uptime_ratio(spark, sf):
    return M.uptime_ratio(_util(spark, sf))


_P = "CAST(l_extendedprice AS DECIMAL(18,2))"
_Q = "CAST(l_quantity AS DECIMAL(10,2))"


def _allocated_sql(rows: str, costs: str, period: str, weight: str, order: str, out: str) -> str:
    """Largest remainder: ``costs`` (period columns, amount) over ``rows`` by ``weight``."""
    w = f"PARTITION BY {period}"
    return (f"SELECT * EXCLUDE (amount, w, whole, part, cents, rest, rk, remaining), "
            f"CAST(sign(amount) * (cents + CASE WHEN rk <= remaining THEN 1 ELSE 0 END) AS DECIMAL(18,0)) * CAST('0.01' AS DECIMAL(3,2)) AS {out} "
            f"FROM (SELECT *, ROW_NUMBER() OVER ({w} ORDER BY rest DESC, {order}) AS rk, "
            f"ABS(amount) - SUM(cents) OVER ({w}) AS remaining FROM (SELECT *, part // whole AS cents, part % whole AS rest FROM ("
            f"SELECT *, CASE WHEN SUM(w) OVER ({w}) = 0 THEN COUNT(*) OVER ({w}) ELSE SUM(w) OVER ({w}) END::HUGEINT AS whole, "
            f"ABS(amount) * CASE WHEN SUM(w) OVER ({w}) = 0 THEN 1 ELSE w END AS part FROM ("
            f"SELECT r.*, CAST(c.amount * 100 AS HUGEINT) AS amount, CAST({weight} * 100 AS HUGEINT) AS w "
            f"FROM ({rows}) r JOIN ({costs}) c USING ({period})) a) b) c) d")


_ROW_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus"
_MONTHS = "(SELECT DISTINCT {k}, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS mk FROM lineitem)"
_BILLS_SQL = (f"SELECT l_suppkey, mk, CAST(ABS(CAST(s_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount "
              f"FROM {_MONTHS.format(k='l_suppkey')} m JOIN supplier ON l_suppkey = s_suppkey")
_PAY_SQL = (f"SELECT l_partkey, mk, CAST(p_retailprice AS DECIMAL(18,2)) AS amount "
            f"FROM {_MONTHS.format(k='l_partkey')} m JOIN part ON l_partkey = p_partkey")
_LINES_SQL = _allocated_sql(
    _allocated_sql("SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS mk FROM lineitem",
                   _BILLS_SQL, "l_suppkey, mk", _KM, _ROW_ORDER, "maintenance"),
    _PAY_SQL, "l_partkey, mk", _Q, _ROW_ORDER, "base_pay")
_LINE_COSTS = {
    "Fuel_Cost_INR": f"{_P} * CAST(l_tax AS DECIMAL(4,2))",
    "Driver_Cost_INR": f"{_P} * CAST(l_discount AS DECIMAL(4,2)) + base_pay",
    "Maintenance_Cost_INR": "maintenance",
    "Toll_Cost_INR": f"CAST({M.TOLL_PER_STOP} AS DECIMAL(6,2))",
    "Other_Cost_INR": f"{_Q} * CAST({M.HANDLING_PER_TON} AS DECIMAL(6,2))"}
_COSTS_SQL = ("SELECT l_orderkey, " + ", ".join(f"CAST(SUM({v}) AS DECIMAL(18,2)) AS {k}" for k, v in _LINE_COSTS.items())
              + f" FROM ({_LINES_SQL}) l GROUP BY l_orderkey")
_TOTALS_SQL = (f"SELECT l_orderkey, CAST(SUM({_Q}) AS DECIMAL(18,2)) AS Weight, "
               f"CAST(SUM(CAST({_P} * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS Distance, "
               f"MAX(l_shipdate) AS Delivered, MAX(CASE WHEN rn = 1 THEN CAST(l_suppkey AS INTEGER) END) AS Vehicle_ID, "
               f"MAX(CASE WHEN rn = 1 THEN CAST(l_partkey AS INTEGER) END) AS Driver_ID, "
               f"MAX(CASE WHEN rn = 1 THEN p_type END) AS Commodity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey "
               f"ORDER BY l_linenumber, l_suppkey, l_partkey) AS rn FROM lineitem LEFT JOIN part ON l_partkey = p_partkey) l "
               f"GROUP BY l_orderkey")
_Z = "CAST(0 AS DECIMAL(18,2))"
_FINANCE_SQL = (f"SELECT *, CAST(Gross_Revenue_INR - (" + " + ".join(M.COST_COLS) + ") AS DECIMAL(18,2)) AS Net_Profit_INR "
                f"FROM (SELECT o_orderkey AS DD_Trip_ID, {_dk('o_orderdate')} AS Date_SKey, "
                f"CAST(o_custkey AS INTEGER) AS Customer_ID, {_SITE} AS Address_ID, CAST(o_totalprice AS DECIMAL(18,2)) AS Gross_Revenue_INR, "
                + ", ".join(f"COALESCE(k.{c}, {_Z}) AS {c}" for c in M.COST_COLS)
                + f", o_orderdate AS Trip_Date, c.Vehicle_ID, c.Driver_ID, 'N' || CAST(c_nationkey AS VARCHAR) AS Branch_ID, c.Commodity "
                f"FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN ({_TOTALS_SQL}) c ON o_orderkey = c.l_orderkey "
                f"LEFT JOIN ({_COSTS_SQL}) k ON o_orderkey = k.l_orderkey) p")


def _costed_lines(spark, sf):
    return M.with_allocated_costs(fx.mart_lines(spark, sf), fx.maintenance_bills(spark, sf), fx.base_pay(spark, sf))


def _finance(spark, sf):
    return M.trip_finance(fx.mart_trips(spark, sf), _costed_lines(spark, sf))


@register("fact_operational_profitability",
          _keyed_sql(_FINANCE_SQL, PROFIT_KEYS, "Trip_Date, Address_ID, Vehicle_ID, Driver_ID, Branch_ID, Commodity"))
def q_fact_operational_profitability(spark, sf):
    lines, dims = at_once(lambda: _costed_lines(spark, sf), lambda: _key_dims(spark, sf, PROFIT_KEYS))
    return M.fact_operational_profitability(fx.mart_trips(spark, sf), lines, dims, TRIP_KEYS)


@register("allocated_costs",
          f"SELECT l_orderkey AS Trip_ID, l_linenumber AS Line_No, CAST(l_suppkey AS INTEGER) AS Vehicle_ID, "
          f"CAST(l_partkey AS INTEGER) AS Driver_ID, mk AS Month_Key, maintenance AS Maintenance_Share, base_pay AS Base_Pay_Share "
          f"FROM ({_LINES_SQL}) l")
def q_allocated_costs(spark, sf):
    """Monthly maintenance by kilometres and base pay by tons, to the cent, on every trip line."""
    return _costed_lines(spark, sf).select(
        "Trip_ID", "Line_No", "Vehicle_ID", "Driver_ID", (F.year("Delivered") * 100 + F.month("Delivered")).alias("Month_Key"),
        "Maintenance_Share", "Base_Pay_Share")


_OWN = "CASE WHEN l_linestatus = 'F' THEN 'OWN' ELSE 'VENDOR' END"


@register("trip_profit_by",
          f"SELECT *, CAST(Revenue - Cost AS DECIMAL(18,2)) AS Margin, "
          f"{_ratio('CAST(Revenue - Cost AS DECIMAL(18,2))', 'Revenue')} AS Margin_Pct FROM ("
          f"SELECT p_type AS Commodity, {_OWN} AS Ownership_Type, o_orderpriority AS Trip_Type, "
          f"COUNT(DISTINCT l_orderkey) AS Trips, CAST(SUM({_P}) AS DECIMAL(18,2)) AS Revenue, "
          f"CAST(SUM({' + '.join(_LINE_COSTS.values())}) AS DECIMAL(18,2)) AS Cost "
          f"FROM ({_LINES_SQL}) l LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3) g")
def q_trip_profit_by(spark, sf):
    return M.trip_profit_by(_costed_lines(spark, sf), fx.mart_trips(spark, sf))


def _li_orders(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey)


@register("calendar_rollup",
          f"SELECT Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date, "
          f"GROUPING(Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date) AS Grouping_Level, COUNT(*) AS Trips, "
          f"CAST(SUM({_P}) AS DECIMAL(18,2)) AS Revenue FROM (SELECT {_fy('d')} AS Fiscal_Year, {_fq('d')} AS Fiscal_Quarter, "
          f"CAST(year(d) * 100 + month(d) AS INTEGER) AS Month_Key, d AS Full_Date, l_extendedprice FROM "
          f"(SELECT CAST(o_orderdate AS DATE) AS d, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a) b "
          f"GROUP BY ROLLUP(Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date)")
def q_calendar_rollup(spark, sf):
    return M.calendar_rollup(_li_orders(spark, sf), "o_orderdate", "l_extendedprice")


@register("calendar_week_rollup",
          f"SELECT ISO_Year, Week_Of_Year, Full_Date, GROUPING(ISO_Year, Week_Of_Year, Full_Date) AS Grouping_Level, "
          f"COUNT(*) AS Trips, CAST(SUM({_P}) AS DECIMAL(18,2)) AS Revenue FROM (SELECT CAST(isoyear(d) AS INTEGER) AS ISO_Year, "
          f"CAST(weekofyear(d) AS INTEGER) AS Week_Of_Year, d AS Full_Date, l_extendedprice FROM "
          f"(SELECT CAST(o_orderdate AS DATE) AS d, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a) b "
          f"GROUP BY ROLLUP(ISO_Year, Week_Of_Year, Full_Date)")
def q_calendar_week_rollup(spark, sf):
    return M.calendar_week_rollup(_li_orders(spark, sf), "o_orderdate", "l_extendedprice")


@register("drill_across",
          f"SELECT COALESCE(u.Month_Key, p.Month_Key) AS Month_Key, Vehicle_Trips, Distance_KM, Running_Hours, "
          f"Billed_Trips, Gross_Revenue_INR, Net_Profit_INR FROM "
          f"(SELECT CAST(Date_SKey // 100 AS INTEGER) AS Month_Key, CAST(SUM(Trips_Count_Daily) AS BIGINT) AS Vehicle_Trips, "
          f"CAST(SUM(Distance_KM_Daily) AS DECIMAL(18,2)) AS Distance_KM, CAST(SUM(Running_Hours) AS DECIMAL(18,2)) AS Running_Hours "
          f"FROM ({_UTIL_SQL}) x GROUP BY 1) u FULL OUTER JOIN "
          f"(SELECT CAST(Date_SKey // 100 AS INTEGER) AS Month_Key, COUNT(*) AS Billed_Trips, "
          f"CAST(SUM(Gross_Revenue_INR) AS DECIMAL(18,2)) AS Gross_Revenue_INR, CAST(SUM(Net_Profit_INR) AS DECIMAL(18,2)) AS Net_Profit_INR "
          f"FROM ({_FINANCE_SQL}) y GROUP BY 1) p ON u.Month_Key = p.Month_Key")
def q_drill_across(spark, sf):
    return M.drill_across(_util(spark, sf), _finance(spark, sf))


@register("volume_by_commodity",
          f"SELECT p_type AS Commodity, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS Month_Key, "
          f"CAST(SUM({_Q}) AS DECIMAL(18,2)) AS Tonnage, COUNT(DISTINCT l_orderkey) AS Trips "
          f"FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def q_volume_by_commodity(spark, sf):
    return M.volume_by_commodity(fx.mart_lines(spark, sf))


_VOLUME_SQL = ORACLE["volume_by_commodity"]


@register("seasonal_demand",
          f"WITH v AS ({_VOLUME_SQL}), m AS (SELECT Commodity, (Month_Key // 100) * 12 + Month_Key % 100 - 1 AS m, Tonnage FROM v), "
          f"spine AS (SELECT Commodity, unnest(range((SELECT MIN(m) FROM m), (SELECT MAX(m) FROM m) + 1)) AS m "
          f"FROM (SELECT DISTINCT Commodity FROM m) c), "
          f"dense AS (SELECT s.Commodity, s.m, COALESCE(m.Tonnage, CAST(0 AS DECIMAL(18,2))) AS Tonnage FROM spine s "
          f"LEFT JOIN m ON s.Commodity IS NOT DISTINCT FROM m.Commodity AND s.m = m.m), "
          f"trend AS (SELECT *, CASE WHEN COUNT(*) OVER wide = 13 THEN CAST(SUM(Tonnage) OVER wide + SUM(Tonnage) OVER narrow "
          f"AS DECIMAL(18,2)) END AS t24 FROM dense WINDOW wide AS (PARTITION BY Commodity ORDER BY m RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING), "
          f"narrow AS (PARTITION BY Commodity ORDER BY m RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING)), "
          f"ratio AS (SELECT *, CASE WHEN t24 IS NOT NULL THEN {_scaled(_div_half_up('CAST(t24 * 100 AS BIGINT)', 24), 2)} END AS Trend, "
          f"{_ratio('Tonnage * 24', 't24')} AS Ratio FROM trend), "
          f"raw AS (SELECT Commodity, m % 12 + 1 AS moy, CASE WHEN COUNT(Ratio) > 0 THEN "
          f"{_scaled(_div_half_up('CAST(SUM(Ratio) * 10000 AS BIGINT)', 'COUNT(Ratio)'), 4)} END AS raw FROM ratio GROUP BY 1, 2), "
          f"idx AS (SELECT *, CASE WHEN SUM(raw) OVER w > 0 AND raw IS NOT NULL THEN "
          f"{_scaled(_div_half_up('CAST(raw * 10000 AS BIGINT) * COUNT(raw) OVER w * 10000', 'CAST(SUM(raw) OVER w * 10000 AS BIGINT)'), 4)} "
          f"END AS Seasonal_Index FROM raw WINDOW w AS (PARTITION BY Commodity)) "
          f"SELECT r.Commodity, CAST((r.m // 12) * 100 + r.m % 12 + 1 AS INTEGER) AS Month_Key, Tonnage, Trend, Ratio, Seasonal_Index "
          f"FROM ratio r JOIN idx i ON r.Commodity IS NOT DISTINCT FROM i.Commodity AND r.m % 12 + 1 = i.moy")
def q_seasonal_demand(spark, sf):
    """Monthly tonnage against its centred trend, and the seasonal index of each calendar month."""
    return M.seasonal_demand(M.volume_by_commodity(fx.mart_lines(spark, sf)))


def _hours_sql(us):
    return _scaled(_div_half_up(f"(CAST({us} AS BIGINT) // 1000000) * 100", 3600), 2)


_TRIP_ENDS_SQL = ("SELECT o_orderkey, o_orderdate AS a, MAX(l_shipdate) AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey "
                  "GROUP BY 1, 2")
# Every trip cut at 06:00, 18:00 and midnight: a row for each stretch of a day it touches.
_PIECES_SQL = (f"SELECT o_orderkey, d, shift, date_diff('microsecond', GREATEST(a, lo), LEAST(b, hi)) AS us FROM ("
               f"SELECT *, CAST(d AS TIMESTAMP) + to_hours(h) AS lo, CAST(d AS TIMESTAMP) + to_hours(k) AS hi FROM ("
               f"SELECT *, CAST(unnest(generate_series(CAST(CAST(a AS DATE) AS TIMESTAMP), CAST(CAST(b AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d "
               f"FROM ({_TRIP_ENDS_SQL}) t WHERE a <= b) e, (VALUES (0, 6, 'NIGHT'), (6, 18, 'DAY'), (18, 24, 'NIGHT')) s(h, k, shift)) p "
               f"WHERE lo < b AND hi > a")


@register("trip_shift_hours",
          f"SELECT o_orderkey AS DD_Trip_ID, {_dk('a')} AS Date_SKey, Total_Hours, Day_Hours, "
          f"CAST(Total_Hours - Day_Hours AS DECIMAL(18,2)) AS Night_Hours FROM (SELECT t.o_orderkey, a, "
          f"CASE WHEN a <= b THEN {_hours_sql('date_diff(' + chr(39) + 'microsecond' + chr(39) + ', a, b)')} END AS Total_Hours, "
          f"CASE WHEN a <= b THEN {_hours_sql('COALESCE(day_us, 0)')} END AS Day_Hours FROM ({_TRIP_ENDS_SQL}) t LEFT JOIN ("
          f"SELECT o_orderkey, SUM(us) AS day_us FROM ({_PIECES_SQL}) x WHERE shift = 'DAY' GROUP BY 1) y ON t.o_orderkey = y.o_orderkey) z")
def q_trip_shift_hours(spark, sf):
    """How each trip's hours divide into day and night."""
    return M.trip_shift_hours(fx.mart_trips(spark, sf), fx.mart_lines(spark, sf))


@register("calendar_shift_rollup",
          f"SELECT Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date, Shift, "
          f"GROUPING(Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date, Shift) AS Grouping_Level, {_hours_sql('SUM(us)')} AS Trip_Hours "
          f"FROM (SELECT {_fy('d')} AS Fiscal_Year, {_fq('d')} AS Fiscal_Quarter, CAST(year(d) * 100 + month(d) AS INTEGER) AS Month_Key, "
          f"d AS Full_Date, shift AS Shift, COALESCE(us, 0) AS us FROM (SELECT c.d, c.shift, x.us FROM (SELECT * FROM ("
          f"SELECT CAST(unnest(generate_series((SELECT MIN(CAST(CAST(a AS DATE) AS TIMESTAMP)) FROM ({_TRIP_ENDS_SQL}) t WHERE a <= b), "
          f"(SELECT MAX(CAST(CAST(b AS DATE) AS TIMESTAMP)) FROM ({_TRIP_ENDS_SQL}) t WHERE a <= b), INTERVAL 1 DAY)) AS DATE) AS d) e "
          f"CROSS JOIN (VALUES ('DAY'), ('NIGHT')) v(shift)) c LEFT JOIN ({_PIECES_SQL}) x ON c.d = x.d AND c.shift = x.shift) y) z "
          f"GROUP BY ROLLUP(Fiscal_Year, Fiscal_Quarter, Month_Key, Full_Date, Shift)")
def q_calendar_shift_rollup(spark, sf):
    """Hours on the road down to day and night of every date."""
    from .operators import shifts
    lines = fx.mart_lines(spark, sf).groupBy("Trip_ID").agg(F.max("Delivered").alias("Delivered"))
    trips = fx.mart_trips(spark, sf).select("Trip_ID", "Trip_Date").join(lines, "Trip_ID")
    return shifts.calendar_shift_rollup(shifts.shift_hours(trips, "Trip_Date", "Delivered"))


@register("dim_date_shift",
          f"SELECT CAST({_dk('d')} AS BIGINT) * 10 + n AS Shift_SKey, {_dk('d')} AS Date_SKey, shift AS Shift, "
          f"CAST(d AS TIMESTAMP) + to_hours(h) AS Starts_At, CAST(d AS TIMESTAMP) + to_hours(k) AS Ends_At "
          f"FROM (SELECT DISTINCT Full_Date AS d FROM ({ORACLE['dim_date']}) x) y, "
          f"(VALUES (1, 0, 6, 'NIGHT'), (2, 6, 18, 'DAY'), (3, 18, 24, 'NIGHT')) s(n, h, k, shift)")
def q_dim_date_shift(spark, sf):
    from .operators import shifts
    return shifts.dim_date_shift(q_dim_date(spark, sf))


_DURATION = _scaled(_div_half_up("date_diff('second', o_orderdate, Delivered) * 100", 3600), 2)
_ACTIVITY_SQL = (f"SELECT o_orderkey AS DD_Trip_ID, {_dk('o_orderdate')} AS Date_SKey, CAST(o_custkey AS INTEGER) AS Customer_ID, "
                 f"{_SITE} AS Address_ID, t.Vehicle_ID, o_orderdate AS Trip_Date, t.Driver_ID, 'N' || CAST(c_nationkey AS VARCHAR) AS Branch_ID, "
                 f"o_orderpriority AS Trip_Type, t.Commodity, t.Weight AS Cargo_Weight_Tons, t.Distance AS Trip_Distance_KM, "
                 f"{_DURATION} AS Trip_Duration_Hours FROM orders JOIN ({_TOTALS_SQL}) t ON o_orderkey = t.l_orderkey "
                 f"LEFT JOIN customer ON o_custkey = c_custkey")
_LOGI_SQL = _keyed_sql(_ACTIVITY_SQL, ACTIVITY_KEYS, "Trip_Date, Address_ID, Driver_ID, Branch_ID, Trip_Type, Commodity")


def _logistics(spark, sf):
    return M.fact_logistics_operations(fx.mart_trips(spark, sf), fx.mart_lines(spark, sf),
                                       _key_dims(spark, sf, ACTIVITY_KEYS), TRIP_KEYS)


@register("fact_logistics_operations", _LOGI_SQL)
def q_fact_logistics_operations(spark, sf):
    return _logistics(spark, sf)


DRILL_TRIP_ID = 7   # the trip a drill-through report opens


@register("trip_drill_through", f"SELECT * FROM ({_LOGI_SQL}) f WHERE DD_Trip_ID = {DRILL_TRIP_ID}")
def q_trip_drill_through(spark, sf):
    """Degenerate-dimension drill-through: the activity of one trip."""
    return _logistics(spark, sf).filter(F.col("DD_Trip_ID") == DRILL_TRIP_ID)


@register("licence_expiry_check",
          f"SELECT s.TripID, s.DriverID, s.TripDate, d.License_Number, d.License_Expiry_Date "
          f"FROM ({O.stage_sql('facttrip')}) s JOIN ({_DRV_COMP_SQL}) d "
          f"ON s.DriverID = d.Driver_ID "
          f"WHERE s.TripDate > d.License_Expiry_Date")
def q_licence_expiry_check(spark, sf):
    """All trips against the licences of all drivers."""
    return M.licence_expiry_check(fx.stage_facttrip(spark, sf), _drv_comp(spark, sf))


# --- W3-W5: publishing, watermarks, the tier runner ------------------------------------------

from .plans import loads as L  # noqa: E402
from .plans import publish as P  # noqa: E402

# Per-table cutoffs of the fixture runs: the watermarks they leave.
BULK_CUTOFFS = {"EMPLOYEE": fx.EMP_FULL_CUTOFF, **{t: fx.FULL_CUTOFF for t in
                ("DRIVER", "TRUCK", "CUSTOMER", "PRODUCT", "VENDOR", "FACTTRIP")}}
INC_CUTOFFS = {"EMPLOYEE": fx.EMP_DELTA_HI, **{t: fx.DELTA_HI for t in
               ("DRIVER", "TRUCK", "CUSTOMER", "PRODUCT", "VENDOR", "FACTTRIP")}}


def fixture_extractor(spark, sf, base: bool = False) -> L.Extractor:
    """Bind the staging fixtures to the runner's ``extract(name, lo, hi)`` contract; with
    ``base`` the source is in its state beneath the increment when a full load reads it."""
    def extract(name, lo, hi):
        if base and lo is None and hi is None:
            return fx.stage_full(spark, sf, name)
        return fx.STAGERS[name](spark, sf, lo, hi)
    return extract


def _warehouse(spark):
    from .session import scratch_dir
    return scratch_dir(spark, "warehouse")


@register("bulk_load_all", fact_full_sql())
def q_bulk_load_all(spark, sf):
    """Full run of all seven tables through the control table; returns the published fact."""
    root = _warehouse(spark)
    L.bulk_load_all(spark, fixture_extractor(spark, sf), root, INC_CUTOFFS, fx.LOAD_TS)
    return P.read_table(spark, root, "FACTTRIP")


def _run_both(spark, sf) -> str:
    root = _warehouse(spark)
    ex = fixture_extractor(spark, sf, base=True)
    L.bulk_load_all(spark, ex, root, BULK_CUTOFFS, fx.LOAD_TS)
    L.incremental_load_all(spark, ex, root, INC_CUTOFFS, fx.LOAD_TS)
    return root


_INC_FACT_SQL = O.fact_inc_sql(fact_base_sql(), O.stage_delta_sql("facttrip"), dims_after_inc_sql())


@register("incremental_load_all", _INC_FACT_SQL)
def q_incremental_load_all(spark, sf):
    """Full run, then the incremental run from the stored watermarks; returns the fact."""
    return P.read_table(spark, _run_both(spark, sf), "FACTTRIP")


@register("incremental_load_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS TABLENAME, COUNT(*) AS Row_Count, CAST(SUM({k}) AS BIGINT) AS Key_Sum, "
    f"CAST(SUM({v}) AS BIGINT) AS Id_Sum FROM ({q}) x"
    for t, k, v, q in [*((d.table, d.sk, d.bk, dim_inc_sql(d)) for d in SCD1_DIMS + SCD2_DIMS),
                       ("FACTTRIP", FACTTRIP.sk, FACTTRIP.id_col, _INC_FACT_SQL)]))
def q_incremental_load_tables(spark, sf):
    """Rows, surrogate key sum and id sum of all seven tables after both runs."""
    root, out = _run_both(spark, sf), None
    for t, k, v in [*((d.table, d.sk, d.bk) for d in SCD1_DIMS + SCD2_DIMS), ("FACTTRIP", FACTTRIP.sk, FACTTRIP.id_col)]:
        one = P.read_table(spark, root, t).agg(F.count(F.lit(1)).alias("Row_Count"), F.sum(k).alias("Key_Sum"),
                                               F.sum(v).alias("Id_Sum")).withColumn("TABLENAME", F.lit(t))
        out = one if out is None else out.unionByName(one)
    return out


@register("publish", dim_inc_sql(CUSTOMER))
def q_publish(spark, sf):
    """Publish a full SCD2 version, then an increment (history append-only), read back."""
    root = _warehouse(spark)
    P.publish_scd2_full(dim_base(spark, sf, CUSTOMER), root, CUSTOMER, fx.FULL_CUTOFF, fx.LOAD_TS)
    target = P.read_table(spark, root, "CUSTOMER")
    closed, inserted = scd2.scd2_inc_parts(target, fx.stage_delta(spark, sf, "customer"), CUSTOMER,
                                           base=P.read_manifest(spark, root, "CUSTOMER")["max_key"])
    P.publish_scd2_increment(closed, inserted, root, CUSTOMER, fx.DELTA_HI, fx.LOAD_TS)
    return P.read_table(spark, root, "CUSTOMER")


@register("watermark_advance",
          f"SELECT 'CUSTOMER' AS TABLENAME, MAX(ModifiedDate) AS LAST_WATERMARK_DATE, "
          f"{O.ts(fx.LOAD_TS)} AS LAST_UPDATETIME FROM ({O.stage_sql('customer')}) s")
def q_watermark_advance(spark, sf):
    """Full load, then an increment up to the newest change in the source; the watermark table."""
    from .plans.control import next_watermark
    root = _warehouse(spark)
    ex = fixture_extractor(spark, sf, base=True)
    row = {"TABLENAME": "CUSTOMER", "STAGINGTABLENAME": "customer", "LOADTYPE": "SCD2"}
    L.full_load_table(spark, row, ex, root, fx.FULL_CUTOFF, fx.LOAD_TS)
    newest = next_watermark(fx.stage_customer(spark, sf, fx.FULL_CUTOFF), "ModifiedDate", fx.LOAD_TS).first()[0]
    L.inc_load_table(spark, row, ex, root, str(newest), fx.LOAD_TS)
    return P.read_watermarks(spark, root, ["CUSTOMER"])


# Without surrogate keys, which a backfill gives out slice by slice.
@register("backfill_scd2_history",
          f"SELECT * EXCLUDE (CustomerKey) FROM ({dim_full_sql(CUSTOMER)}) d")
def q_backfill_scd2_history(spark, sf):
    """The customer history loaded a year at a time, in three runs that go on from each other."""
    from .plans.backfill import backfill_table
    root, row = _warehouse(spark), {"TABLENAME": "CUSTOMER", "LOADTYPE": "SCD2"}
    for n in (2, 3, None):
        backfill_table(spark, row, fx.stage_customer(spark, sf), root, fx.DELTA_HI, fx.LOAD_TS, max_slices=n)
    return P.read_table(spark, root, "CUSTOMER").drop("CustomerKey")


@register("backfill_fact_history", f"SELECT * EXCLUDE (TripFactKey) FROM ({fact_full_sql()}) f")
def q_backfill_fact_history(spark, sf):
    """The trip fact loaded a year of change dates at a time, over fully loaded dimensions."""
    from .plans.backfill import backfill_table
    from .plans.control import control_seed
    root, row = _warehouse(spark), {"TABLENAME": "FACTTRIP", "LOADTYPE": "FACT"}
    L.bulk_load_all(spark, fixture_extractor(spark, sf), root, INC_CUTOFFS, fx.LOAD_TS,
                    control=control_seed(spark, "full").where("LOADTYPE <> 'FACT'"))
    source = fx.stage_facttrip(spark, sf, keep_modified=True)
    for n in (4, None):
        backfill_table(spark, row, source, root, fx.DELTA_HI, fx.LOAD_TS, max_slices=n)
    return P.read_table(spark, root, "FACTTRIP").drop("TripFactKey")


# --- streaming form of the increments (file landing -> foreachBatch) --------------------------

LANDING_YEARS = (1999, 2000, 2001)


def _year_window(y):
    lo = fx.FULL_CUTOFF if y == LANDING_YEARS[0] else f"{y - 1}-12-31 23:59:59.999999"
    return lo, (fx.DELTA_HI if y == LANDING_YEARS[-1] else f"{y}-12-31 23:59:59.999999")


def _streamed_sql(spec):
    q = dim_base_sql(spec)
    for y in LANDING_YEARS:
        lo, hi = _year_window(y)
        q = O.scd2_inc_sql(q, O.stage_sql(spec.staging, lo, hi), spec)
    return q


@register("streaming_scd2_increments", _streamed_sql(CUSTOMER))
def q_streaming_scd2_increments(spark, sf):
    """Full load, then the delta landed as one file set per year; each arrival is one run of
    the Structured Streaming query, which goes on from its checkpoint."""
    from .session import scratch_dir
    from .streaming.landing import dimension_batch_loader, run_landing_stream
    root = _warehouse(spark)
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    P.publish_scd2_full(dim_base(spark, sf, CUSTOMER), root, CUSTOMER, fx.FULL_CUTOFF, fx.LOAD_TS)
    load = dimension_batch_loader(root, CUSTOMER, fx.LOAD_TS, stream_id=checkpoint)
    for y in LANDING_YEARS:
        lo, hi = _year_window(y)
        fx.stage_customer(spark, sf, lo, hi).write.parquet(f"{landing}/arrival_{y}")
        run_landing_stream(spark, landing, CUSTOMER.staging_schema(), load, checkpoint)
    return P.read_table(spark, root, "CUSTOMER")


def _fact_arrivals():
    return [(fx.FULL_CUTOFF, "1999-12-31 23:59:59.999999"), ("1999-12-31 23:59:59.999999", fx.DELTA_HI)]


def _streamed_fact_sql():
    q = fact_base_sql()
    for lo, hi in _fact_arrivals():
        q = O.fact_inc_sql(q, O.stage_sql("facttrip", lo, hi), dims_for_fact_base_sql())
    return q


@register("streaming_fact_increments", _streamed_fact_sql())
def q_streaming_fact_increments(spark, sf):
    """Full loads, then trips landing in two arrivals, each an increment of the fact."""
    from .session import scratch_dir
    from .streaming.landing import fact_batch_loader, run_landing_stream
    root = _warehouse(spark)
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    L.bulk_load_all(spark, fixture_extractor(spark, sf, base=True), root, BULK_CUTOFFS, fx.LOAD_TS)
    load = fact_batch_loader(root, FACTTRIP, fx.LOAD_TS, stream_id=checkpoint, date_col="ModifiedDate")
    for i, (lo, hi) in enumerate(_fact_arrivals()):
        rows = fx.stage_facttrip(spark, sf, lo, hi, keep_modified=True)
        rows.write.parquet(f"{landing}/arrival_{i}")
        run_landing_stream(spark, landing, rows.schema, load, checkpoint)
    return P.read_table(spark, root, "FACTTRIP")


# --- W2: unknown members as loaded ------------------------------------------------------------

def _unknown_cols(spec):
    first = spec.attr_names[0]
    if spec.scd == 1:
        return [F.lit(spec.table).alias("Dimension"), F.col(spec.sk).alias("SurrogateKey"),
                F.col(spec.bk).alias("BusinessKey"), F.col(first).alias("Name"),
                F.lit(None).cast("timestamp_ntz").alias("RowStartDateTime"),
                F.lit(None).cast("timestamp_ntz").alias("RowEndDateTime"), F.lit(None).cast("boolean").alias("IsCurrent")]
    return [F.lit(spec.table).alias("Dimension"), F.col(spec.sk).alias("SurrogateKey"),
            F.col(spec.bk).alias("BusinessKey"), F.col(first).alias("Name"),
            "RowStartDateTime", "RowEndDateTime", "IsCurrent"]


def _unknown_sql():
    parts = []
    for s in SCD1_DIMS + SCD2_DIMS:
        tail = ("CAST(NULL AS TIMESTAMP) AS RowStartDateTime, CAST(NULL AS TIMESTAMP) AS RowEndDateTime, "
                "CAST(NULL AS BOOLEAN) AS IsCurrent") if s.scd == 1 else "RowStartDateTime, RowEndDateTime, IsCurrent"
        parts.append(f"SELECT '{s.table}' AS Dimension, {s.sk} AS SurrogateKey, {s.bk} AS BusinessKey, "
                     f"{s.attr_names[0]} AS Name, {tail}, (SELECT COUNT(*) FROM fact f WHERE f.{s.sk} = -1) AS Orphan_Facts "
                     f"FROM ({dim_full_sql(s)}) d WHERE {s.sk} = -1")
    return f"WITH fact AS ({fact_full_sql()}) " + " UNION ALL ".join(parts)


@register("unknown_member", _unknown_sql())
def q_unknown_member(spark, sf):
    """The -1 member of every dimension after its full load, with the fact rows that fell to it."""
    specs = SCD1_DIMS + SCD2_DIMS

    def build(s):
        """Histories are read twice, so they are written: their timelines are made once."""
        dim = dim_full(spark, sf, s)
        return written(dim, "dimension") if s.scd == 2 else dim
    dims = _build_all(build, specs)
    fact = fact_ops.resolve_keys(fx.stage_facttrip(spark, sf), dims, FACTTRIP, fx.LOAD_TS)
    orphans = fact.agg(F.array(*[F.struct(F.lit(s.table).alias("Dimension"), F.count(F.when(F.col(s.sk) == -1, 1))
                                          .alias("Orphan_Facts")) for s in specs]).alias("o")).select(F.inline("o"))
    out = None
    for s in specs:
        rows = dims[s.table].filter(F.col(s.sk) == -1).select(*_unknown_cols(s))
        out = rows if out is None else out.unionByName(rows)
    return out.join(orphans, "Dimension")
