"""DuckDB SQL for the correctness gate: the same loads written as plain ANSI SQL.

Each builder returns a SELECT usable as a subquery.  NULL order is always spelled out
(DuckDB puts NULL last in both directions; Spark and SQL Server put it first ascending).
Keys are ``ROW_NUMBER() OVER (ORDER BY <the operator's key order>)`` plus the append base.
"""
from __future__ import annotations

from pyspark.sql import types as T

from .schemas import EPOCH, FACTTRIP, OPEN_END, UNKNOWN_END, DimSpec, FactSpec
from .sources import fixtures as fx


def sql_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return {T.StringType(): "VARCHAR", T.IntegerType(): "INTEGER", T.LongType(): "BIGINT",
            T.TimestampNTZType(): "TIMESTAMP", T.BooleanType(): "BOOLEAN", T.DoubleType(): "DOUBLE"}[dtype]


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def window_sql(col: str, lo: str | None, hi: str | None) -> str:
    parts = []
    if lo is not None:
        parts.append(f"{col} > {ts(lo)}")
    if hi is not None:
        parts.append(f"{col} <= {ts(hi)}")
    return " AND ".join(parts) if parts else "TRUE"


# --- staging fixtures --------------------------------------------------------------------

def stage_sql(name: str, lo: str | None = None, hi: str | None = None, keep_modified: bool = False) -> str:
    if name == "employee":
        return (f"SELECT CAST(user_id AS INTEGER) AS EmployeeID, "
                f"'EMP-' || CAST(user_id AS VARCHAR) || '-' || event_type AS EmployeeName, "
                f"event_type AS Department, ts AS ModifiedDate FROM events WHERE {window_sql('ts', lo, hi)}")
    if name == "driver":
        return (f"SELECT CAST(l_suppkey AS INTEGER) AS DriverID, s_name AS DriverName, "
                f"'LIC-' || l_returnflag || l_linestatus AS LicenseNumber, l_shipdate AS ModifiedDate "
                f"FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE {window_sql('l_shipdate', lo, hi)}")
    if name == "truck":
        q = ("SELECT CAST(p_partkey AS INTEGER) AS TruckID, p_brand || '-' || CAST(p_partkey AS VARCHAR) AS TruckNumber, "
             "p_type AS Model, CASE WHEN p_partkey % 2 = 1 THEN TIMESTAMP '1997-01-01 00:00:00' "
             "+ to_days(CAST(p_size * 40 AS INTEGER)) END AS ModifiedDate FROM part")
        if lo is not None or hi is not None:
            undated = " OR ModifiedDate IS NULL" if lo is None else ""
            q = f"SELECT * FROM ({q}) WHERE {window_sql('ModifiedDate', lo, hi)}{undated}"
        return q
    if name == "customer":
        return (f"SELECT CAST(o_custkey AS INTEGER) AS CustomerID, c_name AS CustomerName, "
                f"o_orderpriority AS Region, o_orderdate AS ModifiedDate "
                f"FROM orders JOIN customer ON o_custkey = c_custkey WHERE {window_sql('o_orderdate', lo, hi)}")
    if name == "product":
        return (f"SELECT CAST(l_partkey AS INTEGER) AS ProductID, p_name AS ProductName, l_returnflag AS Category, "
                f"CAST(l_discount * 100 AS DECIMAL(18,2)) AS UnitPrice, l_shipdate AS ModifiedDate "
                f"FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {window_sql('l_shipdate', lo, hi)}")
    if name == "vendor":
        return (f"SELECT CAST(l_suppkey AS INTEGER) AS VendorID, s_name || '/' || l_returnflag AS VendorName, "
                f"l_shipdate AS ModifiedDate FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
                f"WHERE {window_sql('l_shipdate', lo, hi)}")
    if name == "facttrip":
        extra = ", l_shipdate AS ModifiedDate" if keep_modified else ""
        return (f"SELECT CAST(l_orderkey AS INTEGER) AS TripID, CAST(l_orderkey % {fx.ORPHAN_EMPLOYEE_MOD} AS INTEGER) AS EmployeeID, "
                f"CAST(l_suppkey AS INTEGER) AS DriverID, CAST(l_partkey AS INTEGER) AS TruckID, "
                f"CAST(o_custkey AS INTEGER) AS CustomerID, CAST(l_partkey AS INTEGER) AS ProductID, "
                f"CAST(l_suppkey AS INTEGER) AS VendorID, CAST(l_quantity AS DECIMAL(10,2)) AS TripDistance, "
                f"CAST(l_extendedprice AS DECIMAL(18,2)) AS Revenue, o_orderdate AS TripDate{extra} "
                f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {window_sql('l_shipdate', lo, hi)}")
    if name == "fleet_asset":
        return (f"SELECT CAST(l_suppkey AS INTEGER) AS Vehicle_ID, 'MODEL-' || CAST(s_nationkey AS VARCHAR) AS Model, "
                f"CASE WHEN l_linestatus = 'F' THEN 'OWN' ELSE 'VENDOR' END AS Ownership_Type, "
                f"l_shipdate AS ModifiedDate FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
                f"WHERE {window_sql('l_shipdate', lo, hi)}")
    if name == "driver_history":
        return (f"SELECT CAST(l_partkey AS INTEGER) AS Driver_ID, 'LIC-' || l_returnflag || l_linestatus AS License_Number, "
                f"'BRANCH-' || p_brand AS Branch, l_shipdate AS ModifiedDate "
                f"FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {window_sql('l_shipdate', lo, hi)}")
    raise KeyError(name)


def stage_full_sql(name: str) -> str:
    return stage_sql(name, *fx.full_window(name))


def stage_merge_sql(name: str) -> tuple[str, str]:
    base, delta = fx.merge_windows(name)
    return stage_sql(name, *base), stage_sql(name, *delta)


def stage_delta_sql(name: str) -> str:
    return stage_sql(name, *fx.delta_window(name))


# --- SCD1 --------------------------------------------------------------------------------

def _asc(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def latest_sql(stg: str, spec: DimSpec) -> str:
    cols = ", ".join([spec.bk, *spec.attr_names, spec.date_col])
    order = f"{spec.date_col} DESC NULLS LAST" + (", " + _asc(spec.attr_names) if spec.attrs else "")
    return (f"SELECT {cols} FROM (SELECT {cols}, ROW_NUMBER() OVER (PARTITION BY {spec.bk} ORDER BY {order}) AS rn "
            f"FROM ({stg}) s) WHERE rn = 1")


def unknown_sql(spec: DimSpec) -> str:
    vals = [f"CAST(-1 AS BIGINT) AS {spec.sk}", f"CAST(-1 AS INTEGER) AS {spec.bk}"]
    for a in spec.attrs:
        v = spec.unknown.get(a.name)
        if isinstance(v, str):
            vals.append(f"CAST('{v}' AS VARCHAR) AS {a.name}")
        else:
            vals.append(f"CAST({v} AS {sql_type(a.dtype)}) AS {a.name}")
    if spec.scd == 1:
        vals.append(f"CAST(NULL AS TIMESTAMP) AS {spec.date_col}")
    else:
        vals += [f"{ts(EPOCH)} AS RowStartDateTime", f"{ts(UNKNOWN_END)} AS RowEndDateTime", "TRUE AS IsCurrent"]
    return "SELECT " + ", ".join(vals)


def scd1_full_sql(stg: str, spec: DimSpec, add_unknown: bool = True) -> str:
    cols = ", ".join([spec.bk, *spec.attr_names, spec.date_col])
    q = (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {spec.bk} ASC NULLS FIRST) AS BIGINT) AS {spec.sk}, {cols} "
         f"FROM ({latest_sql(stg, spec)}) l")
    return f"{q} UNION ALL {unknown_sql(spec)}" if add_unknown else q


def base_sql(target: str, sk: str) -> str:
    return f"(SELECT GREATEST(COALESCE(MAX({sk}), 0), 0) FROM ({target}) b)"


def scd1_merge_sql(target: str, stg: str, spec: DimSpec) -> str:
    newer = f"s.{spec.date_col} > t.{spec.date_col}"
    upd_attrs = ", ".join(f"CASE WHEN {newer} THEN s.{a} ELSE t.{a} END AS {a}" for a in spec.attr_names)
    upd = (f"SELECT t.{spec.sk}, t.{spec.bk}, {upd_attrs}, "
           f"CASE WHEN {newer} THEN s.{spec.date_col} ELSE t.{spec.date_col} END AS {spec.date_col} "
           f"FROM ({target}) t LEFT JOIN ({latest_sql(stg, spec)}) s ON t.{spec.bk} = s.{spec.bk}")
    cols = ", ".join([spec.bk, *spec.attr_names, spec.date_col])
    ins = (f"SELECT CAST({base_sql(target, spec.sk)} + ROW_NUMBER() OVER (ORDER BY {spec.bk} ASC NULLS FIRST) AS BIGINT) "
           f"AS {spec.sk}, {cols} FROM ({latest_sql(stg, spec)}) s "
           f"WHERE NOT EXISTS (SELECT 1 FROM ({target}) t WHERE t.{spec.bk} = s.{spec.bk})")
    return f"{upd} UNION ALL {ins}"


# --- SCD2 --------------------------------------------------------------------------------

def timeline_sql(rows: str, spec: DimSpec, internal: bool = False) -> str:
    """Versions from LEAD; with ``internal`` also the raw date and whether the row ends a run
    of rows equal in key, date and attributes (the key order's last tie-break)."""
    attrs = ", ".join(spec.attr_names)
    same = " AND ".join([f"LEAD({c}) OVER w IS NOT DISTINCT FROM {c}" for c in [spec.date_col, *spec.attr_names]])
    extra = ", __m, NOT __cont AS __term" if internal else ""
    return (f"SELECT {spec.bk}, {attrs}, COALESCE({spec.date_col}, {ts(EPOCH)}) AS RowStartDateTime, "
            f"CASE WHEN nxt IS NULL THEN NULL ELSE nxt - INTERVAL 1 SECOND END AS RowEndDateTime, "
            f"nxt IS NULL AS IsCurrent{extra} FROM (SELECT {spec.bk}, {attrs}, {spec.date_col}, {spec.date_col} AS __m, "
            f"LEAD({spec.date_col}) OVER w AS nxt, (LEAD(1) OVER w IS NOT NULL AND {same}) AS __cont "
            f"FROM ({rows}) r WINDOW w AS (PARTITION BY {spec.bk} ORDER BY {spec.date_col} ASC NULLS FIRST, "
            f"{_asc(spec.attr_names)})) x")


def version_order_sql(spec: DimSpec) -> str:
    return f"{spec.bk} ASC NULLS FIRST, __m ASC NULLS FIRST, {_asc(spec.attr_names)}, __term ASC"


def gold_cols(spec: DimSpec) -> str:
    return ", ".join(spec.gold_columns())


def scd2_full_sql(stg: str, spec: DimSpec, add_unknown: bool = True) -> str:
    attrs = ", ".join(spec.attr_names)
    q = (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {version_order_sql(spec)}) AS BIGINT) AS {spec.sk}, "
         f"{spec.bk}, {attrs}, RowStartDateTime, RowEndDateTime, IsCurrent FROM ({timeline_sql(stg, spec, True)}) v")
    return f"{q} UNION ALL {unknown_sql(spec)}" if add_unknown else q


def _default_sql(a) -> str:
    return "''" if a.null_default == "" else str(a.null_default)


def changed_sql(stg: str, target: str, spec: DimSpec, chain: bool = False) -> str:
    def diffs(left):
        return " OR ".join(f"COALESCE({left}{a.name}, {_default_sql(a)}) <> COALESCE(s.{a.name}, {_default_sql(a)})"
                           for a in spec.attrs)
    cols = ", ".join(f"s.{c}" for c in [spec.bk, *spec.attr_names, spec.date_col])
    src = f"({stg}) s"
    keep = f"t.{spec.sk} IS NULL OR {diffs('t.')}"
    if chain:
        lags = ", ".join(f"LAG({a}) OVER w AS __p_{a}" for a in spec.attr_names)
        src = (f"(SELECT *, {lags}, LAG(1) OVER w IS NOT NULL AS __hasp FROM ({stg}) r WINDOW w AS "
               f"(PARTITION BY {spec.bk} ORDER BY {spec.date_col} ASC NULLS FIRST, {_asc(spec.attr_names)})) s")
        keep = f"CASE WHEN s.__hasp THEN ({diffs('s.__p_')}) ELSE ({keep}) END"
    return (f"SELECT {cols} FROM {src} LEFT JOIN (SELECT * FROM ({target}) c WHERE IsCurrent) t "
            f"ON s.{spec.bk} = t.{spec.bk} WHERE {keep}")


def first_change_sql(delta: str, spec: DimSpec) -> str:
    return f"SELECT {spec.bk}, MIN({spec.date_col}) AS FirstNewDate FROM ({delta}) d GROUP BY {spec.bk}"


def close_out_sql(target: str, delta: str, spec: DimSpec) -> str:
    attrs = ", ".join(f"t.{a}" for a in spec.attr_names)
    return (f"SELECT t.{spec.sk}, t.{spec.bk}, {attrs}, t.RowStartDateTime, "
            f"CASE WHEN f.{spec.bk} IS NOT NULL THEN f.FirstNewDate - INTERVAL 1 SECOND ELSE t.RowEndDateTime END AS RowEndDateTime, "
            f"CASE WHEN f.{spec.bk} IS NOT NULL THEN FALSE ELSE t.IsCurrent END AS IsCurrent "
            f"FROM (SELECT * FROM ({target}) c WHERE IsCurrent) t LEFT JOIN ({first_change_sql(delta, spec)}) f "
            f"ON t.{spec.bk} = f.{spec.bk}")


def scd2_inc_sql(target: str, stg: str, spec: DimSpec, chain: bool = False) -> str:
    delta = changed_sql(stg, target, spec, chain)
    attrs = ", ".join(spec.attr_names)
    hist = f"SELECT {gold_cols(spec)} FROM ({target}) h WHERE NOT IsCurrent"
    ins = (f"SELECT CAST({base_sql(target, spec.sk)} + ROW_NUMBER() OVER (ORDER BY {version_order_sql(spec)}) AS BIGINT) "
           f"AS {spec.sk}, {spec.bk}, {attrs}, RowStartDateTime, RowEndDateTime, IsCurrent FROM ({timeline_sql(delta, spec, True)}) v")
    return f"{hist} UNION ALL {close_out_sql(target, delta, spec)} UNION ALL {ins}"


# --- facts -------------------------------------------------------------------------------

def star_sql(stg: str, dims: dict[str, str], spec: FactSpec = FACTTRIP, load_ts: str = fx.LOAD_TS,
             keep_staging: bool = False) -> str:
    joins, keys = [], []
    for i, (bk, d) in enumerate(spec.lookups):
        a = f"d{i}"
        if d.scd == 1:
            joins.append(f"LEFT JOIN ({dims[d.table]}) {a} ON s.{bk} = {a}.{d.bk}")
        else:
            joins.append(f"LEFT JOIN ({dims[d.table]}) {a} ON s.{bk} = {a}.{d.bk} "
                         f"AND s.{spec.time_col} >= {a}.RowStartDateTime "
                         f"AND s.{spec.time_col} <= COALESCE({a}.RowEndDateTime, {ts(OPEN_END)})")
        keys.append(f"CAST(COALESCE({a}.{d.sk}, -1) AS BIGINT) AS {d.sk}")
    if keep_staging:
        head = "s.*"
    else:
        head = f"s.{spec.id_col}"
    tail = "" if keep_staging else (", " + ", ".join(f"s.{m}" for m in spec.measures)
                                     + f", s.{spec.time_col}, {ts(load_ts)} AS LoadDateTime")
    return f"SELECT {head}, {', '.join(keys)}{tail} FROM ({stg}) s " + " ".join(joins)


def fact_order_sql(spec: FactSpec = FACTTRIP) -> str:
    cols = [spec.id_col, *[d.sk for _, d in spec.lookups], *spec.measures, spec.time_col]
    return _asc(cols)


def fact_full_sql(stg: str, dims: dict[str, str], spec: FactSpec = FACTTRIP, load_ts: str = fx.LOAD_TS) -> str:
    cols = ", ".join(spec.gold_columns()[1:])
    return (f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {fact_order_sql(spec)}) AS BIGINT) AS {spec.sk}, {cols} "
            f"FROM ({star_sql(stg, dims, spec, load_ts)}) r")


def delete_matching_sql(target: str, stg: str, spec: FactSpec = FACTTRIP) -> str:
    return (f"SELECT * FROM ({target}) t WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({stg}) s WHERE s.{spec.id_col} = t.{spec.id_col})")


def fact_inc_sql(target: str, stg: str, dims: dict[str, str], spec: FactSpec = FACTTRIP,
                 load_ts: str = fx.LOAD_TS) -> str:
    cols = ", ".join(spec.gold_columns()[1:])
    kept = f"SELECT {', '.join(spec.gold_columns())} FROM ({delete_matching_sql(target, stg, spec)}) k"
    new = (f"SELECT CAST({base_sql(target, spec.sk)} + ROW_NUMBER() OVER (ORDER BY {fact_order_sql(spec)}) AS BIGINT) "
           f"AS {spec.sk}, {cols} FROM ({star_sql(stg, dims, spec, load_ts)}) r")
    return f"{kept} UNION ALL {new}"
