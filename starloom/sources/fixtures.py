"""Staging inputs built from the driver's test tables (see FIXTURES.md).

Each builder only maps source columns onto a staging schema; all load logic lives in the
operators.  The change-date filter is applied to the *source* column before the join so the
Parquet scan skips row groups, and only the columns the projection needs are read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DEC10_2, DEC18_2, INT, STR, TS
from .extract import window_predicate

# Fixed load windows of the fixtures.
FULL_CUTOFF = "1999-01-01 00:00:00"
DELTA_HI = "2002-01-01 00:00:00"
EMP_FULL_CUTOFF = "2024-01-20 00:00:00"
EMP_DELTA_HI = "2024-02-01 00:00:00"
LOAD_TS = "2002-01-01 00:00:00"
ORPHAN_EMPLOYEE_MOD = 200       # EmployeeID = TripID % 200; ids 150-199 have no employee


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _window(lo, hi, src_col):
    if lo is None and hi is None:
        return F.lit(True)
    return window_predicate(src_col, lo, hi)


def stage_employee(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(_window(lo, hi, "ts"))
    return ev.select(
        F.col("user_id").cast(INT).alias("EmployeeID"),
        F.concat(F.lit("EMP-"), F.col("user_id").cast(STR), F.lit("-"), F.col("event_type")).alias("EmployeeName"),
        F.col("event_type").alias("Department"),
        F.col("ts").cast(TS).alias("ModifiedDate"))


def _lineitem(spark, sf_dir, lo, hi, cols):
    return table(spark, sf_dir, "lineitem").filter(_window(lo, hi, "l_shipdate")).select(*cols)


def _join_as(left: DataFrame, key: str, right: DataFrame, right_key: str, name: str) -> DataFrame:
    """Inner join by the staged (INT) key: what goes on by that key is partitioned by it already."""
    left = left.withColumn(name, F.col(key).cast(INT)).drop(key)
    right = right.withColumn("__key", F.col(right_key).cast(INT)).drop(right_key)
    return left.join(right, F.col(name) == F.col("__key")).drop("__key")


def stage_driver(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    li = _lineitem(spark, sf_dir, lo, hi, ["l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"])
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return li.join(su, li.l_suppkey == su.s_suppkey).select(
        F.col("l_suppkey").cast(INT).alias("DriverID"),
        F.col("s_name").alias("DriverName"),
        F.concat(F.lit("LIC-"), F.col("l_returnflag"), F.col("l_linestatus")).alias("LicenseNumber"),
        F.col("l_shipdate").cast(TS).alias("ModifiedDate"))


def stage_truck(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    pa = table(spark, sf_dir, "part")
    out = pa.select(
        F.col("p_partkey").cast(INT).alias("TruckID"),
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast(STR)).alias("TruckNumber"),
        F.col("p_type").alias("Model"),
        F.when(F.col("p_partkey") % 2 == 1,
               F.date_add(F.lit("1997-01-01").cast("date"), F.col("p_size") * 40).cast(TS)).alias("ModifiedDate"))
    if lo is not None or hi is not None:          # NULL dates never pass a delta bound ...
        rows = _window(lo, hi, "ModifiedDate")    # ... but are in the source from the start
        out = out.filter(rows if lo is not None else rows | F.col("ModifiedDate").isNull())
    return out


def stage_customer(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(_window(lo, hi, "o_orderdate")) \
        .select("o_custkey", "o_orderpriority", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return _join_as(o, "o_custkey", c, "c_custkey", "CustomerID").select(
        "CustomerID",
        F.col("c_name").alias("CustomerName"),
        F.col("o_orderpriority").alias("Region"),
        F.col("o_orderdate").cast(TS).alias("ModifiedDate"))


def stage_product(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    li = _lineitem(spark, sf_dir, lo, hi, ["l_partkey", "l_returnflag", "l_discount", "l_shipdate"])
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _join_as(li, "l_partkey", pa, "p_partkey", "ProductID").select(
        "ProductID",
        F.col("p_name").alias("ProductName"),
        F.col("l_returnflag").alias("Category"),
        (F.col("l_discount") * 100).cast(DEC18_2).alias("UnitPrice"),
        F.col("l_shipdate").cast(TS).alias("ModifiedDate"))


def stage_vendor(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    li = _lineitem(spark, sf_dir, lo, hi, ["l_suppkey", "l_returnflag", "l_shipdate"])
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return _join_as(li, "l_suppkey", su, "s_suppkey", "VendorID").select(
        "VendorID",
        F.concat(F.col("s_name"), F.lit("/"), F.col("l_returnflag")).alias("VendorName"),
        F.col("l_shipdate").cast(TS).alias("ModifiedDate"))


def stage_facttrip(spark, sf_dir, lo=None, hi=None, keep_modified=False) -> DataFrame:
    li = _lineitem(spark, sf_dir, lo, hi, ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                           "l_extendedprice", "l_shipdate"])
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cols = [
        F.col("l_orderkey").cast(INT).alias("TripID"),
        (F.col("l_orderkey") % ORPHAN_EMPLOYEE_MOD).cast(INT).alias("EmployeeID"),
        F.col("l_suppkey").cast(INT).alias("DriverID"),
        F.col("l_partkey").cast(INT).alias("TruckID"),
        F.col("o_custkey").cast(INT).alias("CustomerID"),
        F.col("l_partkey").cast(INT).alias("ProductID"),
        F.col("l_suppkey").cast(INT).alias("VendorID"),
        F.col("l_quantity").cast(DEC10_2).alias("TripDistance"),
        F.col("l_extendedprice").cast(DEC18_2).alias("Revenue"),
        F.col("o_orderdate").cast(TS).alias("TripDate"),
    ]
    if keep_modified:
        cols.append(F.col("l_shipdate").cast(TS).alias("ModifiedDate"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*cols)


def stage_fleet_asset(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    """Vehicle history (documented SCD2 fleet dimension): model and ownership per change.  The
    marts' vehicles are the suppliers' trucks."""
    li = _lineitem(spark, sf_dir, lo, hi, ["l_suppkey", "l_linestatus", "l_shipdate"])
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return _join_as(li, "l_suppkey", su, "s_suppkey", "Vehicle_ID").select(
        "Vehicle_ID",
        F.concat(F.lit("MODEL-"), F.col("s_nationkey").cast(STR)).alias("Model"),
        ownership_type().alias("Ownership_Type"),
        F.col("l_shipdate").cast(TS).alias("ModifiedDate"))


def stage_driver_history(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    """Driver history (documented SCD2 driver dimension): licence and branch per change.  The
    marts' drivers are the parts' handlers."""
    li = _lineitem(spark, sf_dir, lo, hi, ["l_partkey", "l_returnflag", "l_linestatus", "l_shipdate"])
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return _join_as(li, "l_partkey", pa, "p_partkey", "Driver_ID").select(
        "Driver_ID",
        F.concat(F.lit("LIC-"), F.col("l_returnflag"), F.col("l_linestatus")).alias("License_Number"),
        F.concat(F.lit("BRANCH-"), F.col("p_brand")).alias("Branch"),
        F.col("l_shipdate").cast(TS).alias("ModifiedDate"))


# --- inputs of the documented marts, in neutral names ---------------------------------------

def ownership_type(c="l_linestatus"):
    """Closed lines ('F') ran on owned trucks, open lines on vendor trucks."""
    return F.when(F.col(c) == "F", F.lit("OWN")).otherwise(F.lit("VENDOR"))


def mart_lines(spark, sf_dir) -> DataFrame:
    """Trip lines: what moved, on which vehicle, with which driver, at which rates."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_quantity", "l_extendedprice",
        "l_tax", "l_discount", "l_shipdate")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    price = F.col("l_extendedprice").cast(DEC18_2)
    return li.join(pa, li.l_partkey == pa.p_partkey, "left").select(
        F.col("l_orderkey").alias("Trip_ID"), F.col("l_linenumber").alias("Line_No"),
        F.col("l_suppkey").cast(INT).alias("Vehicle_ID"), F.col("l_partkey").cast(INT).alias("Driver_ID"),
        F.col("p_type").alias("Commodity"), ownership_type().alias("Ownership_Type"),
        F.col("l_quantity").cast(DEC10_2).alias("Weight"),
        (price * F.lit("0.01").cast(T.DecimalType(3, 2))).cast(DEC10_2).alias("Distance"),
        price.alias("Amount"), F.col("l_tax").cast(T.DecimalType(4, 2)).alias("Fuel_Rate"),
        F.col("l_discount").cast(T.DecimalType(4, 2)).alias("Driver_Rate"), F.col("l_shipdate").cast(TS).alias("Delivered"))


def mart_trips(spark, sf_dir) -> DataFrame:
    """Trips: customer, type, billed amount and the customer's branch."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_orderpriority", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("Trip_ID"), F.col("o_orderdate").cast(TS).alias("Trip_Date"),
        F.col("o_custkey").cast(INT).alias("Customer_ID"), _site_id().alias("Address_ID"), F.col("o_orderpriority").alias("Trip_Type"),
        F.col("o_totalprice").cast(DEC18_2).alias("Billed"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast(STR)).alias("Branch_ID"))


def _months_run(spark, sf_dir, key: str) -> DataFrame:
    """Every month in which a vehicle or driver had a line."""
    li = table(spark, sf_dir, "lineitem").select(key, "l_shipdate")
    return li.select(key, (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("Month_Key")).distinct()


def maintenance_bills(spark, sf_dir) -> DataFrame:
    """The workshop's bill of each vehicle and month it ran: a sum set per truck."""
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    m = _months_run(spark, sf_dir, "l_suppkey")
    return m.join(su, m.l_suppkey == su.s_suppkey).select(
        F.col("l_suppkey").cast(INT).alias("Vehicle_ID"), "Month_Key", F.abs(F.col("s_acctbal").cast(DEC18_2)).cast(DEC18_2).alias("Amount"))


def base_pay(spark, sf_dir) -> DataFrame:
    """Base pay of each driver and month driven."""
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    m = _months_run(spark, sf_dir, "l_partkey")
    return m.join(pa, m.l_partkey == pa.p_partkey).select(
        F.col("l_partkey").cast(INT).alias("Driver_ID"), "Month_Key", F.col("p_retailprice").cast(DEC18_2).alias("Amount"))


def branch_nodes(spark, sf_dir) -> DataFrame:
    """Parent/child list of branches on three levels: region, nation, supplier site."""
    def node(name, prefix, key, label, parent, level):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(prefix), F.col(key).cast(STR)).alias("Branch_ID"), F.col(label).alias("Branch_Name"),
            parent.cast(STR).alias("Parent_Branch_ID"), F.lit(level).alias("Branch_Level"))
    return node("region", "R", "r_regionkey", "r_name", F.lit(None), "HUB") \
        .unionByName(node("nation", "N", "n_nationkey", "n_name", F.concat(F.lit("R"), F.col("n_regionkey").cast(STR)), "SUB_LOCATION")) \
        .unionByName(node("supplier", "S", "s_suppkey", "s_name", F.concat(F.lit("N"), F.col("s_nationkey").cast(STR)), "SITE"))


def _site_id():
    """A customer's delivery site: one for each kind of order the customer places."""
    return (F.col("o_custkey") * 10 + F.substring("o_orderpriority", 1, 1).cast(INT)).cast(INT)


def customer_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers, their delivery sites, nations and regions.  A site's nation follows from its id."""
    sites = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast(INT).alias("Customer_ID"), _site_id().alias("Address_ID"),
                                                  F.concat(F.lit("GATE "), F.col("o_orderpriority")).alias("Site_Name")).distinct()
    return (table(spark, sf_dir, "customer").select(
                F.col("c_custkey").cast(INT).alias("Customer_ID"), F.col("c_name").alias("Customer_Name"),
                F.col("c_mktsegment").alias("Customer_Type"), F.col("c_acctbal").cast(DEC18_2).alias("Credit_Limit")),
            sites.withColumn("Nation_ID", F.col("Address_ID") % 25),
            table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("Nation_ID"), F.col("n_name").alias("Nation_Name"),
                                                  F.col("n_regionkey").alias("Region_ID")),
            table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("Region_ID"), F.col("r_name").alias("Region_Name")))


def permits(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Vehicle_ID"), F.col("p_size").cast(DEC10_2).alias("Capacity_Tons"),
        F.col("p_brand").alias("Permit_Class"), F.col("p_retailprice").cast(DEC18_2).alias("Insured_Value"))


def licences(spark, sf_dir) -> DataFrame:
    """A licence per driver; when it expires follows from the branch's nation."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Driver_ID"), F.col("s_nationkey").alias("Branch_Nation"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("s_nationkey") * 100).cast(INT)).cast(TS).alias("License_Expiry_Date"))


STAGERS = {
    "employee": stage_employee, "driver": stage_driver, "truck": stage_truck,
    "customer": stage_customer, "product": stage_product, "vendor": stage_vendor,
    "facttrip": stage_facttrip, "fleet_asset": stage_fleet_asset, "driver_history": stage_driver_history,
}


def full_window(name: str) -> tuple[str | None, str | None]:
    """The state of a source when the full load beneath an increment ran."""
    return None, EMP_FULL_CUTOFF if name == "employee" else FULL_CUTOFF


# (base up to, delta from) of the SCD1 merges: the delta overlaps the base, so it holds stale rows
# beside new keys and newer rows, and goes on to the end of the source.
MERGE_WINDOWS = {
    "employee": ("2024-01-01 12:00:00", "2024-01-01 06:00:00"),
    "driver": ("1995-01-06 00:00:00", "1995-01-03 00:00:00"),
    "truck": (FULL_CUTOFF, "1998-01-01 00:00:00"),
}


def merge_windows(name: str):
    base_hi, lo = MERGE_WINDOWS[name]
    return (None, base_hi), (lo, None)


def delta_window(name: str) -> tuple[str, str]:
    if name == "employee":
        return EMP_FULL_CUTOFF, EMP_DELTA_HI
    return FULL_CUTOFF, DELTA_HI


def stage_full(spark, sf_dir, name) -> DataFrame:
    lo, hi = full_window(name)
    return STAGERS[name](spark, sf_dir, lo, hi)


def stage_delta(spark, sf_dir, name) -> DataFrame:
    lo, hi = delta_window(name)
    return STAGERS[name](spark, sf_dir, lo, hi)
