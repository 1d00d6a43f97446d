"""The documented multi-star marts: calendar, conformed dimensions, and three facts of
different grain (daily vehicle snapshot, per-trip finance, per-trip activity).

All are DataFrame compositions: joins, grouped aggregates (partial aggregation map side),
ROLLUP, and lookups through ``lookup_scd1``.  Measures that combine sources are aggregated to
the target grain *before* joining (never raw-to-raw), which keeps grains from multiplying.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import (date_key, div_half_up, fiscal_quarter, fiscal_year, hours_between, safe_ratio,
                                 scaled_to_decimal)
from ..schemas import DEC10_2, DEC18_2, INT, DimSpec
from .allocation import allocate
from .keys import dense_key
from .lookup import star_lookup
from .ordered import most_rows_of, written
from .shifts import with_shift_hours
from .sizing import broadcast_if_small


# ------------------------------------------------------------------------------------------
# S7 calendar
# ------------------------------------------------------------------------------------------

def dim_date(spark: SparkSession, first_day, last_day, fy_start_month: int = 4) -> DataFrame:
    """One row per day in ``[first_day, last_day]``, generated with a distributed ``range``."""
    n_days = (last_day - first_day).days + 1
    start = F.lit(first_day.isoformat()).cast(T.DateType())
    days = spark.range(0, n_days).select(F.date_add(start, F.col("id").cast(INT)).alias("Full_Date"))
    d = F.col("Full_Date")
    return days.select(
        date_key(d).alias("Date_SKey"), d,
        F.dayofmonth(d).alias("Day_Of_Month"),
        F.dayofweek(d).alias("Day_Of_Week"),
        F.date_format(d, "EEEE").alias("Day_Name"),
        F.weekofyear(d).alias("Week_Of_Year"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("Month_Name"),
        F.quarter(d).alias("Quarter"),
        F.year(d).alias("Year"),
        fiscal_year(d, fy_start_month).alias("Fiscal_Year"),
        fiscal_quarter(d, fy_start_month).alias("Fiscal_Quarter"),
        F.dayofweek(d).isin(1, 7).alias("Is_Weekend"))


def dim_date_from(df: DataFrame, date_col: str, fy_start_month: int = 4) -> DataFrame:
    """Calendar covering the dates present in ``df`` (one global min/max aggregate)."""
    b = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi")).first()
    return dim_date(df.sparkSession, b.lo, b.hi, fy_start_month)


# ------------------------------------------------------------------------------------------
# G2 derived dimensions, C8-C11 conformed dimensions
# ------------------------------------------------------------------------------------------

def derived_dimension(values: DataFrame, value_col: str, name: str, key: str) -> DataFrame:
    """Distinct values with dense keys in value order."""
    distinct = values.select(F.col(value_col).alias(name)).distinct()
    return dense_key(distinct, key, [F.col(name).asc_nulls_first()]).select(key, name)


def hierarchy_roots(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root): the root of every node's tree, by pointer doubling.

    Every node points at its parent; a round lets it point at where its pointer points, so k
    rounds climb 2^k levels and the number of joins grows with the logarithm of the depth, which
    is not bounded.  A parent that is not in the list ends the climb.  Once 2^k is the number of
    nodes, whoever has not arrived at a root is caught in a cycle: then the nodes on cycles, which
    are the ones still pointed at, are named in a ``ValueError``."""
    up = nodes.select(F.col(node).alias("node"), F.col(parent).alias("__up"))
    known = nodes.select(F.col(node).alias("__up")).distinct()
    up = up.join(known.withColumn("__known", F.lit(True)), "__up", "left")
    at = written(up.select("node", F.when(F.col("__known"), F.col("__up")).otherwise(F.col("node")).alias("root"),
                           F.col("__known").isNull().alias("arrived")), "climb")
    rounds = math.ceil(math.log2(max(at.count(), 2))) + 1
    for _ in range(rounds):
        if at.where("not arrived").isEmpty():
            return at.select("node", "root")
        # Who points at a root has arrived, and joins no more.
        step, _ = broadcast_if_small(at.select(F.col("node").alias("root"), F.col("root").alias("__next"),
                                               F.col("arrived").alias("__there")))
        at = written(at.where("arrived").unionByName(
            at.where("not arrived").join(step, "root").select("node", F.col("__next").alias("root"), F.col("__there").alias("arrived"))),
            "climb")
    caught = at.where("not arrived").select("root").distinct()
    if caught.isEmpty():
        return at.select("node", "root")
    some = [str(r[0]) for r in caught.orderBy("root").limit(20).collect()]
    raise ValueError(f"the branch hierarchy has a cycle through {', '.join(some)}")


def dim_geography(nodes: DataFrame) -> DataFrame:
    """Parent/child list (Branch_ID, Branch_Name, Parent_Branch_ID, Branch_Level) flattened:
    every node with its parent and its hub, the root of its tree."""
    climb = hierarchy_roots(nodes, "Branch_ID", "Parent_Branch_ID")
    names = nodes.select(F.col("Branch_ID").alias("__id"), F.col("Branch_Name").alias("__name"))
    parents = names.withColumnsRenamed({"__id": "__pid", "__name": "Parent_Branch_Name"})
    hubs = names.withColumnsRenamed({"__id": "__hid", "__name": "Hub_Name"})
    flat = nodes.join(parents, F.col("Parent_Branch_ID") == F.col("__pid"), "left") \
        .join(climb.select(F.col("node").alias("__bid"), "root"), F.col("Branch_ID") == F.col("__bid")) \
        .join(hubs, F.col("root") == F.col("__hid")) \
        .select("Branch_ID", "Branch_Name", "Branch_Level", "Parent_Branch_ID", "Parent_Branch_Name", "Hub_Name")
    return dense_key(flat, "Location_SKey", [F.col("Branch_ID").asc_nulls_first()])


def dim_customer_enterprise(customer: DataFrame, address: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customer LEFT JOIN address LEFT JOIN nation LEFT JOIN region.  A customer has several
    addresses (delivery sites), so the grain is the site: Customer_ID and Address_ID together are
    the natural key, and facts find a site by its Address_ID.  A customer without an address is
    one row without one."""
    flat = customer.join(address, "Customer_ID", "left").join(nation, "Nation_ID", "left").join(region, "Region_ID", "left") \
        .select("Customer_ID", "Address_ID", "Customer_Name", "Customer_Type", "Credit_Limit", "Site_Name", "Nation_Name", "Region_Name")
    return dense_key(flat, "Customer_SKey", [F.col("Customer_ID").asc_nulls_first(), F.col("Address_ID").asc_nulls_first()])


def dim_fleet_asset(truck_dim: DataFrame, permits: DataFrame) -> DataFrame:
    """Vehicle LEFT JOIN its permit record (1:1 by vehicle id)."""
    j = truck_dim.join(permits, truck_dim.TruckID == permits.Vehicle_ID, "left")
    return j.select(F.col("TruckKey").alias("Fleet_SKey"), F.col("TruckID").alias("Vehicle_ID"),
                    F.col("TruckNumber").alias("Truck_Number"), "Model", "Capacity_Tons", "Permit_Class", "Insured_Value")


def dim_driver_compliance(driver_dim: DataFrame, licences: DataFrame) -> DataFrame:
    """Driver INNER JOIN licence record (1:1 by driver id)."""
    j = driver_dim.join(licences, driver_dim.DriverID == licences.Driver_ID, "inner")
    return j.select(F.col("DriverKey").alias("Driver_SKey"), F.col("DriverID").alias("Driver_ID"),
                    F.col("DriverName").alias("Driver_Name"), F.col("LicenseNumber").alias("License_Number"),
                    "Branch_Nation", "License_Expiry_Date")


def scd2_doc_columns(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Rename the timeline columns to the documented SCD_Row_* names."""
    return dim.select(spec.sk, spec.bk, *spec.attr_names,
                      F.col("RowStartDateTime").alias("SCD_Row_Start_Date"),
                      F.col("RowEndDateTime").alias("SCD_Row_End_Date"),
                      F.col("IsCurrent").alias("SCD_Row_Active_Flag"))


# ------------------------------------------------------------------------------------------
# Facts: D4 daily snapshot, D5 trip finance, T3 trip activity
# ------------------------------------------------------------------------------------------

# Fixture assumptions of the snapshot (named, overridable): average speed and truck capacity.
AVG_SPEED_KMH = 50
CAPACITY_TONS = 50


def daily_snapshot(lines: DataFrame, trips: DataFrame, speed_kmh: float = AVG_SPEED_KMH,
                   capacity_tons: float = CAPACITY_TONS) -> DataFrame:
    """One row per vehicle and calendar day from the vehicle's first to its last day, idle days
    included, with the driver and branch as last known on that day.

    Running hours = distance / average speed (capped at 24), idle = 24 - running, load factor
    = tons carried / (trips x capacity), NULL on a day without a trip.  Driver and branch are
    those of the day's last line; an idle day keeps those of the day before.

    Lines are summed per vehicle and day first (partial sums per task), so a vehicle's window has
    a row per day it ran, however many lines a day holds; the days that follow an active one up to
    the next are made from that row, which is how its driver and branch reach them.  Lines without
    a vehicle are the days of the unknown vehicle (Vehicle_ID NULL).  Lines without a delivery
    time have no day and no place here; ``quality.check_not_null`` lists them.
    """
    return _days(_stretches(lines, trips), speed_kmh, capacity_tons)


def _stretches(lines: DataFrame, trips: DataFrame) -> DataFrame:
    """One row per vehicle and day it ran, with the last of the idle days that follow."""
    last = F.max(F.struct("Delivered", "Trip_ID", "Line_No", "Driver_ID"))
    g = lines.where(F.col("Delivered").isNotNull()).groupBy("Vehicle_ID", F.to_date("Delivered").alias("__day")).agg(
        F.count(F.lit(1)).alias("__trips"), F.sum(F.col("Distance").cast(DEC10_2)).cast(DEC18_2).alias("__km"),
        F.sum(F.col("Weight").cast(DEC10_2)).cast(DEC18_2).alias("__load"), last.alias("__last"))
    branches = trips.select(F.col("Trip_ID").alias("__trip"), "Branch_ID")
    active = g.select("*", "__last.Driver_ID", F.col("__last.Trip_ID").alias("__of")) \
        .join(branches, F.col("__of") == F.col("__trip"), "left")
    w = Window.partitionBy("Vehicle_ID").orderBy("__day")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return active.select(
        "Vehicle_ID", "__day", "__trips", "__km", "__load",
        F.last("Driver_ID", ignorenulls=True).over(so_far).alias("Driver_ID"),
        F.last("Branch_ID", ignorenulls=True).over(so_far).alias("Branch_ID"),
        F.date_sub(F.coalesce(F.lead("__day").over(w), F.date_add("__day", 1)), 1).alias("__until"))


def _days(spans: DataFrame, speed_kmh: float = AVG_SPEED_KMH, capacity_tons: float = CAPACITY_TONS) -> DataFrame:
    days = spans.withColumn("__at", F.explode(F.sequence("__day", "__until")))
    ran = F.col("__at") == F.col("__day")
    nothing = F.lit(0).cast(DEC18_2)
    days = days.select(
        date_key("__at").alias("Date_SKey"), "Vehicle_ID", "Driver_ID", "Branch_ID",
        # The snapshot shows the state at the end of the day.
        (F.date_add("__at", 1).cast(T.TimestampNTZType()) - F.expr("INTERVAL 1 SECOND")).alias("Snapshot_Time"),
        F.when(ran, F.col("__trips")).otherwise(0).alias("Trips_Count_Daily"),
        F.when(ran, F.coalesce("__km", nothing)).otherwise(nothing).alias("Distance_KM_Daily"),
        F.when(ran, F.coalesce("__load", nothing)).otherwise(nothing).alias("__load"))
    # hours = km / (km/h), rounded half-up to 0.01 h in exact integer arithmetic, capped at 24
    centi = div_half_up((F.col("Distance_KM_Daily") * 100).cast("long"), F.lit(speed_kmh))
    running = scaled_to_decimal(F.least(centi, F.lit(2400)), 2, 10)
    return days.select(
        "Date_SKey", "Vehicle_ID", "Driver_ID", "Branch_ID", "Snapshot_Time", "Trips_Count_Daily", "Distance_KM_Daily",
        running.alias("Running_Hours"),
        (F.lit(24).cast(DEC10_2) - running).cast(DEC10_2).alias("Idle_Hours"),
        safe_ratio(F.col("__load"), F.col("Trips_Count_Daily") * F.lit(capacity_tons)).alias("Load_Factor_Ratio"))


def fact_fleet_utilization(lines: DataFrame, trips: DataFrame, dims: dict[str, DataFrame], keys: dict, **assumed) -> DataFrame:
    """The daily snapshot with its keys: the versions valid at the end of the day, -1 where a
    vehicle, driver or branch is unknown, and the snapshot's own id (vehicle and day).  The lookups
    count the snapshot before they use it, so what its days are made of is written."""
    keyed = with_keys(_days(written(_stretches(lines, trips), "stretches"), **assumed), dims, keys, "Snapshot_Time")
    vehicle = F.coalesce(F.col("Vehicle_ID").cast("string"), F.lit("UNKNOWN"))
    return keyed.select(F.concat_ws("-", vehicle, F.col("Date_SKey").cast("string")).alias("DD_Snapshot_ID"), "Date_SKey",
                        *dims, "Vehicle_ID", "Trips_Count_Daily", "Distance_KM_Daily", "Running_Hours", "Idle_Hours",
                        "Load_Factor_Ratio")


def hours_by_ownership(util: DataFrame, fleet: DataFrame) -> DataFrame:
    """Running and idle hours of owned and vendor vehicles per month, by the fleet version each
    snapshot points at."""
    side, _ = broadcast_if_small(fleet.select("Fleet_SKey", "Ownership_Type"))
    month = (F.floor(F.col("Date_SKey") / 100)).cast(INT).alias("Month_Key")
    return util.join(side, "Fleet_SKey", "left").groupBy("Ownership_Type", month).agg(
        F.count(F.lit(1)).alias("Vehicle_Days"), F.sum("Running_Hours").cast(DEC18_2).alias("Running_Hours"),
        F.sum("Idle_Hours").cast(DEC18_2).alias("Idle_Hours"))


def uptime_ratio(util: DataFrame) -> DataFrame:
    """Running / (running + idle) per vehicle and month - a ratio of sums."""
    month = (F.floor(F.col("Date_SKey") / 100)).cast(INT).alias("Month_Key")
    g = util.groupBy("Vehicle_ID", month).agg(
        F.sum("Running_Hours").cast(DEC18_2).alias("Running_Hours"),
        F.sum("Idle_Hours").cast(DEC18_2).alias("Idle_Hours"))
    return g.withColumn("Uptime_Ratio", safe_ratio(F.col("Running_Hours"),
                                                   F.col("Running_Hours") + F.col("Idle_Hours")))


# Fixture cost model (named, overridable): per-ton handling, per-stop toll.
HANDLING_PER_TON = 0.25
TOLL_PER_STOP = 25.0


def _dec(c, p=18, s=2):
    return F.col(c).cast(T.DecimalType(p, s)) if isinstance(c, str) else c.cast(T.DecimalType(p, s))


def _per_unit(rate: float):
    return F.lit(rate).cast(T.DecimalType(6, 2))


def with_allocated_costs(lines: DataFrame, maintenance: DataFrame, base_pay: DataFrame) -> DataFrame:
    """Trip lines with their share of the period costs: a vehicle's monthly maintenance bill by
    kilometres, a driver's monthly base pay by tons (Vehicle_ID or Driver_ID, Month_Key, Amount)."""
    month = (F.year("Delivered") * 100 + F.month("Delivered")).alias("Month_Key")
    order, vehicle, driver = ["Trip_ID", "Line_No"], ["Vehicle_ID", "Month_Key"], ["Driver_ID", "Month_Key"]
    lines = lines.select("*", month)
    most = most_rows_of(lines, vehicle, driver)
    out = allocate(lines, maintenance, vehicle, "Distance", order, "Maintenance_Share", most=most[0])
    return allocate(out, base_pay, driver, "Weight", order, "Base_Pay_Share", most=most[1]).drop("Month_Key")


def line_costs() -> dict:
    """The five cost parts of a trip line (``with_allocated_costs``), one rule for every mart."""
    return {"Fuel_Cost_INR": F.col("Amount") * F.col("Fuel_Rate"),
            "Driver_Cost_INR": F.col("Amount") * F.col("Driver_Rate") + F.col("Base_Pay_Share"),
            "Maintenance_Cost_INR": F.col("Maintenance_Share"),
            "Toll_Cost_INR": _per_unit(TOLL_PER_STOP),
            "Other_Cost_INR": F.col("Weight") * _per_unit(HANDLING_PER_TON)}


COST_COLS = ["Fuel_Cost_INR", "Driver_Cost_INR", "Maintenance_Cost_INR", "Toll_Cost_INR", "Other_Cost_INR"]


def trip_totals(lines: DataFrame, costs: dict | None = None) -> DataFrame:
    """Trip grain: lines summed per trip before any join (never raw-to-raw); vehicle, driver
    and commodity are those of the trip's first line.  ``costs``: name -> cost of a line."""
    first = F.min(F.struct("Line_No", "Vehicle_ID", "Driver_ID", "Commodity"))
    return lines.groupBy("Trip_ID").agg(
        first.alias("__first"), F.sum("Weight").cast(DEC18_2).alias("Weight"), F.sum("Distance").cast(DEC18_2).alias("Distance"),
        F.max("Delivered").alias("Delivered"), *[F.sum(c).cast(DEC18_2).alias(k) for k, c in (costs or {}).items()]) \
        .select("*", "__first.Vehicle_ID", "__first.Driver_ID", "__first.Commodity").drop("__first")


def trip_finance(trips: DataFrame, lines: DataFrame) -> DataFrame:
    """Atomic trip grain: revenue from the trip, costs summarised per trip and left joined."""
    zero = F.lit(0).cast(DEC18_2)
    j = trips.join(trip_totals(lines, line_costs()), "Trip_ID", "left")
    out = j.select(F.col("Trip_ID").alias("DD_Trip_ID"), date_key("Trip_Date").alias("Date_SKey"), "Customer_ID", "Address_ID",
                   F.col("Billed").alias("Gross_Revenue_INR"), *[F.coalesce(F.col(c), zero).alias(c) for c in COST_COLS],
                   "Trip_Date", "Vehicle_ID", "Driver_ID", "Branch_ID", "Commodity")
    total = sum((F.col(c) for c in COST_COLS[1:]), F.col(COST_COLS[0]))
    return out.withColumn("Net_Profit_INR", (F.col("Gross_Revenue_INR") - total).cast(DEC18_2))


def conformed(table: str, bk: str, sk: str, scd: int = 1) -> DimSpec:
    """How a fact finds its key in a conformed dimension: by equality, or in its history."""
    return DimSpec(table, "", bk, sk, (), scd)


def with_keys(fact: DataFrame, dims: dict[str, DataFrame], keys: dict, time_col: str) -> DataFrame:
    """Surrogate keys of ``dims`` (key name -> dimension), found as ``keys`` says (key name ->
    (the fact's column, ``conformed`` spec)): the version valid at ``time_col`` where the
    dimension has history, else by equality; -1 where nothing matches.  One star: the sides are
    measured together and share the broadcast bound."""
    specs = {k: keys[k] for k in dims}
    return star_lookup(fact, {spec.table: dims[k] for k, (_, spec) in specs.items()}, list(specs.values()), time_col)


def fact_operational_profitability(trips: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], keys: dict) -> DataFrame:
    """Trip finance with its conformed keys."""
    keyed = with_keys(trip_finance(trips, lines), dims, keys, "Trip_Date")
    return keyed.drop("Trip_Date", "Address_ID", "Vehicle_ID", "Driver_ID", "Branch_ID", "Commodity")


def trip_profit_by(lines: DataFrame, trips: DataFrame) -> DataFrame:
    """Margin by commodity, owned or vendor fleet, and trip type, with the trip finance's costs."""
    j = lines.join(trips.select("Trip_ID", "Trip_Type"), "Trip_ID", "left")
    cost = sum(line_costs().values(), F.lit(0).cast(DEC18_2))
    g = j.groupBy("Commodity", "Ownership_Type", "Trip_Type") \
        .agg(F.countDistinct("Trip_ID").alias("Trips"), F.sum("Amount").cast(DEC18_2).alias("Revenue"),
             F.sum(cost).cast(DEC18_2).alias("Cost"))
    return g.withColumn("Margin", (F.col("Revenue") - F.col("Cost")).cast(DEC18_2)) \
            .withColumn("Margin_Pct", safe_ratio(F.col("Margin"), F.col("Revenue")))


def calendar_rollup(df: DataFrame, date_col: str, measure: str, fy_start_month: int = 4) -> DataFrame:
    """Drill path Financial Year > Quarter > Month > Day as one ROLLUP."""
    d = F.to_date(date_col)
    return df.rollup(fiscal_year(d, fy_start_month).alias("Fiscal_Year"),
                     fiscal_quarter(d, fy_start_month).alias("Fiscal_Quarter"),
                     (F.year(d) * 100 + F.month(d)).alias("Month_Key"),
                     d.alias("Full_Date")) \
        .agg(F.grouping_id().alias("Grouping_Level"), F.count(F.lit(1)).alias("Trips"),
             F.sum(_dec(measure)).cast(DEC18_2).alias("Revenue"))


def calendar_week_rollup(df: DataFrame, date_col: str, measure: str) -> DataFrame:
    """Week path (ISO year > ISO week > day); weeks straddle months, so it is its own rollup."""
    d = F.to_date(date_col)
    # ISO year = calendar year of the week's Thursday (Monday-based weekday 0..6).
    iso_year = F.year(F.date_add(d, F.lit(3) - (F.dayofweek(d) + 5) % 7)).alias("ISO_Year")
    return df.rollup(iso_year, F.weekofyear(d).alias("Week_Of_Year"), d.alias("Full_Date")) \
        .agg(F.grouping_id().alias("Grouping_Level"), F.count(F.lit(1)).alias("Trips"),
             F.sum(_dec(measure)).cast(DEC18_2).alias("Revenue"))


def volume_by_commodity(lines: DataFrame) -> DataFrame:
    """Tonnage and trips by commodity and month of delivery."""
    d = F.col("Delivered")
    return lines.groupBy("Commodity", (F.year(d) * 100 + F.month(d)).alias("Month_Key")) \
        .agg(F.sum("Weight").cast(DEC18_2).alias("Tonnage"), F.countDistinct("Trip_ID").alias("Trips"))


def trip_shift_hours(trips: DataFrame, lines: DataFrame) -> DataFrame:
    """Each trip's hours, and how they divide into day and night."""
    ends = lines.groupBy("Trip_ID").agg(F.max("Delivered").alias("Delivered"))
    return with_shift_hours(trips.select("Trip_ID", "Trip_Date").join(ends, "Trip_ID"), "Trip_Date", "Delivered") \
        .select(F.col("Trip_ID").alias("DD_Trip_ID"), date_key("Trip_Date").alias("Date_SKey"), "Total_Hours", "Day_Hours", "Night_Hours")


def seasonal_demand(volume: DataFrame) -> DataFrame:
    """Seasonal demand of each commodity from its monthly tonnage (``volume_by_commodity``).

    Months without a trip count as 0: a spine of all months from the first to the last of the
    whole data stands under every commodity.  Trend: the centred average of twelve months (the
    thirteen around a month, the outer two by half), where all thirteen are in the data.  Ratio:
    tonnage over trend.  Seasonal_Index: a commodity's mean ratio of a calendar month, scaled so
    that its indices average 1 over the calendar months seen; NULL where no month has a trend.
    Windows run per commodity over months, which the calendar bounds."""
    m = F.floor(F.col("Month_Key") / 100).cast(INT) * 12 + F.col("Month_Key") % 100 - 1
    months = volume.where(F.col("Month_Key").isNotNull()).select("Commodity", m.alias("__m"), "Tonnage")
    span = months.agg(F.min("__m"), F.max("__m")).first()
    if span[0] is None:
        months = months.limit(0)
    spine = months.select("Commodity").distinct().withColumn(
        "__m", F.explode(F.sequence(F.lit(span[0] or 0), F.lit(span[1] or 0))))
    seen = months.select(F.col("Commodity").alias("__c"), F.col("__m").alias("__k"), "Tonnage")
    dense = spine.join(seen, F.col("Commodity").eqNullSafe(F.col("__c")) & (F.col("__m") == F.col("__k")), "left") \
        .select("Commodity", "__m", F.coalesce("Tonnage", F.lit(0).cast(DEC18_2)).alias("Tonnage"))
    w = Window.partitionBy("Commodity").orderBy("__m")
    wide, narrow = w.rangeBetween(-6, 6), w.rangeBetween(-5, 5)
    # 24 x the centred average
    twice = F.when(F.count(F.lit(1)).over(wide) == 13, F.sum("Tonnage").over(wide) + F.sum("Tonnage").over(narrow))
    dense = dense.withColumn("__24", twice.cast(DEC18_2)) \
        .withColumn("Trend", scaled_to_decimal(div_half_up((F.col("__24") * 100).cast("long"), F.lit(24)), 2)) \
        .withColumn("Ratio", safe_ratio(F.col("Tonnage") * 24, F.col("__24")))
    index = dense.groupBy("Commodity", (F.col("__m") % 12 + 1).alias("__moy")).agg(
        safe_ratio(F.sum("Ratio"), F.count("Ratio"), in_scale=4).alias("__raw"))
    every = Window.partitionBy("Commodity")
    index = index.withColumn("Seasonal_Index", safe_ratio(F.col("__raw") * F.count("__raw").over(every), F.sum("__raw").over(every),
                                                          in_scale=4))
    index = index.select(F.col("Commodity").alias("__c"), "__moy", "Seasonal_Index")
    key = (F.floor(F.col("__m") / 12) * 100 + F.col("__m") % 12 + 1).cast(INT).alias("Month_Key")
    return dense.join(index, F.col("Commodity").eqNullSafe(F.col("__c")) & (F.col("__m") % 12 + 1 == F.col("__moy"))) \
        .select("Commodity", key, "Tonnage", "Trend", "Ratio", "Seasonal_Index")


def drill_across(util: DataFrame, profit: DataFrame) -> DataFrame:
    """Two facts of different grain on the conformed month: aggregate each to the month
    first, then FULL OUTER JOIN - no row of either fact is repeated."""
    month = (F.floor(F.col("Date_SKey") / 100)).cast(INT)
    u = util.groupBy(month.alias("Month_Key")).agg(
        F.sum("Trips_Count_Daily").alias("Vehicle_Trips"),
        F.sum("Distance_KM_Daily").cast(DEC18_2).alias("Distance_KM"),
        F.sum("Running_Hours").cast(DEC18_2).alias("Running_Hours"))
    p = profit.groupBy(month.alias("__m")).agg(
        F.count(F.lit(1)).alias("Billed_Trips"),
        F.sum("Gross_Revenue_INR").cast(DEC18_2).alias("Gross_Revenue_INR"),
        F.sum("Net_Profit_INR").cast(DEC18_2).alias("Net_Profit_INR"))
    j = u.join(p, u.Month_Key == p["__m"], "full_outer")
    return j.select(F.coalesce("Month_Key", "__m").alias("Month_Key"), "Vehicle_Trips", "Distance_KM",
                    "Running_Hours", "Billed_Trips", "Gross_Revenue_INR", "Net_Profit_INR")


def fact_logistics_operations(trips: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], keys: dict) -> DataFrame:
    """Trip activity, one row per trip with lines: weight, distance, duration, conformed keys."""
    # Written: the lookups count it by key and time before they use it.
    base = written(trips.join(trip_totals(lines), "Trip_ID").select(
        F.col("Trip_ID").alias("DD_Trip_ID"), date_key("Trip_Date").alias("Date_SKey"), "Customer_ID", "Address_ID",
        "Vehicle_ID", "Trip_Date", "Driver_ID", "Branch_ID", "Trip_Type", "Commodity",
        F.col("Weight").alias("Cargo_Weight_Tons"), F.col("Distance").alias("Trip_Distance_KM"),
        hours_between("Trip_Date", "Delivered").alias("Trip_Duration_Hours")), "trips")
    return with_keys(base, dims, keys, "Trip_Date").drop("Trip_Date", "Address_ID", "Driver_ID", "Branch_ID", "Trip_Type", "Commodity")


def licence_expiry_check(trips: DataFrame, drivers: DataFrame, trip_driver: str = "DriverID",
                         trip_time: str = "TripDate") -> DataFrame:
    """Trips driven after the driver's licence expired (join on driver, then filter)."""
    d = drivers.select("Driver_ID", "License_Number", "License_Expiry_Date")
    d, _ = broadcast_if_small(d)
    j = trips.join(d, trips[trip_driver] == d["Driver_ID"])
    return j.filter(F.col(trip_time) > F.col("License_Expiry_Date")) \
            .select("TripID", trip_driver, trip_time, "License_Number", "License_Expiry_Date")
