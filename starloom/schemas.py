"""Table contracts: staging schemas, gold column lists and per-dimension load specs.

T-SQL -> Spark: INT -> int, VARCHAR -> string, DECIMAL(p,s) -> decimal(p,s),
DATETIME -> timestamp_ntz, BIT -> boolean.  Surrogate keys we mint are bigint.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TS = T.TimestampNTZType()
INT = T.IntegerType()
LONG = T.LongType()
STR = T.StringType()
BOOL = T.BooleanType()
DEC18_2 = T.DecimalType(18, 2)
DEC10_2 = T.DecimalType(10, 2)

# Fixed values of the warehouse contract.
EPOCH = "1900-01-01 00:00:00"          # RowStartDateTime when ModifiedDate is NULL; watermark seed
OPEN_END = "9999-12-31 23:59:59"       # readers' stand-in for an open RowEndDateTime
UNKNOWN_END = "9999-12-31 00:00:00"    # RowEndDateTime stored on the -1 member
UNKNOWN_KEY = -1


@dataclass(frozen=True)
class Attr:
    name: str
    dtype: T.DataType
    null_default: object  # value NULL is treated as equal to in the change test


@dataclass(frozen=True)
class DimSpec:
    table: str                 # gold table name, e.g. CUSTOMER
    staging: str               # staging table name, e.g. customer
    bk: str                    # business key column
    sk: str                    # surrogate key column
    attrs: tuple[Attr, ...]
    scd: int                   # 1 or 2
    unknown: dict = field(default_factory=dict)  # attribute values of the -1 member
    date_col: str = "ModifiedDate"

    @property
    def attr_names(self) -> list[str]:
        return [a.name for a in self.attrs]

    def staging_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.bk, INT)]
                            + [T.StructField(a.name, a.dtype) for a in self.attrs]
                            + [T.StructField(self.date_col, TS)])

    def gold_columns(self) -> list[str]:
        if self.scd == 1:
            return [self.sk, self.bk, *self.attr_names, self.date_col]
        return [self.sk, self.bk, *self.attr_names, "RowStartDateTime", "RowEndDateTime", "IsCurrent"]


# Unknown-member attribute values are fixed by the contract.
EMPLOYEE = DimSpec("EMPLOYEE", "employee", "EmployeeID", "EmployeeKey",
                   (Attr("EmployeeName", STR, ""), Attr("Department", STR, "")), 1,
                   {"EmployeeName": "Missing Employee", "Department": "Unknown"})
DRIVER = DimSpec("DRIVER", "driver", "DriverID", "DriverKey",
                 (Attr("DriverName", STR, ""), Attr("LicenseNumber", STR, "")), 1,
                 {"DriverName": "Missing Driver", "LicenseNumber": "Unknown"})
TRUCK = DimSpec("TRUCK", "truck", "TruckID", "TruckKey",
                (Attr("TruckNumber", STR, ""), Attr("Model", STR, "")), 1,
                {"TruckNumber": "Missing Truck", "Model": "Unknown"})
CUSTOMER = DimSpec("CUSTOMER", "customer", "CustomerID", "CustomerKey",
                   (Attr("CustomerName", STR, ""), Attr("Region", STR, "")), 2,
                   {"CustomerName": "Missing Customer", "Region": "Unknown"})
PRODUCT = DimSpec("PRODUCT", "product", "ProductID", "ProductKey",
                  (Attr("ProductName", STR, ""), Attr("Category", STR, ""), Attr("UnitPrice", DEC18_2, 0)), 2,
                  {"ProductName": "Missing Product", "Category": "Unknown", "UnitPrice": 0})
VENDOR = DimSpec("VENDOR", "vendor", "VendorID", "VendorKey",
                 (Attr("VendorName", STR, ""),), 2,
                 {"VendorName": "Missing Vendor"})

# Dimensions the design documents ask for with other SCD types than the scripts (scripts win
# for the seven loaded tables; these variants run the same operators with other parameters).
FLEET_ASSET = DimSpec("FLEET_ASSET", "fleet_asset", "Vehicle_ID", "Fleet_SKey",
                      (Attr("Model", STR, ""), Attr("Ownership_Type", STR, "")), 2,
                      {"Model": "Unknown", "Ownership_Type": "Unknown"})
DRIVER_HISTORY = DimSpec("DRIVER_COMPLIANCE", "driver_history", "Driver_ID", "Driver_SKey",
                         (Attr("License_Number", STR, ""), Attr("Branch", STR, "")), 2,
                         {"License_Number": "Unknown", "Branch": "Unknown"})
VENDOR_DOC = DimSpec("VENDOR_DOC", "vendor", "VendorID", "Vendor_SKey",
                     (Attr("VendorName", STR, ""),), 1, {"VendorName": "Missing Vendor"})
CUSTOMER_DOC = DimSpec("CUSTOMER_DOC", "customer", "CustomerID", "Customer_SKey",
                       (Attr("CustomerName", STR, ""), Attr("Region", STR, "")), 1,
                       {"CustomerName": "Missing Customer", "Region": "Unknown"})

SCD1_DIMS = (EMPLOYEE, DRIVER, TRUCK)
SCD2_DIMS = (CUSTOMER, PRODUCT, VENDOR)
DIMS = {d.table: d for d in SCD1_DIMS + SCD2_DIMS}


@dataclass(frozen=True)
class FactSpec:
    table: str = "FACTTRIP"
    staging: str = "facttrip"
    id_col: str = "TripID"
    sk: str = "TripFactKey"
    time_col: str = "TripDate"
    measures: tuple[str, ...] = ("TripDistance", "Revenue")
    # (staging business key column, dimension) in lookup order
    lookups: tuple[tuple[str, DimSpec], ...] = (
        ("EmployeeID", EMPLOYEE), ("DriverID", DRIVER), ("TruckID", TRUCK),
        ("CustomerID", CUSTOMER), ("ProductID", PRODUCT), ("VendorID", VENDOR))

    def gold_columns(self) -> list[str]:
        return [self.sk, self.id_col, *[d.sk for _, d in self.lookups], *self.measures,
                self.time_col, "LoadDateTime"]


FACTTRIP = FactSpec()

STAGING_FACT_SCHEMA = T.StructType(
    [T.StructField(c, INT) for c in ("TripID", "EmployeeID", "DriverID", "TruckID",
                                     "CustomerID", "ProductID", "VendorID")]
    + [T.StructField("TripDistance", DEC10_2), T.StructField("Revenue", DEC18_2),
       T.StructField("TripDate", TS)])

# Control tables (contract).
CONTROL_SCHEMA = T.StructType([
    T.StructField("TARGET_SCHEMA", STR, False),
    T.StructField("TABLENAME", STR, False),
    T.StructField("STAGING_SCHEMA", STR, False),
    T.StructField("STAGINGTABLENAME", STR, False),
    T.StructField("PROCEDURENAME", STR, False),
    T.StructField("LOADTYPE", STR, True),
    T.StructField("LOADORDER", INT, False),
    T.StructField("ISACTIVE", BOOL, True),
])
WATERMARK_SCHEMA = T.StructType([
    T.StructField("TABLENAME", STR, False),
    T.StructField("LAST_WATERMARK_DATE", TS, False),
    T.StructField("LAST_UPDATETIME", TS, False),
])
LOAD_TYPES = ("SCD1", "SCD2", "FACT")
