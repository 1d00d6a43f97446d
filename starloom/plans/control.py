"""Control plane: control and watermark tables, load tiers, the tier runner.

The control tables are a handful of rows; they drive a driver-side loop over *table loads*
(each load is a distributed Spark job).  No data passes through the driver.
"""
from __future__ import annotations

import concurrent.futures as cf
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ts_lit
from ..operators.ordered import materialized_mark, release_materialized
from ..schemas import CONTROL_SCHEMA, EPOCH, WATERMARK_SCHEMA

# Seed rows of the two control tables (fixed values of the contract):
# (TABLENAME, STAGINGTABLENAME, LOADTYPE, LOADORDER)
CONTROL_ROWS = [
    ("EMPLOYEE", "employee", "SCD1", 1),
    ("DRIVER", "driver", "SCD1", 1),
    ("TRUCK", "truck", "SCD1", 1),
    ("CUSTOMER", "customer", "SCD2", 2),
    ("PRODUCT", "product", "SCD2", 2),
    ("VENDOR", "vendor", "SCD2", 2),
    ("FACTTRIP", "facttrip", "FACT", 3),
]


def control_seed(spark: SparkSession, mode: str = "full") -> DataFrame:
    """The full or incremental control table.  Loads dispatch on LOADTYPE, never on the
    procedure name (the incremental names in the seed do not match the procedures)."""
    prefix = "etl.usp_full_load_" if mode == "full" else "etl.usp_inc_load_"
    rows = [("gold_tables", t, "staging", s, prefix + s, lt, order, True) for t, s, lt, order in CONTROL_ROWS]
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def watermark_seed(control: DataFrame) -> DataFrame:
    """One row per control row at 1900-01-01 (seeded *after* the control table is filled)."""
    return control.select("TABLENAME", ts_lit(EPOCH).alias("LAST_WATERMARK_DATE"),
                          ts_lit(EPOCH).alias("LAST_UPDATETIME"))


def load_tiers(control: DataFrame) -> list[int]:
    """``SELECT DISTINCT LOADORDER ... WHERE ISACTIVE ORDER BY LOADORDER``."""
    return [r.LOADORDER for r in control.filter(F.col("ISACTIVE")).select("LOADORDER")
            .distinct().orderBy("LOADORDER").collect()]


def control_active_tier(control: DataFrame, tier: int) -> DataFrame:
    return control.filter((F.col("LOADORDER") == tier) & F.col("ISACTIVE"))


def watermark_lookup(watermarks: DataFrame, table: str):
    """Last watermark of one table (first row), or the epoch when none is stored."""
    row = watermarks.filter(F.col("TABLENAME") == table).select("LAST_WATERMARK_DATE").head()
    return row[0] if row else dt.datetime.fromisoformat(EPOCH)


def next_watermark(delta: DataFrame, date_col: str, now: str) -> DataFrame:
    """``ISNULL(MAX(ModifiedDate), now)``: one global aggregate, partial per task."""
    return delta.agg(F.coalesce(F.max(date_col), ts_lit(now)).alias("NEXT_WATERMARK"))


def run_tiers(control: DataFrame, load: Callable[[dict], object], max_parallel: int = 3,
              pool_prefix: str = "tier") -> list[dict]:
    """Run every active table load tier by tier; loads in a tier run concurrently in driver
    threads (their Spark jobs share the cluster; FAIR pools if the scheduler is FAIR).
    A failure stops the run after the current tier, and nothing later is started."""
    spark = control.sparkSession
    done = []
    for tier in load_tiers(control):
        rows = [r.asDict() for r in control_active_tier(control, tier).orderBy("TABLENAME").collect()]
        errors, mark = [], materialized_mark()

        def run_one(row, tier=tier):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool_prefix}{tier}")
            try:
                return load(row)
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

        with cf.ThreadPoolExecutor(max_workers=max_parallel) as ex:
            futs = {ex.submit(run_one, r): r for r in rows}
            for fut in cf.as_completed(futs):
                try:
                    fut.result()
                    done.append(futs[fut])
                except Exception as e:  # noqa: BLE001
                    errors.append((futs[fut]["TABLENAME"], e))
        release_materialized(mark)      # no load of this tier is running any more
        if errors:
            name, err = errors[0]
            raise RuntimeError(f"load of {name} failed in tier {tier}: {err}") from err
    return done


__all__ = ["CONTROL_SCHEMA", "WATERMARK_SCHEMA", "control_seed", "watermark_seed", "load_tiers",
           "control_active_tier", "watermark_lookup", "next_watermark", "run_tiers"]
