"""Atomic publishing of table versions with their watermark (the transaction of the loads).

Layout under a warehouse root::

    <root>/<TABLE>/v=<run id>/...        immutable data written by one load
    <root>/<TABLE>/_manifest.json        the table: data folders + watermark + max key

A load writes a new ``v=`` folder, then replaces the manifest in one write.  Readers resolve
the table through the manifest only, so a failed load (anything before the manifest write)
leaves the previous version and watermark in place.  Data folders are never overwritten.

* SCD2 dimensions keep history append-only: an increment writes the closed/ended versions to
  a new ``hist`` folder and the new current set to ``cur``; older history folders stay listed.
* Facts are laid out by month of the event time; an increment rewrites only the months that
  hold a deleted trip id or a new row and re-points those months in the manifest.  Where nothing
  can be deleted (a backfill's slices) it rewrites none: its months are listed beside those there.
"""
from __future__ import annotations

import datetime as _dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import mark_files
from ..operators.sizing import broadcast_if_small
from ..schemas import WATERMARK_SCHEMA, DimSpec, FactSpec

MANIFEST = "_manifest.json"
MONTH_COL = "__month"
CURRENT_COL = "__current"


# --- storage primitives (any Hadoop file system; a path without a scheme is the default one's) --

def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path qualified by it."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hpath)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file as a whole: readers see the old text or the new one."""
    fs, hpath = _fs(spark, path)
    if fs.getScheme() == "file":
        p = hpath.toUri().getPath()
        os.makedirs(os.path.dirname(p), exist_ok=True)
        tmp = f"{p}.tmp-{uuid.uuid4().hex}"
        with open(tmp, "w") as f:
            f.write(text)
        os.replace(tmp, p)                       # atomic rename on a POSIX file system
        return
    jvm = spark._jvm
    renames = fs.getScheme() in ("hdfs", "viewfs")
    target = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex}") if renames else hpath
    out = fs.create(target, True)                # one PUT on object stores: atomic replace
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if renames:
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), spark._jsc.hadoopConfiguration()) \
            .rename(target, hpath, overwrite)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()] if fs.exists(hpath) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


# --- manifests ---------------------------------------------------------------------------

def table_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_manifest(spark: SparkSession, root: str, table: str) -> dict | None:
    text = _read_text(spark, f"{table_dir(root, table)}/{MANIFEST}")
    return json.loads(text) if text else None


def write_manifest(spark: SparkSession, root: str, table: str, manifest: dict) -> None:
    _write_text(spark, f"{table_dir(root, table)}/{MANIFEST}", json.dumps(manifest, indent=1, sort_keys=True))


def new_version(root: str, table: str) -> str:
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{table_dir(root, table)}/v={stamp}-{uuid.uuid4().hex[:8]}"


def read_table(spark: SparkSession, root: str, table: str, schema=None) -> DataFrame:
    """The current version of a table, resolved through its manifest."""
    m = read_manifest(spark, root, table)
    if m is None:
        raise FileNotFoundError(f"table {table} has no published version under {root}")
    paths = m["paths"] if isinstance(m["paths"], list) else list(m["paths"].values())
    if not paths:                                # a published table without a row
        return spark.createDataFrame([], T.StructType.fromJson(json.loads(m["schema"])))
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    return mark_files(df.select(*m["columns"]))


def read_watermarks(spark: SparkSession, root: str, tables) -> DataFrame:
    """The watermark table: one row per published table (read from the manifests)."""
    rows = []
    for t in tables:
        m = read_manifest(spark, root, t)
        if m is not None:
            rows.append((t, _dt.datetime.fromisoformat(m["watermark"]), _dt.datetime.fromisoformat(m["updated_at"])))
    return spark.createDataFrame(rows, WATERMARK_SCHEMA)


def later(a: str, b: str) -> str:
    """The later of two dates given as ISO text."""
    return max(a, b, key=_dt.datetime.fromisoformat)


def _manifest(old, table, version, paths, schema, watermark, now, max_key, extra=None) -> dict:
    """The next manifest.  ``extra["streams"]`` holds the last batch applied per stream; those
    of the manifest before are carried on by every publish.

    The watermark never goes back: a run with an older cutoff leaves it where it is, so the next
    increment does not apply rows again.  (To load an older state of a source, drop the table's
    manifest first.)"""
    watermark = later(old["watermark"], watermark) if old else watermark
    extra = dict(extra or {})
    streams = {**(old or {}).get("streams", {}), **extra.pop("streams", {})}
    if streams:
        extra["streams"] = streams
    return {"table": table, "version": version, "paths": paths, "columns": schema.names, "schema": schema.json(),
            "watermark": watermark, "updated_at": now, "max_key": max_key, **extra}


def _ledger(old: dict) -> dict:
    """The backfill ledger goes on through increments (a full load starts without one)."""
    return {"backfill": old["backfill"]} if "backfill" in old else {}


def _max_key(df: DataFrame, key: str) -> int:
    v = df.agg(F.max(key)).first()[0]
    return max(int(v or 0), 0)


# --- publish operations -------------------------------------------------------------------

def publish_full(df: DataFrame, root: str, table: str, key: str, watermark: str, now: str,
                 partition_by: list[str] | None = None, extra: dict | None = None) -> dict:
    """TRUNCATE + INSERT + watermark, atomically: new version, then the manifest."""
    spark = df.sparkSession
    version = new_version(root, table)
    w = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    written = spark.read.parquet(version)
    m = _manifest(read_manifest(spark, root, table), table, version, [version], df.schema, watermark, now,
                  _max_key(written, key), extra)
    write_manifest(spark, root, table, m)
    return m


def _write_by_currency(rows: DataFrame, version: str) -> tuple[str | None, str | None]:
    """Write versions once, ended and current ones in a folder each (None: no such row)."""
    rows.withColumn(CURRENT_COL, F.col("IsCurrent")).write.mode("errorifexists").option("compression", "zstd").partitionBy(CURRENT_COL).parquet(version)
    written = set(_folders(rows.sparkSession, version))
    return tuple(f"{version}/{name}" if name in written else None
                 for name in (f"{CURRENT_COL}=false", f"{CURRENT_COL}=true"))


def publish_scd2_full(dim: DataFrame, root: str, spec: DimSpec, watermark: str, now: str,
                      extra: dict | None = None) -> dict:
    """Full SCD2 publish, split into history (ended versions) and the current set."""
    spark = dim.sparkSession
    version = new_version(root, spec.table)
    hist, cur = _write_by_currency(dim, version)
    paths = {k: v for k, v in (("hist0", hist), ("cur", cur)) if v}
    mk = _max_key(spark.read.parquet(*paths.values()), spec.sk) if paths else 0
    m = _manifest(read_manifest(spark, root, spec.table), spec.table, version, paths, dim.schema, watermark, now, mk, extra)
    write_manifest(spark, root, spec.table, m)
    return m


def publish_scd2_increment(closed: DataFrame, inserted: DataFrame, root: str, spec: DimSpec,
                           watermark: str, now: str, extra: dict | None = None) -> dict:
    """Publish an increment without rewriting history.

    ``closed``/``inserted`` come from ``scd2_inc_parts``.  Versions that end now (closed
    current rows, and inserted rows already superseded within the batch) go to a new history
    folder; the rest form the new current set.  Old history folders stay listed as they are.
    """
    spark = closed.sparkSession
    old = read_manifest(spark, root, spec.table)
    old_hist = {k: v for k, v in old["paths"].items() if k.startswith("hist")}
    version = new_version(root, spec.table)
    rows = closed.unionByName(inserted)
    hist, cur = _write_by_currency(rows, version)
    new = {k: v for k, v in ((f"hist{len(old_hist)}", hist), ("cur", cur)) if v}
    mk = max(_max_key(spark.read.parquet(*new.values()), spec.sk) if new else 0, old.get("max_key", 0))
    m = _manifest(old, spec.table, version, {**old_hist, **new}, rows.schema, watermark, now, mk, {**_ledger(old), **(extra or {})})
    write_manifest(spark, root, spec.table, m)
    return m


def _with_month(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn(MONTH_COL, (F.year(time_col) * 100 + F.month(time_col)).cast("int"))


def _month_of(key: str) -> str:
    """The month of an entry in a fact's manifest: ``202001``, or ``202001+2`` for rows added later."""
    return key.split("+")[0]


def _added(old: dict, written: dict) -> dict:
    """Entry of each month written, beside those the manifest has."""
    nth = {m: sum(_month_of(k) == m for k in old["paths"]) for m in written}
    return {m: f"{m}+{n}" if n else m for m, n in nth.items()}


def _month_dirs(spark: SparkSession, version: str) -> dict[str, str]:
    """Month -> folder for the months a version wrote (none, if it had no row)."""
    months = [f.split("=", 1)[1] for f in _folders(spark, version) if f.startswith(f"{MONTH_COL}=")]
    return {"None" if m == "__HIVE_DEFAULT_PARTITION__" else m: f"{version}/{MONTH_COL}={m}" for m in months}


def _month_stats(spark: SparkSession, version: str, spec: FactSpec) -> tuple[int, dict[str, list]]:
    """(highest key, month -> [lowest, highest id]) of what a version wrote: one row per month."""
    rows = spark.read.parquet(version).groupBy(MONTH_COL).agg(
        F.max(spec.sk), F.min(spec.id_col), F.max(spec.id_col)).collect()
    return max([max(int(r[1] or 0), 0) for r in rows], default=0), {str(r[0]): [r[2], r[3]] for r in rows}


def months_that_may_hold(manifest: dict, ids: DataFrame) -> list[str]:
    """Months of a published fact whose id range holds some id of ``ids`` (column __id): one
    aggregate with a flag per month.  Months without a recorded range may hold any id."""
    ranges = manifest.get("ids", {})
    unknown = [k for k in manifest["paths"] if k not in ranges]
    known = [k for k in manifest["paths"] if k in ranges and ranges[k][0] is not None]
    if not known:
        return unknown
    hit = ids.agg(*[F.max(F.col("__id").between(*ranges[k])).alias(f"m{i}") for i, k in enumerate(known)]).first()
    return unknown + [k for i, k in enumerate(known) if hit[i]]


def publish_fact_full(fact: DataFrame, root: str, spec: FactSpec, watermark: str, now: str,
                      extra: dict | None = None) -> dict:
    """Full fact publish laid out by month of the event time."""
    spark = fact.sparkSession
    version = new_version(root, spec.table)
    _with_month(fact, spec.time_col).write.mode("errorifexists").option("compression", "zstd").partitionBy(MONTH_COL).parquet(version)
    months = _month_dirs(spark, version)
    mk, ids = _month_stats(spark, version, spec) if months else (0, {})
    m = _manifest(read_manifest(spark, root, spec.table), spec.table, version, months, fact.schema, watermark, now, mk,
                  {**(extra or {}), "ids": ids})
    write_manifest(spark, root, spec.table, m)
    return m


def publish_fact_increment(stg: DataFrame | None, new_rows: DataFrame, root: str, spec: FactSpec,
                           watermark: str, now: str, extra: dict | None = None) -> dict:
    """Delete-by-id + insert, rewriting only the affected months; without ``stg`` only an insert,
    whose rows are added: nothing that is there is read or written again.

    The manifest knows the id range of every month, so only months that may hold a staged id are
    opened.  Affected are those of them that do (a semi join against the staged ids: the event
    time can change between versions of a trip, so months are *not* taken from the batch) and the
    months of the new rows.  Their number is bounded by the calendar span, so the list is
    collected to the driver; rows are never collected.
    """
    spark = new_rows.sparkSession
    old = read_manifest(spark, root, spec.table)
    old_paths = old["paths"]
    if stg is None:
        return _publish_fact_rows(new_rows, root, spec, watermark, now, old, extra)
    hit_months = set()
    ids = stg.select(F.col(spec.id_col).alias("__id")).filter(F.col("__id").isNotNull()).distinct()
    ids, _ = broadcast_if_small(ids)          # measured; else a shuffle semi join
    opened = months_that_may_hold(old, ids)
    if opened:
        span = ids.agg(F.min("__id"), F.max("__id")).first()
        current = spark.read.parquet(*[old_paths[k] for k in opened]).select(*old["columns"])
        near = current.where(F.col(spec.id_col).between(span[0], span[1]))      # skips row groups
        hit = near.join(ids, near[spec.id_col] == ids["__id"], "left_semi")
        hit_months = {r[0] for r in _with_month(hit, spec.time_col).select(MONTH_COL).distinct().collect()}
    new_months = {r[0] for r in _with_month(new_rows, spec.time_col).select(MONTH_COL).distinct().collect()}
    keys = {str(m) for m in hit_months | new_months}
    kept_dirs = [old_paths[k] for k in sorted(old_paths) if _month_of(k) in keys]
    version = new_version(root, spec.table)
    rewrite = new_rows.select(*old["columns"])
    if kept_dirs:
        kept = spark.read.parquet(*kept_dirs).select(*old["columns"])
        kept = kept.join(ids, kept[spec.id_col] == ids["__id"], "left_anti")
        rewrite = kept.unionByName(rewrite)
    _with_month(rewrite, spec.time_col).write.mode("errorifexists").option("compression", "zstd").partitionBy(MONTH_COL).parquet(version)
    written = _month_dirs(spark, version)
    paths = {k: v for k, v in old_paths.items() if _month_of(k) not in keys}
    paths.update(written)
    mk, ranges = _month_stats(spark, version, spec) if written else (0, {})
    ranges = {**{k: v for k, v in old.get("ids", {}).items() if k in paths}, **ranges}
    m = _manifest(old, spec.table, version, paths, new_rows.select(*old["columns"]).schema, watermark, now,
                  max(mk, old.get("max_key", 0)),
                  {**_ledger(old), **(extra or {}), "ids": ranges, "increment": {"opened": sorted({_month_of(k) for k in opened}), "rewritten": sorted(keys)}})
    write_manifest(spark, root, spec.table, m)
    return m


def _publish_fact_rows(new_rows: DataFrame, root: str, spec: FactSpec, watermark: str, now: str, old: dict,
                       extra: dict | None) -> dict:
    """Publish rows in addition to what the table holds."""
    spark, version = new_rows.sparkSession, new_version(root, spec.table)
    rows = new_rows.select(*old["columns"])
    _with_month(rows, spec.time_col).write.mode("errorifexists").option("compression", "zstd").partitionBy(MONTH_COL).parquet(version)
    written = _month_dirs(spark, version)
    mk, ranges = _month_stats(spark, version, spec) if written else (0, {})
    entry = _added(old, written)
    m = _manifest(old, spec.table, version, {**old["paths"], **{entry[k]: v for k, v in written.items()}}, rows.schema, watermark, now,
                  max(mk, old.get("max_key", 0)),
                  {**_ledger(old), **(extra or {}), "ids": {**old.get("ids", {}), **{entry[k]: v for k, v in ranges.items() if k in entry}},
                   "increment": {"opened": [], "rewritten": []}})
    write_manifest(spark, root, spec.table, m)
    return m
