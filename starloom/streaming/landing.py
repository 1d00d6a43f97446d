"""Daily landing files applied as a stream: file-source ``readStream`` ->
``foreachBatch(increment + publish)`` with ``trigger(availableNow=True)``.

Each micro-batch is one increment of a dimension or of the fact, in file arrival order.  The manifest records
the last applied batch id of each stream, so a batch replayed after a failure (foreachBatch is at-least-once)
is skipped: the table and its watermark change exactly once per batch.  The stream's own
checkpoint (``checkpoint_location``, on shared storage) remembers which files were consumed.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import fact as fact_ops
from ..operators import scd1, scd2
from ..operators.keys import dense_key
from ..operators.ordered import materialized_mark, release_materialized
from ..plans import publish as P
from ..plans.loads import check_keys
from ..schemas import DimSpec, FactSpec


def run_landing_stream(spark: SparkSession, landing: str, schema: T.StructType,
                       on_batch: Callable[[DataFrame, int], None], checkpoint_location: str,
                       max_files_per_trigger: int | None = None, fmt: str = "parquet") -> None:
    """Consume every file available now, one micro-batch at a time, then stop."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.load(landing).writeStream
                   .foreachBatch(on_batch)
                   .option("checkpointLocation", checkpoint_location)
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()


def dimension_batch_loader(root: str, spec: DimSpec, now: str, stream_id: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: apply the batch as an increment of ``spec`` and publish it.

    ``stream_id`` names the stream that the batch ids belong to (its checkpoint location, say):
    a stream that starts anew counts from 0 again and is another stream.  The watermark advances
    to the batch's newest change date and never goes back.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark, mark = batch.sparkSession, materialized_mark()
        old = P.read_manifest(spark, root, spec.table)
        if old is None:
            raise RuntimeError(f"{spec.table}: publish a full load before streaming increments")
        if old.get("streams", {}).get(stream_id, -1) >= epoch_id:
            return                                  # replay of an applied batch
        batch = batch.persist()                     # landed files are read once
        try:
            batch = check_keys(batch, [spec.bk], spec.table)
            newest = batch.agg(F.max(spec.date_col)).first()[0]
            watermark = P.later(old["watermark"], str(newest)) if newest is not None else old["watermark"]
            target = P.read_table(spark, root, spec.table)
            extra = {"streams": {stream_id: epoch_id}}
            if spec.scd == 2:
                closed, inserted = scd2.scd2_inc_parts(target, batch, spec, base=old["max_key"])
                P.publish_scd2_increment(closed, inserted, root, spec, watermark, now, extra)
            else:
                P.publish_full(scd1.scd1_merge(target, batch, spec, base=old["max_key"]), root, spec.table, spec.sk,
                               watermark, now, extra=extra)
        finally:
            batch.unpersist()
            release_materialized(mark)
    return apply


def fact_batch_loader(root: str, spec: FactSpec, now: str, stream_id: str,
                      date_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: trips of the batch replace those of the same id, with keys looked up
    in the published dimensions.  ``date_col`` is the landing files' change date: the watermark
    advances to its newest value and never goes back (without it, the watermark stays)."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark, mark = batch.sparkSession, materialized_mark()
        old = P.read_manifest(spark, root, spec.table)
        if old is None:
            raise RuntimeError(f"{spec.table}: publish a full load before streaming increments")
        if old.get("streams", {}).get(stream_id, -1) >= epoch_id:
            return                                  # replay of an applied batch
        batch = batch.persist()                     # landed files are read once
        try:
            batch = check_keys(batch, [spec.id_col], spec.table)
            newest = batch.agg(F.max(date_col)).first()[0] if date_col else None
            dims = {d.table: P.read_table(spark, root, d.table) for _, d in spec.lookups}
            rows = fact_ops.resolve_keys(batch, dims, spec, now)
            new = dense_key(rows, spec.sk, fact_ops.fact_key_order(spec), start=old["max_key"])
            P.publish_fact_increment(batch, new.select(*spec.gold_columns()), root, spec,
                                     str(newest) if newest is not None else old["watermark"], now,
                                     {"streams": {stream_id: epoch_id}})
        finally:
            batch.unpersist()
            release_materialized(mark)
    return apply
