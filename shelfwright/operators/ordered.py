"""Row numbers and previous-row lookups over a whole table, safe when one key dominates.

A window partitioned by the key would put all rows of a hot key into one task, and a window without
a key would put the whole table there. Instead the table is range-sorted once (ties of the key are
split over slices by the rest of the order), each slice is handled on its own, and only one summary
row per slice travels to join the slices up.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwright.session import durable

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _sliced(df: DataFrame, order: list[str], shifted: dict[str, str] | None = None) -> DataFrame:
    """``df`` range-sorted by ``order`` with slice number and position inside the slice. ``shifted`` names columns and
    what to call their values of the row before in the slice; they are carried along the sorted rows, without a shuffle.

    Written to the checkpoint folder, so that every later use sees the same slices even when a
    machine is lost half-way.
    """
    row = F.monotonically_increasing_id()
    rows = df.orderBy(*order)
    if shifted:
        rows = _with_row_before(rows, shifted)
    return durable(
        rows.withColumn("_row", row)
        .withColumn("_slice", F.shiftright("_row", _POSITION_BITS))
        .withColumn("_pos", F.col("_row") - F.shiftleft("_slice", _POSITION_BITS))
        .drop("_row")
    )


def _with_row_before(df: DataFrame, shifted: dict[str, str]) -> DataFrame:
    copied = df.select("*", *[F.col(c).alias(name) for c, name in shifted.items()])
    names = list(shifted.values())

    def run(batches):
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = []
            for name in batch.schema.names:
                column = batch.column(name)
                if name in names:
                    first = carried[name] if carried else pa.nulls(1, column.type)
                    column = pa.concat_arrays([first, column.slice(0, batch.num_rows - 1)])
                columns.append(column)
            carried = {name: batch.column(name).slice(batch.num_rows - 1) for name in names}
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return copied.mapInArrow(run, copied.schema)


def _slice_window() -> Window:
    # over summaries: one row per slice, never more rows than there are shuffle partitions
    return Window.partitionBy(F.lit(0)).orderBy("_slice")


def with_row_number(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """Dense 1-based numbers in ``order``, which must be unique for a repeatable result."""
    sliced = _sliced(df, order)
    before = F.coalesce(
        F.sum("n").over(_slice_window().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = (
        sliced.groupBy("_slice").agg(F.count("*").alias("n")).select("_slice", before.alias("_from"))
    )
    # broadcast is bounded: one row per slice
    return (
        sliced.join(F.broadcast(starts), "_slice")
        .withColumn(name, (F.col("_from") + F.col("_pos") + 1).cast("bigint"))
        .drop("_slice", "_pos", "_from")
    )


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "previous"
) -> DataFrame:
    """``value`` of the row before, in ``order``, among the rows with the same ``keys``. The first row of a slice gets
    its row before from the summary of the slices."""
    names = {c: f"_before_{c}" for c in dict.fromkeys([*keys, value])}
    sliced = _sliced(df, [*keys, *order], names)
    here = F.struct(*names)
    last = sliced.groupBy("_slice").agg(F.max_by(here, "_pos").alias("_last"))
    carried = last.select("_slice", F.lag("_last").over(_slice_window()).alias("_carried"))
    # broadcast is bounded: one row per slice
    joined = sliced.join(F.broadcast(carried), "_slice")
    inside = F.struct(*[F.col(name).alias(c) for c, name in names.items()])
    before = F.when(F.col("_pos") == 0, F.col("_carried")).otherwise(inside)
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"_before.{key}").eqNullSafe(F.col(key))
    return (
        joined.withColumn("_before", before)
        .withColumn(name, F.when(same, F.col(f"_before.{value}")))
        .drop("_slice", "_pos", "_carried", "_before", *names.values())
    )
