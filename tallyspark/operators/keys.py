"""Gap-free sequential keys (identity column ``START WITH n INCREMENT BY 1``)
without funnelling the table through one partition.

1. ``orderBy`` range-partitions and sorts: partition *p* holds a contiguous,
   sorted slice of the key order (a per-row tiebreaker keeps a hot key from
   landing in one partition).
2. The position inside the slice is the low 33 bits of
   ``monotonically_increasing_id`` (documented layout: partition id in the upper
   bits, record number within the partition in the lower 33 bits).
3. The slice assignment is made durable with ``checkpoint()`` (reliable, in the
   session's checkpoint folder), so a re-run task cannot move rows between slices.
4. Per-slice counts (one row per partition: a bounded, broadcastable table)
   give each slice its offset; ``id = start + offset + position``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import shuffles_removed

LOW_BITS = 33


def place_rows(df: DataFrame, order: list[str | Column] | None = None, path: str | None = None) -> DataFrame:
    """Rows with a durable place (``_pid``, ``_pos``): in ``order`` when given (one range shuffle and a local sort), else in the
    existing partition order (no shuffle).  Written to ``path``, which the caller removes after use, or checkpointed."""
    base = df
    if order:
        # ties may be numbered in any order: a per-row tiebreaker lets the range
        # partitioner split a hot sort key (or many identical rows) over partitions
        base = (base.withColumn("_tb", F.monotonically_increasing_id())
                .orderBy(*order, "_tb").drop("_tb"))
    placed = (base.withColumn("_pid", F.spark_partition_id().cast("long"))
              .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid"), LOW_BITS)))
    if path is None:
        return placed.checkpoint(eager=True)
    with shuffles_removed(df.sparkSession):
        placed.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def number_rows(placed: DataFrame, id_col: str, ranges: list[tuple[int, int | None]]) -> DataFrame:
    """Placed rows with ids from ``ranges`` of (first id, count), one after the other; a count of None is without end."""
    cols = [c for c in placed.columns if c not in ("_pid", "_pos")]
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    at, used, number = F.col("_off") + F.col("_pos"), 0, F.lit(None).cast("long")
    for first, count in ranges:
        inside = (at >= used) & (at < used + count if count is not None else F.lit(True))
        number = F.when(inside, F.lit(first - used).cast("long") + at).otherwise(number)
        used += count or 0
    numbered = placed.join(F.broadcast(offsets), "_pid")  # one row a partition
    return numbered.select(number.alias(id_col), *cols)


def assign_index(df: DataFrame, id_col: str = "_idx", order: list[str | Column] | None = None,
                 start: int = 0) -> DataFrame:
    """Gap-free index ``start, start+1, …``, in ``order`` when given."""
    return number_rows(place_rows(df.select(*[c for c in df.columns if c != id_col]), order), id_col, [(start, None)])


def assign_sequential_ids(df: DataFrame, order: list[str | Column], start: int = 1001,
                          id_col: str = "id") -> DataFrame:
    """Identity-style keys from ``start`` in the given order (ties: any order)."""
    return assign_index(df, id_col=id_col, order=order, start=start)


def next_start(existing: DataFrame, id_col: str = "id", default: int = 1001) -> int:
    """First free id after the existing rows (one scalar to the driver)."""
    row = existing.agg(F.max(id_col).alias("m")).first()
    return default if row is None or row["m"] is None else int(row["m"]) + 1
