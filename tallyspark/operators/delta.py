"""Set operations on POS batches: new lines, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACT_STAMP = "hd_file_extract_date_time"


def new_lines(batch: DataFrame, history: DataFrame, cols: list[str] | None = None, near: list[str] | None = None) -> DataFrame:
    """Distinct batch lines not already in history (``EXCEPT``: set, NULL-safe).

    One group per line over both sides, kept if no member is of history.  Grouping takes NULL as equal to NULL.  Both sides are
    shuffled once and grouped by hash: nothing is sorted and no line is held a second time for a join.  Copies are folded
    *before* the shuffle: a line repeated a million times ships one row per map task instead of a million to one reducer.

    ``near``: some of the columns, by which the new lines are to lie together: a join on just these needs no shuffle of theirs.  Copies
    are then folded behind the shuffle.
    """
    cols = cols or batch.columns
    sides = batch.select(*cols, F.lit(False).alias("_old")).unionByName(history.select(*cols, F.lit(True).alias("_old")))
    if near:
        sides = sides.repartition(*near)
    return sides.groupBy(*cols).agg(F.max("_old").alias("_old")).where(~F.col("_old")).select(*cols)


def archived_history(batch: DataFrame, history: DataFrame) -> DataFrame:
    """History after the archive step: history ∪all (batch EXCEPT history)."""
    return history.unionByName(new_lines(batch, history, cols=history.columns))
