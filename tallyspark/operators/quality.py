"""Declared constraints as data-quality checks (file tables enforce none).

Each check returns the violating keys (or one row of counts), never the
whole table, and runs as one aggregate or anti join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., n, problem): keys seen more than once, and rows with a NULL key part."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | any_null)
    return counted.withColumn("problem", F.when(any_null, "null").otherwise("duplicate"))


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """(value, n): non-NULL values held by more than one row (NULLs may repeat)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def not_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_null) for each column, from one pass over the table."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stacked}) as (`column`, n_null)")


def foreign_key_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row.  Parent keys are folded before the shuffle: nothing here relies on
    their being unique, and the anti join cannot split its right side."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(p, F.col(fk) == p["_pk"], "left_anti")
