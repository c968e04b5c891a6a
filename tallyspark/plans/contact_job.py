"""Contact migration job: truncate the target, load the per-country files in
one parallel scan, report the running row count per country and the declared
constraint checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators.migrate import contacts_to_target, running_load_counts
from tallyspark.operators.quality import not_null_counts, unique_violations
from tallyspark.sinks import write_overwrite
from tallyspark.sources import read_contacts


@dataclass
class ContactLoad:
    loaded: int
    target_path: str
    running_counts: DataFrame
    null_counts: DataFrame
    duplicates: dict


def run_contact_load(spark: SparkSession, paths: list[str], target_path: str, run_ts) -> ContactLoad:
    stage = read_contacts(spark, paths)
    loaded = write_overwrite(contacts_to_target(stage, run_ts), target_path)
    target = spark.read.parquet(target_path)
    return ContactLoad(
        loaded=loaded, target_path=target_path,
        running_counts=running_load_counts(target, "country"),
        null_counts=not_null_counts(target, S.CONTACT_NOT_NULL),
        duplicates={c: unique_violations(target, c) for c in S.CONTACT_UNIQUE})


def constraint_report(load: ContactLoad) -> DataFrame:
    """(kind, column_name, n): NULLs of each NOT NULL column, repeated values of each UNIQUE column."""
    out = load.null_counts.select(F.lit("not_null").alias("kind"), F.col("column").alias("column_name"), F.col("n_null").alias("n"))
    for column, repeated in load.duplicates.items():
        counted = repeated.agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(counted.select(F.lit("unique").alias("kind"), F.lit(column).alias("column_name"), "n"))
    return out
