"""Back-fill of member ids as a landing write: the member table by bucket of the id, of which only those buckets are rewritten that
have a member to change.

    <target>/bucket=7/run=<the run that wrote it last>/…

A run looks at the members without an id alone, writes the changed rows in its folder, and copies the buckets that hold
them with the changes put in.  The copies are moved in before the old parts are removed (``files.publish``), and a broken-off
run is finished by the next reader or run.  A run that is repeated finds nothing left to change and touches no file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.files import Files, finish_publications, publish, work_folder
from tallyspark.operators.backfill import BACKFILL_BY, backfill_ids
from tallyspark.sinks import write_overwrite

BUCKET, RUN = "bucket", "run"
SCHEMA = T.StructType([*S.MEMBER_SCHEMA.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(RUN, T.StringType())])


@dataclass
class BackfillRun:
    changed: int
    buckets: int


def land_members(member: DataFrame, target: str, buckets: int) -> int:
    """Write the member table in its first state."""
    placed = member.select(*S.MEMBER_SCHEMA.names).withColumn(BUCKET, F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")).withColumn(RUN, F.lit("first"))
    return write_overwrite(placed.hint("rebalance", BUCKET), target, partition_by=[BUCKET, RUN])


def read_members(spark: SparkSession, target: str) -> DataFrame:
    """The member table with its bucket; what a broken-off run had begun to publish is finished first."""
    finish_publications(spark, target)
    return spark.read.schema(SCHEMA).parquet(target)


def run_backfill(spark: SparkSession, target: str, sources: list[DataFrame], run_dir: str, run_ts, run_id: str, by: str = BACKFILL_BY) -> BackfillRun:
    """Fill in missing member ids from ``sources``, in priority order, and land the change.

    A member that matches a source row without an id keeps none but has its audit columns set, once for each run time."""
    target = target.rstrip("/")
    columns = S.MEMBER_SCHEMA.names
    unfilled = read_members(spark, target).where(F.col("consumerid").isNull() & F.col("email").isNotNull())
    before = unfilled.select(*columns, BUCKET, F.col("lastupdatedat").alias("_at"), F.col("lastupdatedby").alias("_by"))
    after = backfill_ids(before, sources, run_ts, by)
    touched = F.col("consumerid").isNotNull() | ~F.col("lastupdatedat").eqNullSafe(F.col("_at")) | ~F.col("lastupdatedby").eqNullSafe(F.col("_by"))
    changed = write_overwrite(after.where(touched).select(*columns, BUCKET), f"{run_dir}/changed")
    new = spark.read.schema(T.StructType(SCHEMA.fields[:-1])).parquet(f"{run_dir}/changed")
    numbers = [r[0] for r in new.select(BUCKET).distinct().collect()]  # as many as there are buckets, at most
    if not numbers:
        return BackfillRun(0, 0)
    files = Files(spark)
    old = [p.path for b in numbers for p in files.list(f"{target}/{BUCKET}={b}") if p.is_dir]
    kept = spark.read.schema(SCHEMA).option("basePath", target).parquet(*old).select(*columns, BUCKET).join(new.select("id").distinct(), "id", "left_anti")
    work = work_folder(target)
    part = f"{run_id}-{work[-6:]}"
    rows = kept.select(*columns, BUCKET).unionByName(new).withColumn(RUN, F.lit(part))
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET, RUN).parquet(f"{work}/rows")
    publish(spark, work, [(f"{work}/rows/{BUCKET}={b}/{RUN}={part}", f"{target}/{BUCKET}={b}/{RUN}={part}") for b in numbers], old)
    return BackfillRun(changed, len(numbers))
