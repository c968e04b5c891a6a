"""Keys of a table's loads, kept by hash bucket, so that a load is checked against the buckets it touches and not against the table.

    <folder>/bucket=7/part=<random>/…    keys, load, n (rows of the load with that key)
    <folder>/_loads/<load>.json          the buckets that hold keys of a load, and whether it was added to its end

A key is kept as it is and not as a digest, so no collision can name a key that is in order.  A load adds a part to each of its
buckets; a bucket of ``MERGE_AT`` parts is written as one, and a load that is repeated first loses its keys in the buckets where it
had some.  Parts are published as in ``files.publish``; one run a store at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.files import Files, finish_publications, publish, work_folder

BUCKET, PART, LOAD, ROWS = "_bucket", "_part", "_load", "_rows"
MERGE_AT = 16


class KeyStore:
    """The keys (``schema``: names and types) of a table's rows.  The number of buckets is fixed for the life of the store."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, buckets: int):
        self.spark, self.files, self.folder, self.buckets = spark, Files(spark), folder.rstrip("/"), buckets
        self.keys = schema.names
        self.schema = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(ROWS, T.LongType())])
        self.laid_out = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(PART, T.StringType())])

    def loads(self) -> list[str]:
        """The loads whose keys are in the store."""
        names = [e.name[:-len(".json")] for e in self.files.list(f"{self.folder}/_loads") if e.name.endswith(".json") and e.name[0] != "_"]
        return [n for n in names if self._entry(n)["done"]]

    def _entry(self, load: str) -> dict:
        path = f"{self.folder}/_loads/{load}.json"
        return json.loads(self.files.read(path)) if self.files.exists(path) else {"buckets": [], "done": False}

    def _note(self, load: str, buckets: set[int], done: bool) -> None:
        self.files.replace(f"{self.folder}/_loads/{load}.json", json.dumps({"buckets": sorted(buckets), "done": done}))

    def touched(self, load: str) -> list[int]:
        """The buckets that hold keys of a load."""
        return self._entry(load)["buckets"]

    def _placed(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """Key columns of ``rows`` (by ``names``) in the store's names and types, with their bucket."""
        typed = rows.select(*[F.col(n).cast(self.schema[k].dataType).alias(k) for k, n in zip(self.keys, names, strict=True)])
        return typed.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _parts(self, bucket: int) -> list[str]:
        return [e.path for e in self.files.list(f"{self.folder}/{BUCKET}={bucket}") if e.is_dir]

    def _read(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.laid_out)
        return self.spark.read.schema(self.laid_out).option("basePath", self.folder).parquet(*parts)

    def read(self, buckets: list[int]) -> DataFrame:
        """Keys, load and rows of some buckets; no other bucket is listed or read."""
        finish_publications(self.spark, self.folder)
        return self._read([p for b in buckets for p in self._parts(b)])

    def add(self, load: str, rows: DataFrame, run_dir: str) -> int:
        """Put the keys of ``rows`` in place of those that load ``load`` had before; the number of buckets written."""
        if not re.fullmatch(r"[A-Za-z0-9-][A-Za-z0-9_-]*", load):
            raise ValueError(f"load {load!r}: letters, digits, - and _ only, and no _ in front")
        finish_publications(self.spark, self.folder)
        staged = f"{run_dir}/keys-{uuid.uuid4().hex[:8]}"
        (self._placed(rows, self.keys).groupBy(*self.keys, BUCKET).agg(F.count(F.lit(1)).alias(ROWS)).withColumn(LOAD, F.lit(load))
         .select(*self.schema.names, BUCKET).write.parquet(staged))
        new = self.spark.read.schema(T.StructType(self.laid_out.fields[:-1])).parquet(staged)
        now = {r[0] for r in new.select(BUCKET).distinct().collect()}  # as many as there are buckets, at most
        earlier = set(self.touched(load))
        parts = {b: self._parts(b) for b in now | earlier}
        replaced = [p for b, ps in parts.items() if b in earlier or len(ps) + 1 >= MERGE_AT for p in ps]
        kept = self._read(replaced).where(F.col(LOAD) != load).select(*self.schema.names, BUCKET)
        work = work_folder(self.folder)
        part = work[-12:]
        written = kept.unionByName(new).withColumn(PART, F.lit(part)).hint("rebalance", BUCKET)
        written.sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET, PART).parquet(f"{work}/rows")
        # a run that breaks off from here on leaves more buckets on the list than hold the load, and never fewer
        self._note(load, now | earlier, done=False)
        publish(self.spark, work, [(f"{work}/rows/{BUCKET}={b}/{PART}={part}", f"{self.folder}/{BUCKET}={b}/{PART}={part}") for b in sorted(parts)], replaced)
        self._note(load, now, done=True)
        self.files.delete(staged)
        return len(parts)

    def violations(self, load: str) -> DataFrame:
        """(keys..., n, problem) as ``quality.primary_key_violations`` has them for the whole table, of the keys that ``load`` holds."""
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        seen = self.read(self.touched(load)).groupBy(*self.keys).agg(F.sum(ROWS).alias("n"), F.max(F.col(LOAD) == load).alias("_own"))
        bad = seen.where(F.col("_own") & ((F.col("n") > 1) | any_null)).drop("_own")
        return bad.withColumn("problem", F.when(any_null, "null").otherwise("duplicate"))

    def missing(self, rows: DataFrame, foreign: list[str]) -> DataFrame:
        """Rows whose non-NULL foreign key (columns in the order of the store's keys) no load holds.  ``rows`` is read twice."""
        whole = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in foreign]))
        buckets = [r[0] for r in self._placed(whole, foreign).select(BUCKET).distinct().collect()]  # at most one a bucket
        held = self.read(buckets).select(*[F.col(k).alias(f"_held_{k}") for k in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).cast(self.schema[k].dataType) == F.col(f"_held_{k}") for k, c in zip(self.keys, foreign, strict=True)])
        return whole.join(held, same, "left_anti")
