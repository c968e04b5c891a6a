"""Delimited-file sources: POS drops, CRM account transactions, CRM contacts.

Rules shared by every reader:
- an explicit schema, never inference; columns map by position, as the
  source's column lists do, so header names in the file do not matter;
- the first line is a header and is skipped;
- an empty field is NULL.  A *quoted* empty field (``""``) is an empty
  string in the source system; ``keep_quoted_empty`` reproduces that with a
  sentinel that is mapped back to ``''`` (Spark would read it as NULL);
- ``escape='"'`` so doubled quotes inside a quoted field stay one quote.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tallyspark import schemas as S
from tallyspark.functions import POS_TS_FORMAT

QUOTED_EMPTY = "\u0001<empty>\u0001"
BAD_LINE = "_bad_line"


def _csv_options(sep: str, keep_quoted_empty: bool, multi_line: bool = False) -> dict[str, str]:
    opts = {"sep": sep, "header": "true", "nullValue": "", "escape": '"', "quote": '"',
            "mode": "FAILFAST", "timestampNTZFormat": POS_TS_FORMAT, "timestampFormat": POS_TS_FORMAT,
            "multiLine": str(multi_line).lower()}
    if keep_quoted_empty:
        opts["emptyValue"] = QUOTED_EMPTY
    return opts


def _restore_empty(df: DataFrame, schema: T.StructType) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == QUOTED_EMPTY, F.lit("")).otherwise(c)
        cols.append(c.alias(f.name))
    extra = [F.col(c) for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*cols, *extra)


def read_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = ",",
                   keep_quoted_empty: bool = True, with_source: bool = False, multi_line: bool = False) -> DataFrame:
    """``multi_line`` accepts line breaks inside quoted fields; a file is then read whole by one task."""
    reader = spark.read.schema(schema).options(**_csv_options(sep, keep_quoted_empty, multi_line))
    df = reader.csv(paths)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return _restore_empty(df, schema) if keep_quoted_empty else df


class TooManyBadRows(ValueError):
    pass


@dataclass(frozen=True)
class Load:
    good: DataFrame
    rejects: DataFrame  # source_file, line
    rows: int
    bad: int


def load_delimited(spark: SparkSession, paths: str | list[str], schema: T.StructType, folder: str, sep: str = ",",
                   most_bad: float = 0.01, multi_line: bool = False) -> Load:
    """Stage delimited files below ``folder``, malformed lines apart: those of another number of fields or with a field that is not
    of its type.  The files are parsed once.  A share of bad lines over ``most_bad`` raises ``TooManyBadRows``; the staged
    lines are there to be looked at."""
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())]))
    options = _csv_options(sep, True, multi_line) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    rows = _restore_empty(read.options(**options).csv(paths).withColumn("source_file", F.col("_metadata.file_path")), schema)
    seen = Observation("load")
    counted = rows.withColumn("rejected", F.col(BAD_LINE).isNotNull()).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("bad"))
    counted.write.mode("overwrite").partitionBy("rejected").parquet(folder)
    n, bad = int(seen.get.get("rows") or 0), int(seen.get.get("bad") or 0)
    if bad > most_bad * n:
        raise TooManyBadRows(f"{bad} of {n} lines are malformed, see rejected=true below {folder}")
    staged = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(folder)
    return Load(staged.where(~F.col("rejected")).select(*schema.fieldNames()), staged.where("rejected").select("source_file", F.col(BAD_LINE).alias("line")), n, bad)


def read_pos_lines(spark: SparkSession, paths: str | list[str], keep_quoted_empty: bool = True,
                   with_source: bool = False, multi_line: bool = False) -> DataFrame:
    """Pipe-delimited POS line files (42 text columns)."""
    return read_delimited(spark, paths, S.POS_SCHEMA, "|", keep_quoted_empty, with_source, multi_line)


def read_account_txn(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Comma-delimited CRM account-transaction export (16 columns)."""
    return read_delimited(spark, paths, S.ACCOUNT_TXN_SCHEMA, ",")


def read_contacts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per-country contact files (13 columns), read as one parallel scan."""
    return read_delimited(spark, list(paths), S.CONTACT_STAGE_SCHEMA, ",")


def discover(folder: str, prefix: str) -> str:
    """Glob for every file or drop folder under ``folder`` whose name starts with ``prefix``."""
    literal = lambda x: re.sub(r"([\\\[\]{}*?])", r"\\\1", x)
    return f"{literal(folder.rstrip('/'))}/{literal(prefix)}*"


def read_pos_drops(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """All POS drops matching the prefix, with the drop name of each line.

    An empty drop folder gives an empty frame, not an error."""
    try:
        df = read_pos_lines(spark, discover(folder, prefix), with_source=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            empty = spark.createDataFrame([], S.POS_SCHEMA)
            return empty.withColumn("drop_name", F.lit(None).cast("string"))
        raise
    return df.withColumn("drop_name", drop_name(F.col("source_file"), folder)).drop("source_file")


def drop_name(file_path: Column, folder: str) -> Column:
    """First path component below ``folder``: the file itself, or the drop folder
    that holds it (Spark writers produce folders of part files)."""
    tail = re.sub(r"^[a-z]+:/*", "/", folder.rstrip("/"))
    plain = F.url_decode(F.regexp_replace(file_path, r"\+", "%2B"))  # the path is a URI, in which + stands for itself
    return F.regexp_extract(plain, re.escape(tail) + r"/([^/]+)", 1)


def import_counts(drops: DataFrame) -> DataFrame:
    """Rows imported per drop and in total (``drop_name`` NULL on the total row)."""
    per = drops.groupBy("drop_name").agg(F.count(F.lit(1)).alias("n"))
    return per.rollup("drop_name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
