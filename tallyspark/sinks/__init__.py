"""Sinks: overwrite / append writers, JSON-lines export, bounded bulk payloads.

Writers return row counts taken with ``observe`` during the write itself, so
no second pass over the data is needed.  The shuffle files of a write are removed
with it (``shuffles_removed``): a job of many writes holds those of one at a time.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.files import Files
from tallyspark.functions import JSON_TS_FORMAT, row_json
from tallyspark.operators.keys import number_rows, place_rows
from tallyspark.operators.migrate import conform
from tallyspark.session import shuffles_removed, work_dir

PAYLOAD_SCHEMA = "chunk_id long, n_rows long, payload string"
CODEC = {"parquet": "zstd"}  # by format, for what the jobs write; others as Spark has them


def _observed_write(df: DataFrame, name: str):
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation, spark, path: str, fmt: str) -> int:
    """Rows seen by the write.  When adaptive execution replaced an empty
    input by an empty relation the observation carries no metrics; count the
    written files instead (footer metadata for parquet)."""
    seen = obs.get.get("rows")
    return spark.read.format(fmt).load(path).count() if seen is None else int(seen)


def _packed(writer, fmt: str):
    return writer.option("compression", CODEC[fmt]) if fmt in CODEC else writer


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """Truncate-and-load: replace the target's content with ``df``."""
    d, obs = _observed_write(df, "overwrite")
    w = _packed(d.write.mode("overwrite").format(fmt), fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.save(path)
    return _rows(obs, df.sparkSession, path, fmt)


def write_append(df: DataFrame, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> int:
    """``INSERT INTO target SELECT …``: align to the target layout, then append."""
    if schema is not None:
        df = conform(df, schema)
    d, obs = _observed_write(df, "append")
    w = _packed(d.write.mode("append").format(fmt), fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.save(path)
    return int(obs.get.get("rows", 0))  # appended rows only: no fallback count over the whole target


def export_name(run_ts: dt.datetime, name: str) -> str:
    """Run-stamped export name: ``YYYYmmdd_HHMM_<name>``."""
    return run_ts.strftime("%Y%m%d_%H%M") + "_" + name


def export_json_lines(df: DataFrame, out_dir: str, name: str, run_ts: dt.datetime, compression: str = "gzip") -> tuple[str, int]:
    """One JSON object per line, NULL fields kept; returns (path, rows exported).  With all its field names the text is over ten times as
    long as its gzip form; ``compression="none"`` writes it plain."""
    path = f"{out_dir.rstrip('/')}/{export_name(run_ts, name)}"
    d, obs = _observed_write(df, "export")
    with shuffles_removed(df.sparkSession):
        (d.write.mode("overwrite")
         .option("ignoreNullFields", "false")
         .option("compression", compression)
         .option("timestampNTZFormat", JSON_TS_FORMAT)
         .option("timestampFormat", JSON_TS_FORMAT)
         .json(path))
    return path, _rows(obs, df.sparkSession, path, "json")


def bulk_payload_chunks(df: DataFrame, max_rows: int = 1000, cols: list[str] | None = None, stage: str | None = None,
                        placed: bool = False) -> DataFrame:
    """JSON-array payloads of at most ``max_rows`` rows each: (chunk_id, n_rows, payload).

    Rows get a gap-free index (see ``number_rows``), ``chunk_id = index div
    max_rows``; each group therefore holds at most ``max_rows`` rows, so no
    task ever collects more than one bounded chunk.  Rows inside a payload
    follow the index.  The numbered rows lie in ``stage`` (a fresh work folder without it) as columns; their JSON text,
    many times as long, is made when they are read again.  Rows that were written with their places
    (``place_rows``) are ``placed`` and not written again; name their ``cols``."""
    cols = cols or df.columns
    rows = df.select(*cols, "_pid", "_pos") if placed else place_rows(df.select(*cols), path=stage or work_dir(df.sparkSession, "payload-rows"))
    indexed = number_rows(rows, "_idx", [(0, None)]).select("_idx", row_json(cols).alias("_json"))
    return (indexed.groupBy(F.floor(F.col("_idx") / max_rows).cast("long").alias("chunk_id"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.array_sort(F.collect_list(F.struct("_idx", "_json"))).alias("_rows"))
            .select("chunk_id", "n_rows",
                    F.concat(F.lit("["), F.array_join(F.col("_rows._json"), ","), F.lit("]")).alias("payload")))


def write_payload(chunks: DataFrame, path: str) -> None:
    """Write payloads as JSON lines, compressed as they repeat every field name in every row."""
    with shuffles_removed(chunks.sparkSession):
        chunks.write.mode("overwrite").option("compression", "gzip").json(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Written payloads, read with their schema: to infer it would be a pass over all of them."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def payload_rows(chunks: DataFrame) -> DataFrame:
    """The row objects inside payloads, one JSON text per row (for checks)."""
    return chunks.select(F.explode(F.from_json("payload", "array<string>")).alias("row_json"))


READY = "_READY.json"


def _content(spark: SparkSession, path: str) -> dict:
    """Rows of a JSON-lines export and a sum of their hashes, which no order changes."""
    one = spark.read.text(path).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("value").cast("decimal(20,0)")).alias("sum")).first()
    return {"rows": int(one["rows"]), "sum": str(one["sum"] or 0)}


def mark_ready(spark: SparkSession, folder: str, export_path: str) -> None:
    """Say that a batch's export may be read: its path, rows and checksum, written after all else of the batch."""
    Files(spark).replace(f"{folder}/{READY}", json.dumps({"export": export_path} | _content(spark, export_path)))


def unmark_ready(spark: SparkSession, folder: str) -> None:
    """Take the mark back before a batch is written anew."""
    Files(spark).delete(f"{folder}/{READY}")


def ready_exports(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Export path by batch folder, of the batches that are marked ready."""
    files = Files(spark)
    marked = [e for e in files.list(out_dir) if e.is_dir and files.exists(f"{e.path}/{READY}")]
    return {e.name: json.loads(files.read(f"{e.path}/{READY}"))["export"] for e in marked}


def read_ready(spark: SparkSession, out_dir: str) -> DataFrame:
    """JSON lines (column ``row_json``, with the batch's folder) of all batches marked ready; ValueError if one is not what its
    mark says."""
    files, exports = Files(spark), ready_exports(spark, out_dir)
    out = spark.createDataFrame([], "row_json string, batch string")
    for batch, path in exports.items():
        said = json.loads(files.read(f"{out_dir.rstrip('/')}/{batch}/{READY}"))
        if _content(spark, path) != {k: said[k] for k in ("rows", "sum")}:
            raise ValueError(f"export of {batch} differs from its mark")
        out = out.union(spark.read.text(path).select(F.col("value").alias("row_json"), F.lit(batch).alias("batch")))
    return out
