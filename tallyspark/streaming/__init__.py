"""Incremental ingest of POS drops with Structured Streaming.

A file-source stream over the drop folder replaces the source job's list /
import / move loop.  Each micro-batch of new files is handed to the batch job
(``plans.pos_job.run_pos_reconcile``) unchanged: staged, differenced against
history (pruned to the batch's extract days), reconciled, gated, exported and
archived.  With the archive goes a list of the files that the lines came from.
Files are moved to the processed folder by that list, and only once their epoch is
committed: when a later epoch begins, and at the end of the run.  So after a run
no consumed file is left in the drop folder, and an epoch that has to be
replayed still finds its files.

Replays are safe: an epoch is a batch of its own name; its archive is no history
to it, so a replay finds the same lines and writes the same files and partitions
again.  A tripped gate raises: the epoch is not committed
and its files are offered again on the next start.  Re-delivered lines need no
watermark: the batch difference against history removes them.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import hashlib
import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.files import Files
from tallyspark.operators.reconcile import DEFAULT_RULES
from tallyspark.plans.pos_job import run_pos_reconcile
from tallyspark.session import shuffles_removed
from tallyspark.sources import _csv_options, _restore_empty, read_pos_lines

ORIGIN = {"source_file": "_metadata.file_path", "source_size": "_metadata.file_size", "source_modified": "_metadata.file_modification_time"}


def pos_drop_stream(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None = None, file_glob: str = "*") -> DataFrame:
    """The drops' lines as a stream, each with the path, size and time of its file."""
    reader = (spark.readStream.schema(S.POS_SCHEMA).options(**_csv_options("|", True))
              .option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.csv(in_dir)
    return _restore_empty(lines.select("*", *[F.col(c).alias(name) for name, c in ORIGIN.items()]), S.POS_SCHEMA)


def consumed_files(batch: DataFrame) -> DataFrame:
    """The files that a batch's lines came from: path, size, time, rows."""
    return batch.groupBy(*ORIGIN).agg(F.count(F.lit(1)).alias("rows"))


def move_consumed(spark: SparkSession, in_dir: str, out_dir: str, archive_dir: str, before: int | None = None) -> int:
    """Move the files listed by the epochs below ``out_dir`` (those before ``before``; all without it) to
    ``archive_dir/epoch=<n>``; the number moved.

    Moving again moves nothing: a file that is gone was moved before, and one of the same name but another size or time
    is a new delivery, which stays."""
    files, moved = Files(spark), 0
    for e in files.list(out_dir):
        epoch = int(e.name.removeprefix("epoch=")) if e.is_dir and e.name.startswith("epoch=") else None
        if epoch is None or (before is not None and epoch >= before) or not files.exists(f"{e.path}/consumed") or files.exists(f"{e.path}/moved.json"):
            continue
        for r in spark.read.parquet(f"{e.path}/consumed").select("source_file", "source_size", F.unix_millis("source_modified").alias("at")).toLocalIterator():
            path = unquote(r["source_file"])
            now = files.stat(path)
            if now and (now.size, now.modified) == (r["source_size"], r["at"]):
                files.rename(path, f"{archive_dir.rstrip('/')}/epoch={epoch}/{path.rsplit('/', 1)[1]}")
                moved += 1
        files.create(f"{e.path}/moved.json", json.dumps({"epoch": epoch}))
    return moved


def move_empty(spark: SparkSession, in_dir: str, archive_dir: str, present: list) -> int:
    """Move files that were ``present`` before a run and hold no line, which no epoch can list."""
    files = Files(spark)
    left = [e for e in present if (now := files.stat(e.path)) and (now.size, now.modified) == (e.size, e.modified)]
    if not left:
        return 0
    told = {unquote(r[0]).rsplit("/", 1)[1] for r in read_pos_lines(spark, [e.path for e in left], with_source=True).select("source_file").distinct().toLocalIterator()}
    empty = [e for e in left if e.name not in told]
    for e in empty:
        files.rename(e.path, f"{archive_dir.rstrip('/')}/empty/{e.modified}-{e.name}")
    return len(empty)


class GateTripped(RuntimeError):
    pass


def reconcile_stream(spark: SparkSession, in_dir: str, checkpoint_dir: str, out_dir: str, history_path: str,
                     member: DataFrame, alt: DataFrame, txn: DataFrame, archive_dir: str | None = None,
                     max_files_per_trigger: int | None = None, rules=DEFAULT_RULES, file_glob: str = "*",
                     threshold: int | None = None, txn_day_col: str | None = None, strict_ts: bool = True):
    """Run the stream over every file present now (``availableNow``) and stop.

    Missed lines of epoch *n* are staged under ``out_dir/epoch=n/work/missed``;
    ``threshold=None`` disables the gate.  ``archive_dir``: where consumed files go; without it they stay.
    ``strict_ts=False`` sets lines with a bad stamp aside instead of stopping the stream."""
    results, files, out_dir = {}, Files(spark), out_dir.rstrip("/")
    stream = hashlib.sha1(checkpoint_dir.rstrip("/").encode()).hexdigest()[:12]  # one stream, one checkpoint folder
    present = [e for e in files.list(in_dir) if not e.is_dir and e.name[0] not in "._" and fnmatch.fnmatch(e.name, file_glob)] if archive_dir else []

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        run = f"{out_dir}/epoch={epoch_id}"
        if archive_dir:  # earlier epochs are committed by now
            move_consumed(spark, in_dir, out_dir, archive_dir, before=epoch_id)
        # the first attempt's time stamp, so that a replay writes the same names
        files.create(f"{run}/started.json", json.dumps(dt.datetime.now().replace(microsecond=0).isoformat()))
        started = dt.datetime.fromisoformat(json.loads(files.read(f"{run}/started.json")))
        consumed_files(batch).write.mode("overwrite").parquet(f"{run}/consumed")
        res = run_pos_reconcile(spark, batch, history_path, member, alt, txn, f"{run}/work", f"{run}/export", threshold, run_ts=started,
                                rules=rules, batch_id=f"{stream}-{epoch_id}", txn_day_col=txn_day_col, strict_ts=strict_ts)
        results[epoch_id] = res
        if not res.passed:
            raise GateTripped(f"epoch {epoch_id}: {res.missed} missed lines, threshold {threshold}")
        for staged in ("batch", "new_lines"):  # they lie in the drops and in history; a replay makes them anew
            files.delete(f"{run}/work/{staged}")

    with shuffles_removed(spark):
        q = (pos_drop_stream(spark, in_dir, max_files_per_trigger, file_glob)
             .writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/stream")
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    if archive_dir:  # all epochs are committed
        move_consumed(spark, in_dir, out_dir, archive_dir)
        move_empty(spark, in_dir, archive_dir, present)
    return results


def read_stream_output(spark: SparkSession, out_dir: str) -> DataFrame:
    """Missed lines staged by every epoch."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/epoch=*/work/missed").select(*S.MISSED_COLUMNS)
