"""End-to-end job properties on the sf0.001 fixtures (missed = 1,685 < 10,000)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import EMPTY_ALT, alt_ids, lines_df, members, pos_line, txn_df
from tallyspark import fixtures as FX
from tallyspark import schemas as S
from tallyspark import streaming as ST
from tallyspark.operators.delta import new_lines
from tallyspark.plans import registry as REG
from tallyspark.plans.pos_job import archive_lines, run_pos_reconcile
from tallyspark.session import local_path, work_dir

RUN = dt.datetime(2024, 3, 1, 6, 30)


def _job(spark, run, threshold=10000, **kw):
    d = SF_SMALL
    return run_pos_reconcile(spark, FX.pos_lines(spark, d), f"{run}/history", FX.member(spark, d),
                             FX.member_alt_id(spark, d), FX.loyalty_txn(spark, d), f"{run}/work",
                             f"{run}/out", threshold=threshold, run_ts=RUN, **kw)


@pytest.fixture()
def run_dir(spark):
    run = work_dir(spark, "test-run")
    archive_lines(FX.pos_lines_history(spark, SF_SMALL), f"{run}/history", "before")
    return run


def test_full_run_then_idempotent_rerun(spark, run_dir):
    r = _job(spark, run_dir)
    assert (r.imported, r.new_lines, r.missed) == (6559, 5100, 1685)
    assert r.missed_by_kind == {"SALE": 784, "RETU": 462, "VOID": 439}
    assert r.passed and r.exported == 1685 and r.archived == 5100
    assert r.export_path.endswith("20240301_0630_missed_transactions.json")
    assert spark.read.text(r.export_path).count() == 1685
    chunks = spark.read.json(r.payload_path)
    assert chunks.agg(F.sum("n_rows")).first()[0] == 1685
    assert chunks.agg(F.max("n_rows")).first()[0] <= 1000
    # archive then EXCEPT is empty, and a second run finds nothing new
    history = spark.read.parquet(f"{run_dir}/history").select(*S.POS_COLUMNS)
    assert new_lines(FX.pos_lines(spark, SF_SMALL), history).count() == 0
    again = _job(spark, run_dir)
    assert (again.new_lines, again.missed, again.archived, again.exported) == (0, 0, 0, 0)


def test_tripped_gate_leaves_history_untouched(spark, run_dir):
    before = spark.read.parquet(f"{run_dir}/history").count()
    r = _job(spark, run_dir, threshold=1685)   # equal stops
    assert not r.passed and r.exported == 0 and r.archived == 0 and r.export_path is None
    assert spark.read.parquet(f"{run_dir}/history").count() == before
    assert _job(spark, run_dir, threshold=1686).passed   # the batch is still re-readable


def test_strict_archive_variant(spark, run_dir):
    # lines that are new but none of them missed: a batch without the three kinds
    batch = FX.pos_lines(spark, SF_SMALL).withColumn("hd_order_or_tran_id", F.concat(F.lit("OTHER#"), F.col("hd_order_or_tran_id")))
    args = (f"{run_dir}/history", FX.member(spark, SF_SMALL), FX.member_alt_id(spark, SF_SMALL), FX.loyalty_txn(spark, SF_SMALL), f"{run_dir}/w", f"{run_dir}/o")
    strict = run_pos_reconcile(spark, batch, *args, threshold=None, archive_only_if_missed=True)
    assert strict.new_lines > 0 and strict.missed == 0 and strict.archived == 0
    assert run_pos_reconcile(spark, batch, *args, threshold=None).archived == strict.new_lines


def test_repeated_batch_writes_the_same_again(spark, run_dir):
    first = _job(spark, run_dir, batch_id="b1")
    lines = spark.read.parquet(f"{run_dir}/history").count()
    again = _job(spark, run_dir, batch_id="b1")   # as after a crash behind the archive step
    assert (again.new_lines, again.missed, again.exported, again.archived) == (5100, 1685, 1685, 5100)
    assert again.export_path == first.export_path and spark.read.text(first.export_path).count() == 1685
    assert spark.read.parquet(f"{run_dir}/history").count() == lines


def test_two_batches_of_one_minute_keep_both_exports(spark, run_dir):
    first = _job(spark, run_dir, batch_id="b1")
    more = FX.pos_lines(spark, SF_SMALL).withColumn("hd_store_id", F.lit("another"))
    second = run_pos_reconcile(spark, more, f"{run_dir}/history", FX.member(spark, SF_SMALL), FX.member_alt_id(spark, SF_SMALL),
                               FX.loyalty_txn(spark, SF_SMALL), f"{run_dir}/work2", f"{run_dir}/out", threshold=None, run_ts=RUN, batch_id="b2")
    assert second.exported > 0 and first.export_path != second.export_path
    assert spark.read.text(first.export_path).count() == 1685 and spark.read.text(second.export_path).count() == second.exported


def test_odd_empty_and_null_stamps_are_not_new_twice(spark, run_dir):
    stamps = F.element_at(F.array(F.lit("0123"), F.lit("1.50"), F.lit(""), F.lit(None).cast("string"), F.concat(F.lit("day "), F.col("hd_store_id"))),
                          (F.pmod(F.xxhash64("hd_order_or_tran_id"), F.lit(5)) + 1).cast("int"))
    batch = FX.pos_lines(spark, SF_SMALL).withColumn("hd_file_extract_date_time", stamps)
    args = (f"{run_dir}/odd", FX.member(spark, SF_SMALL), FX.member_alt_id(spark, SF_SMALL), FX.loyalty_txn(spark, SF_SMALL), f"{run_dir}/w", f"{run_dir}/o")
    new = new_lines_of(spark, batch, args)
    assert new > 0 and new_lines_of(spark, batch, args) == 0


def new_lines_of(spark, batch, args):
    from tallyspark.plans.history import archive_lines, batch_days, history_for_batch, read_history

    history = read_history(spark, args[0])
    found = batch.dropDuplicates() if history is None else new_lines(batch, history_for_batch(history, batch_days(batch)), cols=S.POS_COLUMNS)
    found = found.select(*S.POS_COLUMNS)
    n = found.count()
    if n:
        archive_lines(found, args[0], "odd")
    return n


def test_bad_stamps_go_to_the_reject_table(spark, run_dir):
    odd = [pos_line(hd_order_or_tran_id="SALE#1-1", hd_order_date_time="31/01/2024"), pos_line(hd_order_or_tran_id="SALE#2-1", hd_order_date_time=None),
           pos_line(hd_order_or_tran_id="SALE#3-1", hd_file_extract_date_time=""), pos_line(hd_order_or_tran_id="SALE#4-1")]
    args = (lines_df(spark, odd), f"{run_dir}/none-yet", members(spark, [(1, "C1", None)]), alt_ids(spark, EMPTY_ALT), txn_df(spark, []),
            f"{run_dir}/w", f"{run_dir}/o")
    r = run_pos_reconcile(spark, *args, threshold=None, run_ts=RUN, strict_ts=False)
    assert (r.new_lines, r.rejected, r.missed, r.archived) == (4, 2, 2, 4)
    assert {x[0] for x in spark.read.parquet(r.rejects_path).select("hd_order_or_tran_id").collect()} == {"SALE#1-1", "SALE#3-1"}
    assert {x[0] for x in spark.read.parquet(r.missed_path).select("tran_id").collect()} == {"SALE#2-1", "SALE#4-1"}
    again = run_pos_reconcile(spark, *args, threshold=None, run_ts=RUN, strict_ts=False)
    assert (again.new_lines, again.rejected) == (0, 0)
    strict = (args[0], f"{run_dir}/other", *args[2:])
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        run_pos_reconcile(spark, *strict, threshold=None, run_ts=RUN)


def test_stream_equals_batch_and_archives_files(spark):
    root = work_dir(spark, "test-stream")
    d = SF_SMALL
    REG._write_csv(FX.pos_lines(spark, d).repartition(3), f"{root}/in", "|")
    archive_lines(FX.pos_lines_history(spark, d), f"{root}/history", "before")
    results = ST.reconcile_stream(spark, f"{root}/in", f"{root}/ckpt", f"{root}/out", f"{root}/history",
                                  FX.member(spark, d), FX.member_alt_id(spark, d), FX.loyalty_txn(spark, d),
                                  archive_dir=f"{root}/processed", max_files_per_trigger=1, file_glob="*.csv",
                                  threshold=10000)
    assert len(results) == 3 and all(r.passed for r in results.values())
    assert sum(r.archived for r in results.values()) == 5100   # every new line archived once
    streamed = ST.read_stream_output(spark, f"{root}/out")
    batch = REG.QUERIES["missed_all"](spark, d)
    assert streamed.count() == 1685
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    moved = [f for _, _, fs in os.walk(local_path(f"{root}/processed")) for f in fs if f.endswith(".csv")]
    left = [f for f in os.listdir(local_path(f"{root}/in")) if f.endswith(".csv")]
    assert len(moved) == 3 and left == []


def test_partitioned_transactions_are_pruned_by_day(spark, run_dir):
    d = SF_SMALL
    txn_path = f"{run_dir}/txn"
    (FX.loyalty_txn(spark, d).withColumn("txn_day", F.to_date("date"))
     .write.partitionBy("txn_day").parquet(txn_path))
    txn = spark.read.parquet(txn_path)
    r = run_pos_reconcile(spark, FX.pos_lines(spark, d), f"{run_dir}/history", FX.member(spark, d),
                          FX.member_alt_id(spark, d), txn, f"{run_dir}/work", f"{run_dir}/out",
                          threshold=None, run_ts=RUN, txn_day_col="txn_day")
    assert r.missed_by_kind == {"SALE": 784, "RETU": 462, "VOID": 439}


def test_stream_gate_stops_without_committing(spark):
    root = work_dir(spark, "test-stream-gate")
    d = SF_SMALL
    REG._write_csv(FX.pos_lines(spark, d).repartition(2), f"{root}/in", "|")
    archive_lines(FX.pos_lines_history(spark, d), f"{root}/history", "before")
    args = (spark, f"{root}/in", f"{root}/ckpt", f"{root}/out", f"{root}/history",
            FX.member(spark, d), FX.member_alt_id(spark, d), FX.loyalty_txn(spark, d))
    with pytest.raises(Exception):
        ST.reconcile_stream(*args, max_files_per_trigger=1, file_glob="*.csv", threshold=10)
    before = spark.read.parquet(f"{root}/history").count()
    # the same files are offered again once the limit allows them
    results = ST.reconcile_stream(*args, max_files_per_trigger=1, file_glob="*.csv", threshold=10000)
    assert sum(r.missed for r in results.values()) == 1685
    assert spark.read.parquet(f"{root}/history").count() == before + 5100


def test_job_reads_new_lines_once_from_its_staged_table(spark, run_dir):
    r = _job(spark, run_dir)
    staged_new = spark.read.parquet(f"{run_dir}/work/new_lines")
    assert staged_new.count() == r.new_lines == 5100
    # the missed lines derive from the staged table: re-running the anti joins on
    # it alone reproduces them without touching batch or history
    from tallyspark.operators.reconcile import missed as missed_op, resolved_candidates
    again = missed_op(resolved_candidates(staged_new, FX.member(spark, SF_SMALL), FX.member_alt_id(spark, SF_SMALL)),
                      FX.loyalty_txn(spark, SF_SMALL))
    assert again.count() == r.missed == 1685


def test_account_loads_continue_ids_and_repeat(spark, run_dir):
    from tallyspark.plans.account_job import id_store, run_account_migration

    staged = FX.crm_account_txn(spark, SF_SMALL)

    def load(part, name):
        REG._write_csv(staged.where(F.col("accounttransactionid").cast("long") % 2 == part), f"{run_dir}/in{part}", ",")
        return run_account_migration(spark, f"{run_dir}/in{part}", FX.member_alt_id(spark, SF_SMALL), FX.member(spark, SF_SMALL),
                                     f"{run_dir}/target", f"{run_dir}/work-{name}", RUN, name)

    first, second = load(0, "a"), load(1, "b")
    assert first.first_id == S.LOYALTY_TXN_ID_START and second.first_id == S.LOYALTY_TXN_ID_START + first.loaded
    rows = lambda: sorted(map(tuple, second.target.select("id", "referencenumber", "memberid").collect()))
    before = rows()
    assert [r[0] for r in before] == list(range(S.LOYALTY_TXN_ID_START, S.LOYALTY_TXN_ID_START + first.loaded + second.loaded))
    earlier = load(0, "a")  # not the last load, and under its own ids
    assert (earlier.first_id, earlier.loaded) == (first.first_id, first.loaded) and sorted(map(tuple, earlier.target.select("id", "referencenumber", "memberid").collect())) == before
    assert not [f for f in os.listdir(local_path(run_dir)) if f == "placed"] and not os.path.exists(local_path(f"{run_dir}/work-a/placed"))
    again = load(1, "b")
    assert again.first_id == second.first_id and again.key_violations.count() == 0
    assert sorted(map(tuple, again.target.select("id", "referencenumber", "memberid").collect())) == before
    assert id_store(spark, f"{run_dir}/target").loads() == ["a", "b"]
    with pytest.raises(ValueError):
        load(0, "a/b")
    # rows that came past the job, under ids that it has given: the next run of any load takes them into the store
    spark.read.parquet(f"{run_dir}/target/load_id=a").limit(5).write.parquet(f"{run_dir}/target/load_id=odd")
    checked = load(0, "a")
    assert sorted((r["n"], r["problem"]) for r in checked.key_violations.collect()) == [(2, "duplicate")] * 5


def test_profile_keys_grow_with_the_table(spark):
    from conftest import SF_SMALL as small

    few = FX.profile_dim(spark, small).agg(F.count_distinct("uuid"), F.count_distinct("email_address")).first()
    many = FX.profile_dim(spark, "/root/testdata/sf0.01").agg(F.count_distinct("uuid"), F.count_distinct("email_address")).first()
    assert many[0] > 8 * few[0] and many[1] > 8 * few[1]
