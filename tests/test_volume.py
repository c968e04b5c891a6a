"""What is shuffled and written: one shuffle where steps can share it, small files, nothing computed twice."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import alt_ids, lines_df, members, pos_line, txn_df, txn_row
from tallyspark import schemas as S
from tallyspark import sinks as K
from tallyspark.functions import pack, unpack
from tallyspark.operators.delta import new_lines
from tallyspark.operators.reconcile import missed, resolved_candidates
from tallyspark.operators.resolve import SALT, SALTS, resolve_members, salted
from tallyspark.plans import reconcile as R
from tallyspark.plans import registry as REG
from tallyspark.session import local_path, work_dir
from test_plans import plan

NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture()
def shuffled(spark):
    """Joins as on large tables: nothing is broadcast."""
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k in NO_BROADCAST:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def exchanges(df) -> list[str]:
    """The keys of the plan's shuffles."""
    return [line for line in plan(df).split("\n") if line.startswith("Arguments: hashpartitioning")]


def few_lines(spark):
    hot = [pos_line(hd_order_or_tran_id=f"SALE#{i}", hd_order_date_time=f"2024-01-31 10:{i % 60:02d}:00") for i in range(40)]
    return lines_df(spark, [*hot, *hot[:5], pos_line(hd_loyalty_id=None), pos_line(hd_loyalty_id="A2"), pos_line(hd_loyalty_id="A2", itm_sku=None)])


def inputs(spark):
    batch = few_lines(spark)
    return R.ReconcileInputs(batch, batch.where("hd_order_or_tran_id = 'SALE#7'"), members(spark, [(1, "C1", None), (2, None, None)]),
                             alt_ids(spark, [(2, "A2"), (3, "A2")]), txn_df(spark, [txn_row(referencenumber="SALE#9")]))


def test_difference_and_member_join_share_a_shuffle_of_the_lines(shuffled):
    found = R.candidates(inputs(shuffled))
    wide = [k for k in exchanges(found) if "hd_" in k]
    assert len(wide) == 1 and "hd_loyalty_id" in wide[0] and SALT in wide[0], wide
    assert "SortMergeJoin LeftAnti" not in plan(R.new_batch_lines(inputs(shuffled)))  # lines are not sorted to be told apart
    rows = [r["memberid"] for r in found.collect()]
    assert sorted(rows) == [1] * 39 + [2, 2, 3, 3]


def test_salted_lines_resolve_as_plain_ones(shuffled):
    inp = inputs(shuffled)
    lines = salted(inp.batch)
    assert 1 < lines.where("hd_loyalty_id = 'C1'").select(SALT).distinct().count() <= SALTS
    rows = lambda df: sorted(map(str, df.select("memberid", *S.POS_COLUMNS).collect()))
    assert rows(resolve_members(lines, inp.member, inp.alt)) == rows(resolve_members(inp.batch, inp.member, inp.alt))


def test_header_match_shuffles_the_transactions_once(shuffled):
    inp = inputs(shuffled)
    found = missed(resolved_candidates(inp.batch, inp.member, inp.alt), inp.txn)
    assert len([k for k in exchanges(found) if "currency#" in k]) == 2, exchanges(found)  # the lines, the transactions


@pytest.mark.parametrize("text, amount, same", [("0", -0.0, True), ("-0.00", 0.0, True), ("12.10", 12.1, True), ("12.1000001", 12.1, True),
                                                ("12.11", 12.1, False), ("16777217", 16777216.0, True), ("NaN", float("nan"), True)])
def test_amounts_match_as_floats_do(spark, text, amount, same):
    inp = R.ReconcileInputs(lines_df(spark, [pos_line(itm_amt_after_disc=text)]), lines_df(spark, []), members(spark, [(1, "C1", None)]),
                            alt_ids(spark, [(9, "Z")]), txn_df(spark, [txn_row(monetaryamount=amount)]))
    assert (R.missed_lines(inp).count() == 0) == same


def test_near_lines_are_the_same_lines(spark):
    batch = salted(few_lines(spark))
    cols = [*S.POS_COLUMNS, SALT]
    history = batch.where("hd_order_or_tran_id = 'SALE#3'")
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert rows(new_lines(batch, history, cols, near=["hd_loyalty_id", SALT])) == rows(new_lines(batch, history, cols)) == rows(batch.distinct().exceptAll(history.distinct()))


def test_bindings_scan_the_lines_once_each(spark):
    p = plan(REG.QUERIES["missed_all"](spark, SF_SMALL))
    assert p.count("ReadSchema: struct<l_orderkey") == 4  # batch, history, and the transactions in each of two matches


def test_export_and_payload_are_compressed(spark):
    df = lines_df(spark, [pos_line(hd_order_or_tran_id=f"SALE#{i}") for i in range(3000)])
    out = work_dir(spark, "test-export")
    path, n = K.export_json_lines(df, out, "missed.json", dt.datetime(2024, 3, 1, 7, 5))
    K.write_payload(K.bulk_payload_chunks(df, 1000, stage=f"{out}/rows"), f"{out}/payload")
    for folder in (path, f"{out}/payload"):
        own = local_path(folder)
        assert 0 < sum(os.path.getsize(f"{own}/{f}") for f in os.listdir(own) if f.startswith("part-")) < 300_000  # over 3,000,000 as text
    assert n == 3000 == spark.read.text(path).distinct().count()
    assert [r["n_rows"] for r in K.read_payload(spark, f"{out}/payload").orderBy("chunk_id").collect()] == [1000] * 3
    assert K.payload_rows(K.read_payload(spark, f"{out}/payload")).distinct().count() == 3000
    assert set(S.POS_COLUMNS) < set(spark.read.parquet(f"{out}/rows").columns)  # numbered as columns, not as JSON text


@pytest.mark.parametrize("query", ["sink_overwrite", "sink_append"])
def test_sinks_find_missed_lines_once(spark, query, monkeypatch):
    plans = []
    for name in ("write_overwrite", "write_append"):
        plain = getattr(K, name)
        monkeypatch.setattr(K, name, lambda df, *a, plain=plain, **kw: (plans.append("LeftAnti" in df._jdf.queryExecution().toString()), plain(df, *a, **kw))[1])
    assert REG.QUERIES[query](spark, SF_SMALL).count() == 1685
    assert sum(plans) == 1 < len(plans)


def test_archive_shuffles_the_lines_and_their_day_alone(spark, monkeypatch):
    from tallyspark.plans import history as H
    frame = type(few_lines(spark))
    seen, plain = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: (seen.append(self.columns), plain(self, *a))[1])
    path = work_dir(spark, "test-archive") + "/history"
    assert H.archive_lines(few_lines(spark), path, "b") == 48
    assert seen == [[*S.POS_COLUMNS, H.DAY]]
    assert H.read_history(spark, path).where(F.col(H.BATCH) == "b").select(*S.POS_COLUMNS).exceptAll(few_lines(spark)).count() == 0


ODD = [None, "", "a", "\u001f", "\u001a", "\u001b", "\u001b0", "\u001b1\u001f", "\u001b\u001a2", "0", "\u001b\u001b", "\u00e9|\n\\"]


def test_packed_columns_come_back(spark):
    rows = [(a, b, c) for a in ODD for b in ODD for c in ODD]
    packed = spark.createDataFrame(rows, "a string, b string, c string").select(pack(["a", "b", "c"]).alias("text"), F.struct("a", "b", "c").alias("was"))
    assert packed.select("text").distinct().count() == len(rows)  # equal only where all columns are
    back = unpack(packed, "text", ["a", "b", "c"], "was").collect()
    assert len(back) == len(rows) and all((r["a"], r["b"], r["c"]) == tuple(r["was"]) for r in back)


@pytest.mark.parametrize("a_place", [1_000_000, 10])
def test_new_lines_lie_by_day(shuffled, a_place, monkeypatch):
    from tallyspark.plans import history as H
    monkeypatch.setattr(H, "LINES_A_PLACE", a_place)
    batch = few_lines(shuffled).unionByName(lines_df(shuffled, [pos_line(hd_file_extract_date_time=t, itm_sku=f"{i}") for t in (None, "", "2024-02-02 00:00:00")
                                                                for i in (1, 2, 2)]))
    history = batch.where("hd_order_or_tran_id = 'SALE#7' OR itm_sku = '1'")
    found = H.new_lines_by_day(batch, history)
    shuffles = exchanges(found)
    assert len([k for k in shuffles if "_place" in k]) == 1 and not [k for k in shuffles if "_line" in k or "hd_" in k]  # one shuffle, by day and place
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found) == rows(new_lines(batch, history, cols=S.POS_COLUMNS))
    assert rows(H.new_lines_by_day(batch, None)) == rows(batch.distinct())


def test_job_archives_lines_as_they_lie(shuffled, monkeypatch):
    from tallyspark.plans import history as H
    from tallyspark.plans.pos_job import run_pos_reconcile
    inp, run = inputs(shuffled), work_dir(shuffled, "test-laid")
    H.archive_lines(inp.history, f"{run}/history", "before")
    frame = type(inp.batch)
    hints, plain = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: (hints.append(a), plain(self, *a))[1])
    r = run_pos_reconcile(shuffled, inp.batch, f"{run}/history", inp.member, inp.alt, inp.txn, f"{run}/work", f"{run}/out", None, run_ts=dt.datetime(2024, 3, 1), batch_id="b")
    assert r.archived == r.new_lines == 42 and not [a for a in hints if a[0] == "rebalance"]
    new = new_lines(inp.batch, inp.history, cols=S.POS_COLUMNS)
    archived = H.read_history(shuffled, f"{run}/history").where(F.col(H.BATCH) == "b")
    rows = lambda df: sorted(map(str, df.select(*S.POS_COLUMNS).collect()))
    assert rows(archived) == rows(new)
    assert len(os.listdir(local_path(f"{run}/history/{H.DAY}=2024-02-01/{H.PART}=b"))) <= 2 * 2  # a file of the day, or two, and their checksums
    assert sorted(map(str, shuffled.read.parquet(r.missed_path).select(*S.MISSED_COLUMNS).collect())) == sorted(map(str, R.missed_lines(inp).collect()))


@pytest.mark.parametrize("query", ["_run_job", "_run_stream"])
def test_jobs_bind_their_tables_from_one_join(spark, query, monkeypatch):
    from tallyspark import fixtures as FX
    joins, plain = [], FX.pos_join
    monkeypatch.setattr(FX, "pos_join", lambda *a: (joins.append(a), plain(*a))[1])
    for name in ("pos_base", "pos_lines", "pos_lines_history", "loyalty_txn"):
        monkeypatch.setattr(FX, name, None)
    getattr(REG, query)(spark, SF_SMALL)
    assert len(joins) == 1


def test_stream_leaves_no_shuffle_files(shuffled):
    from tallyspark.session import SHUFFLE_CLEANUP
    from tallyspark import streaming as ST
    inp, root = inputs(shuffled), work_dir(shuffled, "test-stream-disk")
    tables = {}
    for name, df in (("member", inp.member), ("alt", inp.alt), ("txn", inp.txn)):
        df.write.parquet(f"{root}/{name}")
        tables[name] = shuffled.read.parquet(f"{root}/{name}")
    REG._write_csv(inp.batch.repartition(2), f"{root}/in", "|")
    files = lambda: {f for d in shuffled.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
                     for _, _, fs in os.walk(d.getPath()) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}
    was, before = shuffled.conf.get(SHUFFLE_CLEANUP, None), files()
    results = ST.reconcile_stream(shuffled, f"{root}/in", f"{root}/ckpt", f"{root}/out", f"{root}/history", tables["member"], tables["alt"], tables["txn"],
                                  max_files_per_trigger=1, file_glob="*.csv")
    assert sum(r.new_lines for r in results.values()) == 43 and shuffled.conf.get(SHUFFLE_CLEANUP, None) == was
    assert len(files() - before) <= 2, files() - before


RUN_MARKS = [None, "", "a", "\u001c", "\u001d", "\u001e", "\u001b3", "\u001d\u001b4\u001f"]


def test_runs_of_absent_fields_are_packed_short(spark):
    cols = [f"c{i}" for i in range(30)]
    rows = [tuple(RUN_MARKS[(7 * i + n) % 8] if at <= i < at + n else None for i in range(30)) for at in range(30) for n in range(1, 31 - at)]
    rows = sorted({*rows, (None,) * 30}, key=str)
    packed = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).select(pack(cols).alias("text"), F.array(*cols).alias("was"))
    assert packed.select("text").distinct().count() == len(rows)  # equal only where all columns are
    assert all([r[c] for c in cols] == list(r["was"]) for r in unpack(packed, "text", cols, "was").collect())
    assert packed.where("forall(was, x -> x is null)").select(F.length("text")).first()[0] <= 10  # 59 with a mark and a separator each


def test_job_writes_missed_lines_once(shuffled):
    from tallyspark.plans import history as H
    from tallyspark.plans.pos_job import run_pos_reconcile
    inp, run = inputs(shuffled), work_dir(shuffled, "test-placed")
    H.archive_lines(inp.history, f"{run}/history", "before")
    r = run_pos_reconcile(shuffled, inp.batch, f"{run}/history", inp.member, inp.alt, inp.txn, f"{run}/work", f"{run}/out", None, run_ts=dt.datetime(2024, 3, 1),
                          batch_id="b", payload_rows=10)
    assert not os.path.exists(local_path(f"{run}/work/payload_rows"))
    chunks = K.read_payload(shuffled, r.payload_path)
    assert sorted((c["chunk_id"], c["n_rows"]) for c in chunks.collect()) == [(i, min(10, r.missed - 10 * i)) for i in range(-(-r.missed // 10))] and r.missed > 10
    lines = lambda df: sorted(x["row_json"] for x in df.collect())
    assert lines(K.payload_rows(chunks)) == lines(shuffled.read.text(r.export_path).withColumnRenamed("value", "row_json"))


def shuffle_files(spark) -> set[str]:
    return {f for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
            for _, _, fs in os.walk(d.getPath()) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}


def left_behind(spark, before: set[str], most: int = 0) -> set[str]:
    """Shuffle files that are there since; they are removed in the background, so it is waited for."""
    for _ in range(50):
        if len(shuffle_files(spark) - before) <= most:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_writes_leave_no_shuffle_files(shuffled):
    from tallyspark.operators.keys import place_rows
    from tallyspark.plans import history as H
    from tallyspark.session import SHUFFLE_CLEANUP
    batch, run = few_lines(shuffled), work_dir(shuffled, "test-no-shuffles")
    found = batch.groupBy(*S.POS_COLUMNS).count().select(*S.POS_COLUMNS)
    writes = {
        "overwrite": lambda: K.write_overwrite(found, f"{run}/overwrite"),
        "append": lambda: K.write_append(found, f"{run}/append"),
        "export": lambda: K.export_json_lines(found, run, "export.json", dt.datetime(2024, 3, 1)),
        "place": lambda: place_rows(found, path=f"{run}/placed"),
        "payload": lambda: K.write_payload(K.bulk_payload_chunks(found, 10, stage=f"{run}/rows"), f"{run}/payload"),
        "csv": lambda: REG._write_csv(found, f"{run}/csv", "|"),
        "archive": lambda: [H.archive_lines(found, f"{run}/history", b) for b in ("a", "b")],
        "compact": lambda: H.compact(shuffled, f"{run}/history"),
    }
    was = shuffled.conf.get(SHUFFLE_CLEANUP, None)
    for name, write in writes.items():
        before = shuffle_files(shuffled)
        write()
        assert not left_behind(shuffled, before), name
    assert shuffled.conf.get(SHUFFLE_CLEANUP, None) == was
    assert H.read_history(shuffled, f"{run}/history").count() == 2 * found.count()


def test_job_keeps_shuffle_files_of_one_step_at_a_time(shuffled, monkeypatch):
    from tallyspark.plans import history as H
    from tallyspark.plans import pos_job as J
    inp, run, seen = inputs(shuffled), work_dir(shuffled, "test-one-step"), []
    H.archive_lines(inp.history, f"{run}/history", "before")
    before = shuffle_files(shuffled)
    for name in ("write_overwrite", "place_rows", "archive_lines", "export_json_lines"):
        plain = getattr(J, name)
        monkeypatch.setattr(J, name, lambda *a, plain=plain, **kw: (seen.append(len(left_behind(shuffled, before, 2))), plain(*a, **kw))[1])
    r = J.run_pos_reconcile(shuffled, inp.batch, f"{run}/history", inp.member, inp.alt, inp.txn, f"{run}/work", f"{run}/out", None, run_ts=dt.datetime(2024, 3, 1), batch_id="b")
    assert len(seen) >= 6 and max(seen) <= 2, seen  # the two small ones are the count by kind, which is collected
    assert not os.path.exists(local_path(f"{run}/work/matching"))
    assert sorted(map(str, shuffled.read.parquet(r.missed_path).select(*S.MISSED_COLUMNS).collect())) == sorted(map(str, R.missed_lines(inp).collect()))


KINDS = [("SALE#1", None), ("SALE#1", "SALE#1"), ("RETU#2", "SALE#1"), ("RETU#2", None), ("RETU#2", "SALE#8"), ("VOID#3", "SALE#1"), ("VOID#3", "SALE#9"),
         ("OTHER#4", "SALE#1"), (None, "SALE#1")]


def test_lines_without_an_original_pass_the_join_by(shuffled):
    from tallyspark.functions import tran_kind
    from tallyspark.operators.reconcile import DEFAULT_RULES, without_original
    rows = [(member, *ids) for ids in KINDS for member in (1, 2, None)]
    cands = shuffled.createDataFrame(rows, "memberid int, tran_id string, orig_tran_id string").withColumn("kind", tran_kind("tran_id"))
    txn = txn_df(shuffled, [txn_row(referencenumber="SALE#1", type="RETURN"), txn_row(referencenumber="SALE#9", type="VOID_RETURN"), txn_row(referencenumber=None, type="RETURN")])
    text = lambda df: sorted(map(str, df.select(*cands.columns).collect()))
    found = without_original(cands, txn, staged=True)
    assert text(found) == text(without_original(cands, txn)) and 0 < found.count() < len(rows)
    assert text(without_original(cands, txn, DEFAULT_RULES[:1], staged=True)) == text(cands)
    p = plan(found)
    assert "Union" in p and "isnotnull(orig_tran_id" in p.replace(" ", "")


def test_compaction_shuffles_lines_as_texts(shuffled, monkeypatch):
    from tallyspark.plans import history as H
    lines = few_lines(shuffled).unionByName(lines_df(shuffled, [pos_line(hd_file_extract_date_time=t, itm_sku="x\u001fy") for t in (None, "", "2024-02-02 00:00:00")]))
    path = work_dir(shuffled, "test-compact-texts") + "/history"
    for batch in ("a", "b"):
        H.archive_lines(lines, path, batch)
    was = sorted(map(str, H.read_history(shuffled, path).drop(H.PART).collect()))
    frame = type(lines)
    seen, plain = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: (seen.append(self.columns), plain(self, *a))[1])
    assert H.compact(shuffled, path) == 3  # two days and the lines without one
    assert seen == [["_line", H.BATCH, H.DAY]]
    assert sorted(map(str, H.read_history(shuffled, path).drop(H.PART).collect())) == was
    assert all(len(parts) == 1 and parts[0].startswith("compacted-") for parts in H.open_parts(shuffled, path).values())


@pytest.mark.parametrize("query, rows", [("sink_json_lines", 1685), ("sink_bulk_payload", 1685), ("sink_payload_chunks", 2), ("job_history_compacted", None)])
def test_queries_bind_once_and_remove_their_steps(spark, query, rows, monkeypatch):
    from tallyspark import fixtures as FX
    joins, folders, plain, work = [], [], FX.pos_join, REG.work_dir
    monkeypatch.setattr(FX, "pos_join", lambda *a: (joins.append(a), plain(*a))[1])
    monkeypatch.setattr(REG, "work_dir", lambda *a: (folders.append(work(*a)), folders[-1])[1])
    for name in ("pos_base", "pos_lines", "pos_lines_history", "loyalty_txn"):
        monkeypatch.setattr(FX, name, None)
    found = REG.QUERIES[query](spark, SF_SMALL)
    assert len(joins) == 1 and found.count() == (rows or 900 + 5100)
    left = {f for f in os.listdir(local_path(folders[0])) if not f.startswith(".")}
    assert left in ({"20240301_0000_missed_transactions.json"}, {"chunks"}, {"history"}), left


def test_stream_keeps_little_beside_its_output(spark):
    root, results = REG._run_stream(spark, SF_SMALL)
    own = local_path(root)
    assert len(results) == 2 and not os.path.exists(f"{own}/joined")
    moved = [f"{p}/{f}" for p, _, fs in os.walk(f"{own}/processed") for f in fs if f.startswith("part-")]
    assert len(moved) == 4 and all(f.endswith(".csv.bz2") for f in moved)
    assert sum(map(os.path.getsize, moved)) < 6559 * 50  # over 120 bytes a line as text
    assert not [e for e in results if {"batch", "new_lines"} & set(os.listdir(f"{own}/out/epoch={e}/work"))]


def test_packed_drops_are_read_whole_in_several_splits(spark):
    folder = work_dir(spark, "test-splits")
    lines = spark.range(60_000).select(*[F.sha2(F.concat(F.col("id"), F.lit(c)), 256).alias(c) if c in S.POS_COLUMNS[:3] else F.lit(None).cast("string").alias(c) for c in S.POS_COLUMNS])
    REG._write_csv(lines.coalesce(1), folder, "|", compression=REG.DROP_CODEC)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, ("1m", "1k"), strict=True):
            spark.conf.set(k, v)
        back = REG.SRC.read_pos_lines(spark, folder)
        assert back.select(F.spark_partition_id()).distinct().count() > 2
        assert back.exceptAll(lines).count() == 0 == lines.exceptAll(back).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
