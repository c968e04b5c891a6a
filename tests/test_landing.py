"""Tables that runs rewrite and ledgers that they keep: compaction, landing back-fill, keys, steps, consumed files, rejects, marks."""

import contextlib
import io
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from helpers import EMPTY_ALT, alt_ids, lines_df, members, pos_line, txn_df
from tallyspark import files as FS
from tallyspark import fixtures as FX
from tallyspark import schemas as S
from tallyspark import sinks as K
from tallyspark import sources as SRC
from tallyspark import streaming as ST
from tallyspark.operators import profiles as P
from tallyspark.operators.delta import new_lines
from tallyspark.operators.keys import number_rows, place_rows
from tallyspark.operators.quality import primary_key_violations
from tallyspark.operators.resolve import member_lookup, resolve_members, resolve_stored, stage_lines, store_lookup
from tallyspark.plans import backfill_job as BF
from tallyspark.plans import history as H
from tallyspark.plans import key_store as KS
from tallyspark.plans.key_store import MERGE_AT, KeyStore
from tallyspark.plans.ledger import KeyLedger, StepLedger, fingerprint
from tallyspark.plans.pos_job import run_pos_reconcile, txn_for_days
from tallyspark.session import local_path, work_dir
from test_jobs import RUN


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def listed(path):
    return {(os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, fs in os.walk(local_path(path)) for f in fs if not f.startswith(".")}


# -- history --------------------------------------------------------------------------------------------------------


@pytest.fixture()
def many_batches(spark):
    """History as 200 small batches leave it, their parts written at once, some lines without a day and one with an odd one."""
    path = work_dir(spark, "test-history") + "/history"
    lines = FX.pos_lines_history(spark, SF_SMALL).where("hd_file_extract_date_time rlike '^1995' OR hd_file_extract_date_time IS NULL")
    odd = lines_df(spark, [pos_line(hd_file_extract_date_time=t, hd_order_or_tran_id=f"SALE#odd-{i}") for i, t in enumerate([None, "", "a=b/c: %", "a=b/c: %"])])
    dated = lines.unionByName(odd).withColumn(H.DAY, H.extract_day())
    named = dated.withColumn(H.PART, F.concat(F.lit("b"), F.pmod(F.xxhash64("itm_sku", "hd_order_or_tran_id"), F.lit(200)).cast("string")))
    named.withColumn(H.BATCH, F.col(H.PART)).repartition(1).write.partitionBy(H.DAY, H.PART).parquet(path)
    return path


def history_rows(spark, path):
    return H.read_history(spark, path).select(*S.POS_COLUMNS)


def test_compaction_keeps_every_line_in_few_files(spark, many_batches):
    path = many_batches
    lines = [tuple(r) for r in history_rows(spark, path).collect()]
    parts = sum(len(p) for p in H.open_parts(spark, path).values())
    middle = sorted(d for d in H.open_parts(spark, path) if d.startswith(f"{H.DAY}=1"))
    before = middle[len(middle) // 2].removeprefix(f"{H.DAY}=")
    assert parts > 150 and H.compact(spark, path, before) > 5
    after = H.open_parts(spark, path)
    for day, own in after.items():
        closed = day in (f"{H.DAY}={H.NO_DAY}", *(d for d in middle if d < f"{H.DAY}={before}"))
        assert (len(own) == 1) == closed or len(own) == 1
        if closed:
            files = [f for f in FS.Files(spark).walk(f"{path}/{day}") if f.name.endswith(".parquet")]
            assert own[0].startswith("compacted-") and len(files) == 1
    assert any(len(own) > 1 for own in after.values())  # days that are not closed stay as they are
    assert H.compact(spark, path, before) == 0 and H.compact(spark, path) > 0 and H.compact(spark, path) == 0
    key = lambda rows: sorted(map(str, rows))
    assert key(tuple(r) for r in history_rows(spark, path).collect()) == key(lines)
    # a batch delivered again has no new lines, and one that is run again is no history to itself
    days = H.batch_days(history_rows(spark, path))
    assert new_lines(history_rows(spark, path), H.history_for_batch(H.read_history(spark, path), days), cols=S.POS_COLUMNS).count() == 0
    some = H.read_history(spark, path).select(H.BATCH).first()[0]
    gone = H.read_history(spark, path, but=some)
    assert 0 < len(lines) - gone.count() == H.read_history(spark, path).where(F.col(H.BATCH) == some).count()


@pytest.mark.parametrize("crash_after", [0, 3])
def test_compaction_that_breaks_off_hides_no_line(spark, many_batches, crash_after, monkeypatch):
    path = many_batches
    lines = sorted(str(tuple(r)) for r in history_rows(spark, path).collect())
    calls = {"n": 0}
    plain = FS.Files.rename if crash_after else FS.Files.create

    def breaks(self, *args):
        calls["n"] += 1
        if calls["n"] > crash_after:
            raise OSError("gone")
        return plain(self, *args)

    monkeypatch.setattr(FS.Files, "rename" if crash_after else "create", breaks)
    with pytest.raises(OSError):
        H.compact(spark, path)
    monkeypatch.undo()
    seen = [str(tuple(r)) for r in history_rows(spark, path).collect()]
    assert set(seen) == set(lines) and len(seen) >= len(lines)  # rows may stand twice until the next run, none is missing
    H.compact(spark, path)
    assert sorted(str(tuple(r)) for r in history_rows(spark, path).collect()) == lines
    assert not [e for e in FS.Files(spark).list(path) if e.name.startswith(FS.WORK)]


def test_days_of_the_batch_prune_history_and_transactions(spark, many_batches):
    run = work_dir(spark, "test-days")
    H.batch_days(FX.pos_lines(spark, SF_SMALL).where("hd_file_extract_date_time like '1995-0%'")).write.parquet(f"{run}/days")
    days = spark.read.parquet(f"{run}/days")
    p = plan(H.history_for_batch(H.read_history(spark, many_batches), days))
    assert "dynamicpruning" in p and "LeftSemi" in p
    FX.loyalty_txn(spark, SF_SMALL).withColumn("txn_day", F.to_date("date")).write.partitionBy("txn_day").parquet(f"{run}/txn")
    p = plan(txn_for_days(spark.read.parquet(f"{run}/txn"), days.select(F.to_date("_day").alias("_day")).where("_day IS NOT NULL"), "txn_day"))
    assert "dynamicpruning" in p


# -- back-fill ------------------------------------------------------------------------------------------------------


def test_back_fill_rewrites_only_buckets_with_changes(spark):
    run = work_dir(spark, "test-backfill")
    rows = [(i, None if i % 2 else f"C{i}", f"User{i}@X.com") for i in range(400)] + [(900, None, None)]
    BF.land_members(members(spark, rows), f"{run}/member", 32)
    before = listed(f"{run}/member")
    src = lambda *pairs: spark.createDataFrame(list(pairs), "uuid string, email string")
    one = BF.run_backfill(spark, f"{run}/member", [src(("P1", "user1@x.com"), ("P2", "user2@x.com"), ("P0", "user1@x.com")), src(("W1", "user1@x.com"), ("W3", "user3@x.com"))],
                          f"{run}/one", RUN, "one")
    assert one.changed == 2 and one.buckets <= 2
    got = {r["id"]: r for r in BF.read_members(spark, f"{run}/member").collect()}
    assert len(got) == 401 and (got[1]["consumerid"], got[3]["consumerid"], got[2]["consumerid"]) == ("P0", "W3", "C2")
    assert got[1]["lastupdatedat"] == RUN and got[5]["lastupdatedat"] is None and {r["run"] for r in got.values()} >= {"first"}
    after = listed(f"{run}/member")
    kept = {name for name, _ in before & after}
    untouched = {r["bucket"] for r in got.values() if r["run"] == "first"}
    assert len(untouched) >= 28 and len(kept) >= len(untouched)
    again = BF.run_backfill(spark, f"{run}/member", [src(("P1", "user1@x.com"), ("W3", "user3@x.com"))], f"{run}/again", RUN, "one")
    assert (again.changed, again.buckets) == (0, 0) and listed(f"{run}/member") == after
    # a source row without an id sets the audit columns and nothing else
    null = BF.run_backfill(spark, f"{run}/member", [src((None, "user5@x.com"))], f"{run}/null", RUN, "null")
    assert null.changed == 1
    five = BF.read_members(spark, f"{run}/member").where("id = 5").first()
    assert five["consumerid"] is None and five["lastupdatedat"] == RUN


def test_back_fill_that_breaks_off_is_finished(spark, monkeypatch):
    run = work_dir(spark, "test-backfill-crash")
    BF.land_members(members(spark, [(i, None, f"u{i}@x.com") for i in range(60)]), f"{run}/member", 4)
    source = spark.createDataFrame([(f"P{i}", f"u{i}@x.com") for i in range(60)], "uuid string, email string")
    plain, calls = FS.Files.delete, {"n": 0}

    def breaks(self, path):
        calls["n"] += 1
        if calls["n"] > 1:
            raise OSError("gone")
        return plain(self, path)

    monkeypatch.setattr(FS.Files, "delete", breaks)
    with pytest.raises(OSError):
        BF.run_backfill(spark, f"{run}/member", [source], f"{run}/work", RUN, "r")
    monkeypatch.undo()
    rows = BF.read_members(spark, f"{run}/member").collect()
    assert sorted(r["id"] for r in rows) == list(range(60)) and all(r["consumerid"] == f"P{r['id']}" for r in rows)


# -- ledgers --------------------------------------------------------------------------------------------------------


def test_key_ranges_never_overlap_and_are_found_again(spark):
    folder = work_dir(spark, "test-keys") + "/keys"
    a, b = KeyLedger(spark, folder, 1001), KeyLedger(spark, folder, 1001)
    assert a.reserve("x", 10) == [(1001, 10)] and b.reserve("y", 5) == [(1011, 5)] and a.reserve("x", 10) == [(1001, 10)]
    assert b.reserve("x", 12) == [(1001, 10), (1016, 2)] and a.reserve("x", 12) == [(1001, 10), (1016, 2)] and a.reserve("x", 3) == [(1001, 3)]
    assert a.reserve("z", 0) == [] and a.reserve("y", 5) == [(1011, 5)]
    # two loads that see the same last range: the second one's file is refused, and it looks again
    seen, plain = [], b.ranges

    def stale():
        seen.append(1)
        known = plain()
        if len(seen) == 1:
            a.reserve("fast", 7)
        return known

    b.ranges = stale
    assert b.reserve("slow", 4) == [(1025, 4)] and a.reserve("fast", 7) == [(1018, 7)]
    taken = sorted(i for r in a.ranges() for i in range(r["first"], r["first"] + r["count"]))
    assert taken == list(range(1001, 1029))


def test_rows_take_ids_from_several_ranges(spark):
    placed = place_rows(spark.range(100).select((99 - F.col("id")).alias("k")).repartition(5), ["k"], work_dir(spark, "test-placed") + "/rows")
    got = {r["k"]: r["id"] for r in number_rows(placed, "id", [(10, 30), (500, 60), (1000, 20)]).collect()}
    assert got == {k: 10 + k if k < 30 else 470 + k if k < 90 else 910 + k for k in range(100)}


def test_steps_go_on_where_they_broke_off(spark):
    folder = work_dir(spark, "test-steps") + "/ledger"
    ran = []

    def attempt(marks, fail=None):
        ledger = StepLedger(spark, folder)
        for name, mark in marks.items():
            def work(name=name):
                if name == fail:
                    raise OSError(name)
                ran.append(name)
                return {"rows": len(ran)}
            ledger.step(name, mark, work)
        return ledger.entries()

    with pytest.raises(OSError):
        attempt({"a": "1", "b": "1", "c": "1"}, fail="b")
    assert ran == ["a"]
    entries = attempt({"a": "1", "b": "1", "c": "1"})
    assert ran == ["a", "b", "c"] and [(e["step"], e["ran"]) for e in entries] == [("a", 1), ("b", 1), ("c", 1)]
    attempt({"a": "1", "b": "2", "c": "1"})  # another input: this step and all after it
    assert ran == ["a", "b", "c", "b", "c"]
    one = spark.createDataFrame([(1,)], "x int")
    path = work_dir(spark, "test-print") + "/t"
    one.write.parquet(path)
    first = fingerprint(spark.read.parquet(path), 5)
    assert first == fingerprint(spark.read.parquet(path), 5) != fingerprint(spark.read.parquet(path), 6)
    one.union(one).write.mode("overwrite").parquet(path)
    assert first != fingerprint(spark.read.parquet(path), 5)


def test_a_resumed_run_sees_what_others_archived(spark):
    run = work_dir(spark, "test-resume")
    lines = [pos_line(hd_order_or_tran_id=f"SALE#{i}-1") for i in range(4)]
    lines_df(spark, lines).write.parquet(f"{run}/batch")

    def go(threshold):
        return run_pos_reconcile(spark, spark.read.parquet(f"{run}/batch"), f"{run}/history", members(spark, [(1, "C1", None)]), alt_ids(spark, EMPTY_ALT), txn_df(spark, []),
                                 f"{run}/w", f"{run}/o", threshold=threshold, run_ts=RUN, batch_id="b", resume=True)

    assert not go(2).passed and K.ready_exports(spark, f"{run}/o") == {}
    H.archive_lines(lines_df(spark, lines[:3]), f"{run}/history", "other")  # another batch brings three of the lines meanwhile
    r = go(2)
    assert (r.imported, r.new_lines, r.missed, r.passed, r.archived) == (4, 1, 1, True, 1)
    assert K.read_ready(spark, f"{run}/o").count() == 1
    assert go(2).archived == 1 and H.read_history(spark, f"{run}/history").count() == 4


def test_exports_show_only_when_their_batch_is_done(spark, monkeypatch):
    import tallyspark.plans.pos_job as J

    run = work_dir(spark, "test-ready")
    args = (spark, lines_df(spark, [pos_line()]), f"{run}/history", members(spark, [(1, "C1", None)]), alt_ids(spark, EMPTY_ALT), txn_df(spark, []), f"{run}/w", f"{run}/o", None)

    def fails(*_):
        raise OSError("gone")

    monkeypatch.setattr(J, "archive_lines", fails)
    with pytest.raises(OSError):
        run_pos_reconcile(*args, run_ts=RUN, batch_id="b")
    assert K.read_ready(spark, f"{run}/o").count() == 0
    monkeypatch.undo()
    r = run_pos_reconcile(*args, run_ts=RUN, batch_id="b")
    assert K.read_ready(spark, f"{run}/o").count() == 1 and list(K.ready_exports(spark, f"{run}/o")) == ["batch_id=b"]
    spark.createDataFrame([("{}",)], "value string").write.mode("append").text(r.export_path)
    with pytest.raises(ValueError, match="differs"):
        K.read_ready(spark, f"{run}/o")


# -- stream ---------------------------------------------------------------------------------------------------------


def test_consumed_files_leave_the_drop_folder_once(spark, monkeypatch):
    run = work_dir(spark, "test-consumed")
    header = "|".join(S.POS_COLUMNS)
    folder = local_path(f"{run}/in")
    os.makedirs(folder)

    def drop(name, *ids):
        rows = ["|".join(pos_line(hd_order_or_tran_id=i)[c] or "" for c in S.POS_COLUMNS) for i in ids]
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join([header, *rows]) + "\n")

    drop("a b+c.csv", "SALE#1-1")
    drop("b.csv", "SALE#2-1", "SALE#3-1")
    drop("header only.csv")

    def stream():
        return ST.reconcile_stream(spark, f"{run}/in", f"{run}/ckpt", f"{run}/out", f"{run}/history", members(spark, [(1, "C1", None)]), alt_ids(spark, EMPTY_ALT), txn_df(spark, []),
                                   archive_dir=f"{run}/done", file_glob="*.csv")

    def fails(*_, **__):
        raise OSError("gone")

    # a crash between the archive and the move: the files stay, and the next run moves them without reading them again
    monkeypatch.setattr(ST, "move_consumed", fails)
    with pytest.raises(Exception, match="gone"):
        stream()
    monkeypatch.undo()
    assert len(os.listdir(folder)) >= 3
    archived = H.read_history(spark, f"{run}/history")
    n = archived.count() if archived else 0
    stream()
    left = [f for f in os.listdir(folder) if f.endswith(".csv")]
    assert left == [] and H.read_history(spark, f"{run}/history").count() == 3 >= n
    # a name that comes again is a new delivery: it is not moved by the old list
    moved = [f for _, _, fs in os.walk(local_path(f"{run}/done")) for f in fs if f.endswith(".csv")]
    assert len(moved) == 3 and any("header only" in f for f in moved)
    drop("b.csv", "SALE#9-1")
    assert ST.move_consumed(spark, f"{run}/in", f"{run}/out", f"{run}/done") == 0 and os.path.exists(f"{folder}/b.csv")
    assert json.loads(FS.Files(spark).read(f"{run}/out/epoch=0/moved.json")) == {"epoch": 0}


def test_a_bad_stamp_does_not_block_the_stream(spark):
    run = work_dir(spark, "test-stream-bad")
    folder = local_path(f"{run}/in")
    os.makedirs(folder)
    rows = ["|".join(pos_line(hd_order_or_tran_id=i, hd_order_date_time=t)[c] or "" for c in S.POS_COLUMNS) for i, t in (("SALE#1-1", "31/01/2024"), ("SALE#2-1", "2024-01-31 10:00:00"))]
    with open(f"{folder}/a.csv", "w") as f:
        f.write("\n".join(["|".join(S.POS_COLUMNS), *rows]) + "\n")
    results = ST.reconcile_stream(spark, f"{run}/in", f"{run}/ckpt", f"{run}/out", f"{run}/history", members(spark, [(1, "C1", None)]), alt_ids(spark, EMPTY_ALT), txn_df(spark, []),
                                  strict_ts=False)
    assert [(r.rejected, r.missed) for r in results.values()] == [(1, 1)]


# -- lookup, rejects, state -----------------------------------------------------------------------------------------


def test_stored_lookup_joins_without_a_shuffle(spark):
    run = work_dir(spark, "test-lookup")
    lines, member, alt = FX.pos_lines(spark, SF_SMALL), FX.member(spark, SF_SMALL), FX.member_alt_id(spark, SF_SMALL)
    store_lookup(member, alt, "test_lookup", f"{run}/lookup", 8)
    stage_lines(lines, "test_lines", f"{run}/lines", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = resolve_stored(spark.table("test_lines"), spark.table("test_lookup"))
        p = plan(joined)
        assert "Exchange" not in p and "SortMergeJoin" in p
        rows = lambda df: sorted(map(str, df.select("memberid", *S.POS_COLUMNS).collect()))
        assert rows(joined) == rows(resolve_members(lines, member, alt))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.table("test_lookup").count() == member_lookup(member, alt).count()


def test_malformed_lines_are_kept_apart_up_to_a_share(spark):
    run = work_dir(spark, "test-bad")
    folder = local_path(f"{run}/in")
    os.makedirs(folder)
    names = S.ACCOUNT_TXN_SCHEMA.fieldNames()
    good = {"altid": "A1", "country": "BE", "accounttransactionid": "7", "accounttransactionvalue": "5", "lastupdatedby": '""'}
    line = lambda **kw: ",".join((good | kw).get(c, "") for c in names)
    lines = [",".join(names), line(), line(accounttransactionvalue="five"), line() + ",more", "too,few", line(accounttransactiondate="yesterday"), line(altid='"A,1"')]
    with open(f"{folder}/one.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    with pytest.raises(SRC.TooManyBadRows, match="4 of 6"):
        SRC.load_delimited(spark, f"{run}/in", S.ACCOUNT_TXN_SCHEMA, f"{run}/staged", most_bad=0.5)
    load = SRC.load_delimited(spark, f"{run}/in", S.ACCOUNT_TXN_SCHEMA, f"{run}/staged", most_bad=0.7)
    assert (load.rows, load.bad) == (6, 4) and load.good.columns == names
    assert sorted((r["altid"], r["lastupdatedby"]) for r in load.good.collect()) == [("A,1", ""), ("A1", "")]
    assert sorted(r["line"] for r in load.rejects.collect()) == sorted([lines[2], lines[3], lines[4], lines[5]])
    assert all(r["source_file"].endswith("one.csv") for r in load.rejects.collect())


def test_state_of_deliveries_in_any_order(spark):
    rows = [("u1", "A@x", 1, 0, "2024-01-01"), ("u2", "a@x", 1, 0, "2024-03-01"), ("u3", "a@X", 1, 0, "2024-03-01"), ("u9", "a@x", 0, 0, "2025-01-01"), ("u4", "b@x", 1, 0, None), ("u5", None, 1, 0, "2024-01-01")]
    frame = spark.createDataFrame(rows, "uuid string, email_address string, active_flag int, is_disabled int, t string").withColumn("last_update_ts", F.to_timestamp_ntz("t", F.lit("yyyy-MM-dd")))
    parts = [P.latest_state(frame.where(F.col("uuid").isin(*u))) for u in (("u3", "u9"), ("u1", "u4"), ("u2", "u5"))]
    whole = sorted(map(str, P.latest_state(frame).collect()))
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 0, 2, 1)):
        state = spark.createDataFrame([], P.STATE)
        for i in order:
            state = P.merge_latest(state, parts[i])
        assert sorted(map(str, state.collect())) == whole
    assert {(r["email"], r["uuid"]) for r in P.latest_state(frame).collect()} == {("a@x", "u3"), ("b@x", "u4"), (None, "u5")}


# -- keys by load ---------------------------------------------------------------------------------------------------


KEY = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])


def found(df):
    return sorted(map(str, df.select("k", "t", "n", "problem").collect()))


def test_keys_of_a_load_are_held_against_its_buckets_alone(spark):
    run = work_dir(spark, "test-keys")
    store, loads = KeyStore(spark, f"{run}/store", KEY, 32), {}
    frame = lambda rows: spark.createDataFrame(rows, "k int, t string, other string")  # noqa: E731  an int is held as the long it stands for
    given = [("a", [(i, "x", "-") for i in range(200)] + [(None, "x", "-"), (7, None, "-")]), ("b", [(3, "x", "-"), (3, "y", "-"), (1000, "x", "-"), (1000, "x", "-")]),
             ("c", [(None, "x", "-")]), ("d", []), ("b", [(1000, "x", "-"), (3, "z", "-")]), ("a", [(3, "z", "-"), (None, None, "-")])]
    for name, rows in given:
        loads[name] = frame(rows)
        store.add(name, loads[name], run)
        table = loads[name].limit(0)
        for rows_of in loads.values():
            table = table.unionByName(rows_of)
        whole = primary_key_violations(table.withColumn("k", F.col("k").cast("long")), ["k", "t"])
        own = loads[name].select(F.col("k").cast("long").alias("_k"), F.col("t").alias("_t")).distinct()
        assert found(store.violations(name)) == found(whole.join(own, F.col("k").eqNullSafe(F.col("_k")) & F.col("t").eqNullSafe(F.col("_t")), "left_semi")), name
    assert store.loads() == ["a", "b", "c", "d"] and store.touched("d") == []
    files = store.read(store.touched("b")).inputFiles()
    assert files and {f.split("_bucket=")[1].split("/")[0] for f in files} == set(map(str, store.touched("b"))) and len(store.touched("b")) <= 2
    assert sorted(r["k"] for r in store.missing(frame([(3, "z", "-"), (3, "q", "-"), (None, "z", "-"), (5, None, "-"), (1000, "x", "-")]), ["k", "t"]).collect()) == [3]


def test_buckets_of_keys_are_merged(spark):
    run = work_dir(spark, "test-keys-merged")
    store = KeyStore(spark, f"{run}/store", KEY, 1)
    for i in range(MERGE_AT + 3):
        store.add(f"l{i}", spark.createDataFrame([(i, "x"), (0, "y")], KEY), run)
        assert len(store._parts(0)) < MERGE_AT
    assert found(store.violations("l5")) == [f"Row(k=0, t='y', n={MERGE_AT + 3}, problem='duplicate')"]
    store.add("l5", spark.createDataFrame([(0, "z")], KEY), run)  # its keys lay in the merged part
    assert found(store.violations("l5")) == [] and found(store.violations("l4")) == [f"Row(k=0, t='y', n={MERGE_AT + 2}, problem='duplicate')"]


@pytest.mark.parametrize("at", ["before", "after"])
def test_keys_of_a_load_that_broke_off_are_added_again(spark, monkeypatch, at):
    run = work_dir(spark, "test-keys-broken")
    store = KeyStore(spark, f"{run}/store", KEY, 4)
    store.add("a", spark.createDataFrame([(1, "x")], KEY), run)
    real = KS.publish

    def broken(*args):
        if at == "after":
            real(*args)
        raise OSError("broken off")

    monkeypatch.setattr(KS, "publish", broken)
    with pytest.raises(OSError, match="broken off"):
        store.add("b", spark.createDataFrame([(1, "x"), (2, "x")], KEY), run)
    monkeypatch.undo()
    assert store.loads() == ["a"]
    store.add("b", spark.createDataFrame([(1, "x"), (2, "x")], KEY), run)
    assert store.loads() == ["a", "b"] and found(store.violations("b")) == ["Row(k=1, t='x', n=2, problem='duplicate')"]
