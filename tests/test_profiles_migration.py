"""Profiles, back-fill, keys, defaults and quality checks on small inputs."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.operators import profiles as P
from tallyspark.operators.backfill import BACKFILL_BY, backfill_ids
from tallyspark.operators.keys import assign_index, assign_sequential_ids
from tallyspark.operators.migrate import conform, contacts_to_target, running_load_counts
from tallyspark.operators.quality import foreign_key_violations, not_null_counts, primary_key_violations, unique_violations

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def _profiles(spark, rows):
    return spark.createDataFrame(rows, S.PROFILE_DIM_SCHEMA)


def test_latest_profile_case_ties_and_nulls(spark):
    prof = _profiles(spark, [
        ("u1", "A@X.com", 1, 0, T0), ("u2", "a@x.com", 1, 0, T1),   # latest wins, case-insensitive
        ("u3", "b@x.com", 1, 0, T1), ("u4", "b@x.com", 1, 0, T1),   # tie: larger uuid
        ("u5", "c@x.com", 1, 0, None), ("u6", "c@x.com", 1, 0, T0),  # NULL time sorts last
        ("u7", "d@x.com", 0, 0, T1),                                  # inactive: ignored
    ])
    web = spark.createDataFrame([("A@x.COM",), ("B@X.COM",), ("c@x.com",), ("d@x.com",)], S.WEB_USER_SCHEMA)
    got = {r["email"]: r["uuid"] for r in P.latest_profile_per_email(prof, web).collect()}
    assert got == {"a@x.com": "u2", "b@x.com": "u4", "c@x.com": "u6"}


def test_null_email_group_kept_in_counts(spark):
    prof = _profiles(spark, [("u1", None, 1, 0, T0), ("u2", None, 1, 0, T0), ("u1", "e", 1, 0, T0)])
    got = {r["email_address"]: r["n"] for r in
           P.having_count(prof, "email_address", "uuid", distinct=True, out="n").collect()}
    assert got == {None: 2}
    assert P.having_count(prof, "uuid", "email_address", out="n").count() == 0  # COUNT skips NULL


def test_identity_conflicts(spark):
    prof = _profiles(spark, [
        ("u1", "e1", 1, 0, T0), ("u2", "e1", 1, 0, T0),   # e1: two active ids
        ("u3", "e2", 1, 0, T0), ("u3", "e3", 0, 0, T0),   # u3: two e-mails, one active
        ("u4", "e4", 1, 0, T0), ("u4", "e5", 1, 0, T0),   # u4: two active e-mails
    ])
    got = sorted((r["conflict"], r["key"], r["n"]) for r in P.identity_conflicts(prof).collect())
    assert got == [("email_active_ids", "e1", 2), ("id_one_active_email", "u3", 2)]


def _member(spark, rows):
    return spark.createDataFrame([(i, c, e, T0, "seed") for i, c, e in rows], S.MEMBER_SCHEMA)


def test_backfill_priority_duplicates_and_null_source_id(spark):
    m = _member(spark, [(1, None, "A@x.com"), (2, "KEEP", "b@x.com"), (3, None, "c@x.com"),
                        (4, None, None), (5, None, "e@x.com")])
    crm = spark.createDataFrame([("P9", "a@x.com"), ("P1", "a@x.com"), ("P2", "b@x.com"), (None, "c@x.com")],
                                S.SOURCE_PROFILE_SCHEMA)
    web = spark.createDataFrame([("W1", "a@x.com"), ("W3", "c@x.com"), ("W5", "e@x.com")], S.SOURCE_PROFILE_SCHEMA)
    got = {r["id"]: r for r in backfill_ids(m, [crm, web], "2024-03-01 00:00:00").collect()}
    assert got[1]["consumerid"] == "P1"            # smallest of two source rows, CRM before web
    assert got[2]["consumerid"] == "KEEP" and got[2]["lastupdatedby"] == "seed"
    assert got[3]["consumerid"] == "W3"            # CRM matched with NULL id, web fills
    assert got[4]["consumerid"] is None and got[4]["lastupdatedby"] == "seed"
    assert got[5]["consumerid"] == "W5" and got[5]["lastupdatedby"] == BACKFILL_BY
    assert got[5]["lastupdatedat"] == dt.datetime(2024, 3, 1)
    only_crm = {r["id"]: r for r in backfill_ids(m, [crm], "2024-03-01 00:00:00").collect()}
    assert only_crm[3]["consumerid"] is None and only_crm[3]["lastupdatedby"] == BACKFILL_BY


def test_sequential_ids_are_gap_free_and_ordered(spark):
    df = spark.range(0, 5000).repartition(9).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = assign_sequential_ids(df, ["k"], start=1001).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(1001, 6001))
    assert [r["k"] for r in out] == list(range(5000))
    idx = sorted(r["_idx"] for r in assign_index(df).collect())
    assert idx == list(range(5000))


def test_defaults_only_for_absent_columns(spark):
    stage = spark.createDataFrame([("e@x.com", None)], "email string, lastupdatedby string")
    r = contacts_to_target(stage, "2024-03-01 00:00:00").first()
    assert r["crmid_reused"] is False and r["createdat"] == dt.datetime(2024, 3, 1)
    assert r["lastupdatedby"] is None            # present but NULL stays NULL
    with_col = stage.withColumn("createdat", F.lit(None).cast("timestamp_ntz"))
    assert contacts_to_target(with_col, "2024-03-01 00:00:00").first()["createdat"] is None
    assert conform(stage, S.CONTACT_SCHEMA).columns == S.CONTACT_SCHEMA.fieldNames()


def test_running_counts(spark):
    df = spark.createDataFrame([("BE",), ("BE",), ("CZ",), ("DE",), ("DE",), ("DE",)], "country string")
    got = [(r[0], r[1], r[2]) for r in running_load_counts(df).orderBy("country").collect()]
    assert got == [("BE", 2, 2), ("CZ", 1, 3), ("DE", 3, 6)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None), (3, "a")], "id int, email string")
    pk = {(r["id"], r["n"], r["problem"]) for r in primary_key_violations(df, ["id"]).collect()}
    assert pk == {(None, 1, "null"), (1, 2, "duplicate")}
    assert [(r["value"], r["n"]) for r in unique_violations(df, "email").collect()] == [("a", 2)]
    nn = {r["column"]: r["n_null"] for r in not_null_counts(df, ["id", "email"]).collect()}
    assert nn == {"id": 1, "email": 1}
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert sorted(r["id"] for r in foreign_key_violations(df, "id", parent, "id").collect()) == [3]


def test_top_k_per_key(spark):
    prof = _profiles(spark, [("u1", "e", 1, 0, T0), ("u2", "e", 1, 0, T1), ("u3", "e", 1, 0, None),
                             ("u4", "f", 1, 0, T0)])
    got = P.top_k_per_key(prof, "email_address", [F.col("last_update_ts").desc_nulls_last()], 2)
    assert sorted(r["uuid"] for r in got.collect()) == ["u1", "u2", "u4"]


def test_contact_load_job(spark):
    import tempfile
    from tallyspark.plans.contact_job import run_contact_load
    d = tempfile.mkdtemp()
    rows = [("a@x.com", "A1", "BE"), ("a@x.com", "A2", "BE"), (None, "A3", "CZ"), ("c@x.com", "A4", None)]
    stage = spark.createDataFrame([(e, a, None, c) + (None,) * 9 for e, a, c in rows], S.CONTACT_STAGE_SCHEMA)
    for c in ("BE", "CZ", "XX"):
        part = stage.where(F.col("country") == c) if c != "XX" else stage.where(F.col("country").isNull())
        part.write.option("header", "true").csv(f"{d}/{c}")
    res = run_contact_load(spark, [f"{d}/BE", f"{d}/CZ", f"{d}/XX"], f"{d}/target", "2024-03-01 00:00:00")
    assert res.loaded == 4
    assert {r["column"]: r["n_null"] for r in res.null_counts.collect()} == {"email": 1, "country": 1}
    assert [(r["value"], r["n"]) for r in res.duplicates["email"].collect()] == [("a@x.com", 2)]
    counts = {r["country"]: (r["n_rows"], r["running_rows"]) for r in res.running_counts.collect()}
    assert counts == {None: (1, 1), "BE": (2, 3), "CZ": (1, 4)}


def test_run_time_defaults_to_now(spark):
    stage = spark.createDataFrame([("e@x.com",)], "email string")
    r = contacts_to_target(stage).first()
    assert r["createdat"] is not None and r["createdat"] == r["lastupdatedat"]
    m = _member(spark, [(1, None, "a@x.com")])
    src = spark.createDataFrame([("P1", "a@x.com")], S.SOURCE_PROFILE_SCHEMA)
    got = backfill_ids(m, [src]).first()
    assert got["consumerid"] == "P1" and got["lastupdatedat"] > T0
    dtd = backfill_ids(m, [src], dt.datetime(2024, 5, 6, 7, 8, 9)).first()
    assert dtd["lastupdatedat"] == dt.datetime(2024, 5, 6, 7, 8, 9)
