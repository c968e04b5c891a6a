"""Differential tests: random small inputs with NULL keys, duplicate ids,
fan-out and ties; Spark operators against DuckDB running the source
statements in their literal shape on the same rows."""

import datetime as dt
import os

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harness import digest
from tallyspark import schemas as S
from tallyspark.operators import profiles as P
from tallyspark.operators.backfill import BACKFILL_BY, backfill_ids
from tallyspark.plans import oracle as O
from tallyspark.plans.reconcile import ReconcileInputs, missed_lines

SETTINGS = settings(max_examples=int(os.environ.get("DIFF_EXAMPLES", "6")), deadline=None, suppress_health_check=list(HealthCheck))

IDS = ["C1", "C2", "A1", "A2", "X9", None]
DATES = ["2024-01-31 10:00:00", "2024-01-31 11:00:00", None]
AMOUNTS = ["12.10", "7.5", None]
STORES = ["S1", "S2", None]

line_st = st.fixed_dictionaries({
    "kind": st.sampled_from(["SALE", "RETU", "VOID", "OTHER"]),
    "n": st.integers(1, 3),
    "hd_loyalty_id": st.sampled_from(IDS),
    "hd_order_date_time": st.sampled_from(DATES),
    "hd_store_id": st.sampled_from(STORES),
    "itm_amt_after_disc": st.sampled_from(AMOUNTS),
    "country": st.sampled_from(["BEL", "FRA", None]),
    "hd_currency": st.sampled_from(["EUR", None]),
    "orig": st.sampled_from(["SALE#1", "SALE#2", None]),
})
member_st = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(IDS)), max_size=5)
alt_st = st.lists(st.tuples(st.sampled_from([1, 2, 3, 4, None]), st.sampled_from(IDS)), max_size=6)
txn_st = st.lists(st.fixed_dictionaries({
    "memberid": st.sampled_from([1, 2, 3, 4, None]),
    "ref": st.sampled_from(["SALE#1", "SALE#2", "RETU#1", "VOID#1", "RETU#2", None]),
    "date": st.sampled_from(DATES),
    "store": st.sampled_from(STORES),
    "amount": st.sampled_from([12.1, 7.5, None]),
    "country": st.sampled_from(["BE", "FR", None]),
    "currency": st.sampled_from(["EUR", None]),
    "type": st.sampled_from(["PURCHASE", "RETURN", "VOID_PURCHASE", "VOID_RETURN"]),
}), max_size=8)


def _pos_rows(lines):
    out = []
    for ln in lines:
        r = {c: None for c in S.POS_COLUMNS}
        r.update({k: v for k, v in ln.items() if k in r})
        r["hd_file_extract_date_time"] = "2024-02-01 00:00:00"
        r["hd_order_or_tran_id"] = f"{ln['kind']}#{ln['n']}"
        r["hd_orig_tran_id"] = ln["orig"]
        out.append(r)
    return out


def _ts(s):
    return None if s is None else dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def _spark_and_duck(spark, lines, history, members, alts, txns):
    pos = pd.DataFrame(_pos_rows(lines), columns=S.POS_COLUMNS, dtype=object)
    hist = pd.DataFrame(_pos_rows(history), columns=S.POS_COLUMNS, dtype=object)
    mem = pd.DataFrame([(i, c, None, None, None) for i, c in dict(members).items()],
                       columns=S.MEMBER_SCHEMA.fieldNames())
    alt = pd.DataFrame(alts, columns=["memberid", "altid"], dtype=object)
    trows = [(None, t["memberid"], None, t["country"], t["ref"], _ts(t["date"]), None, t["store"], None,
              t["amount"], t["currency"], None, None, t["type"], None, None, None) for t in txns]
    txn = pd.DataFrame(trows, columns=S.LOYALTY_TXN_COLUMNS)

    sp = {
        "pos": spark.createDataFrame([tuple(r) for r in pos.itertuples(index=False)], S.POS_SCHEMA),
        "hist": spark.createDataFrame([tuple(r) for r in hist.itertuples(index=False)], S.POS_SCHEMA),
        "mem": spark.createDataFrame([tuple(r) for r in mem.itertuples(index=False)], S.MEMBER_SCHEMA),
        "alt": spark.createDataFrame([tuple(r) for r in alt.itertuples(index=False)], S.MEMBER_ALT_ID_SCHEMA),
        "txn": spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in trows],
                                     S.LOYALTY_TXN_SCHEMA),
    }
    con = duckdb.connect()
    con.register("pos_df", pos)
    con.register("hist_df", hist)
    con.register("mem_df", mem)
    con.register("alt_df", alt)
    con.register("txn_df", txn)
    cast_pos = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in S.POS_COLUMNS)
    con.execute(f"CREATE VIEW pos_lines AS SELECT {cast_pos} FROM pos_df")
    con.execute(f"CREATE VIEW pos_lines_history AS SELECT {cast_pos} FROM hist_df")
    con.execute("CREATE VIEW member AS SELECT CAST(id AS INTEGER) AS id, CAST(consumerid AS VARCHAR) AS consumerid "
                "FROM mem_df")
    con.execute("CREATE VIEW member_alt_id AS SELECT CAST(memberid AS INTEGER) AS memberid, "
                "CAST(altid AS VARCHAR) AS altid FROM alt_df")
    con.execute("CREATE VIEW loyalty_txn AS SELECT CAST(memberid AS INTEGER) AS memberid, "
                "CAST(country AS VARCHAR) AS country, CAST(referencenumber AS VARCHAR) AS referencenumber, "
                "CAST(date AS TIMESTAMP) AS date, CAST(store AS VARCHAR) AS store, "
                "CAST(monetaryamount AS REAL) AS monetaryamount, CAST(currency AS VARCHAR) AS currency, "
                "CAST(type AS VARCHAR) AS type FROM txn_df")
    return sp, con


@SETTINGS
@given(lines=st.lists(line_st, min_size=1, max_size=10), hist_idx=st.lists(st.integers(0, 9), max_size=3),
       members=member_st, alts=alt_st, txns=txn_st)
def test_reconcile_matches_literal_sql(spark, lines, hist_idx, members, alts, txns):
    history = [lines[i] for i in hist_idx if i < len(lines)]
    sp, con = _spark_and_duck(spark, lines, history, members, alts, txns)
    inp = ReconcileInputs(sp["pos"], sp["hist"], sp["mem"], sp["alt"], sp["txn"])
    for kind, sql in [(None, O.MISSED_ALL_SQL), ("SALE", O.missed_sql("SALE")), ("RETU", O.missed_sql("RETU"))]:
        got = missed_lines(inp, kind)
        cur = con.execute(sql)
        want_cols = [d[0] for d in cur.description]
        want = cur.fetchall()
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(want), (kind, rows, want)
        assert digest(got.columns, rows) == digest(want_cols, want), kind


prof_st = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]),
                             st.sampled_from(["A@x.com", "a@x.com", "b@x.com", None]),
                             st.sampled_from([0, 1]),
                             st.sampled_from([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), None])),
                   min_size=1, max_size=8)


@SETTINGS
@given(profiles=prof_st, web=st.lists(st.sampled_from(["A@X.COM", "b@x.com", "c@x.com"]), max_size=3))
def test_latest_profile_matches_window_sql(spark, profiles, web):
    rows = [(u, e, a, 0, t) for u, e, a, t in profiles]
    prof = spark.createDataFrame(rows, S.PROFILE_DIM_SCHEMA)
    users = spark.createDataFrame([(w,) for w in web], S.WEB_USER_SCHEMA)
    con = duckdb.connect()
    con.register("p_df", pd.DataFrame(rows, columns=S.PROFILE_DIM_SCHEMA.fieldNames()))
    con.register("w_df", pd.DataFrame([(w,) for w in web], columns=["p_uid"], dtype=object))
    con.execute("CREATE VIEW profile_dim AS SELECT CAST(uuid AS VARCHAR) AS uuid, CAST(email_address AS VARCHAR) "
                "AS email_address, CAST(active_flag AS INTEGER) AS active_flag, CAST(is_disabled AS INTEGER) "
                "AS is_disabled, CAST(last_update_ts AS TIMESTAMP) AS last_update_ts FROM p_df")
    con.execute("CREATE VIEW web_user AS SELECT CAST(p_uid AS VARCHAR) AS p_uid FROM w_df")
    got = P.latest_profile_per_email(prof, users)
    want = con.execute(O.LATEST_PROFILE_SQL).fetchall()
    assert sorted(map(tuple, got.select("uuid", "email").collect())) == sorted(want)


@SETTINGS
@given(members=st.lists(st.tuples(st.sampled_from(["K", None]), st.sampled_from(["A@x.com", "b@x.com", None])),
                        min_size=1, max_size=5),
       crm=st.lists(st.tuples(st.sampled_from(["P1", "P2", None]), st.sampled_from(["a@x.com", "b@x.com"])),
                    max_size=3, unique_by=lambda t: t[1]),
       web=st.lists(st.tuples(st.sampled_from(["W1", "W2"]), st.sampled_from(["a@x.com", "b@x.com"])),
                    max_size=3, unique_by=lambda t: t[1]))
def test_backfill_matches_two_step_update(spark, members, crm, web):
    mrows = [(i, c, e, dt.datetime(2024, 1, 1), "seed") for i, (c, e) in enumerate(members)]
    m = spark.createDataFrame(mrows, S.MEMBER_SCHEMA)
    src = [spark.createDataFrame(x, S.SOURCE_PROFILE_SCHEMA) for x in (crm, web)]
    got = backfill_ids(m, src, "2024-03-01 00:00:00")
    con = duckdb.connect()
    con.register("m_df", pd.DataFrame(mrows, columns=S.MEMBER_SCHEMA.fieldNames()))
    con.register("c_df", pd.DataFrame(crm, columns=["uuid", "email"], dtype=object))
    con.register("w_df", pd.DataFrame(web, columns=["uuid", "email"], dtype=object))
    member_sql = ("SELECT CAST(id AS INTEGER) AS id, CAST(consumerid AS VARCHAR) AS consumerid, "
                  "CAST(email AS VARCHAR) AS email, CAST(lastupdatedat AS TIMESTAMP) AS lastupdatedat, "
                  "CAST(lastupdatedby AS VARCHAR) AS lastupdatedby FROM m_df")
    src_sql = "SELECT CAST(uuid AS VARCHAR) AS uuid, CAST(email AS VARCHAR) AS email FROM {}"
    step1 = O.backfill_step_sql(member_sql, src_sql.format("c_df"), "2024-03-01 00:00:00", BACKFILL_BY)
    step2 = O.backfill_step_sql(step1, src_sql.format("w_df"), "2024-03-01 00:00:00", BACKFILL_BY)
    cur = con.execute(step2)
    want = cur.fetchall()
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest([d[0] for d in cur.description], want)
