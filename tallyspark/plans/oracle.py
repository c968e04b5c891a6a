"""Oracle SQL for the DuckDB correctness check.

The input bindings are repeated here as SQL text (FIXTURES.md part C), written
independently of the DataFrame bindings in ``tallyspark.fixtures``.  Where it can
a statement takes another way than the Spark plan (``EXCEPT``, ``NOT EXISTS``,
members repeated by a count instead of an outer join, updates in two steps), so
that an error of the plan does not pass by being made twice.
"""

from __future__ import annotations

import re

from tallyspark import schemas as S
from tallyspark.fixtures import SEED_MEMBER_BY, SEED_MEMBER_TS


def _s(x: str) -> str:
    return f"cast({x} as varchar)"


def _email(k: str) -> str:
    return f"concat('User', {_s(k)}, '@Example.com')"


_POS_VALUES = {
    "hd_file_extract_date_time": f"case when l_partkey % 50 <> 0 then concat(substring({_s('o_orderdate')}, 1, 8), '01 00:00:00') end",
    "hd_order_or_tran_id": ("concat(case l_returnflag when 'N' then 'SALE' when 'R' then 'RETU' "
                            f"else 'VOID' end, '#', {_s('l_orderkey')}, '-', {_s('l_linenumber')})"),
    "hd_order_date_time": _s("o_orderdate"),
    "hd_loyalty_id": (f"case when o_custkey % 5 = 0 then null when o_custkey % 2 = 0 "
                      f"then concat('C', {_s('o_custkey')}) else concat('A', {_s('o_custkey')}) end"),
    "hd_store_id": f"case when l_suppkey % 10 = 0 then null else concat('S', {_s('l_suppkey')}) end",
    "hd_currency": "case when c_nationkey % 4 = 0 then 'GBP' else 'EUR' end",
    "itm_sku": _s("l_partkey"),
    "itm_quantity": _s("cast(l_quantity as integer)"),
    "itm_amt_after_disc": _s("cast(l_extendedprice as decimal(12,2))"),
    "discount_code1": f"case when l_linestatus = 'F' then concat('D', {_s('l_linenumber')}) end",
    "country": "case c_nationkey % 4 when 0 then 'GBR' when 1 then 'BEL' when 2 then 'DEU' else 'FRA' end",
    "hd_orig_tran_id": (f"case when l_returnflag <> 'N' then concat('SALE#', {_s('l_orderkey')}, '-', "
                        f"{_s('l_linenumber')}) end"),
}
_POS_SELECT = ",\n    ".join(f"{_POS_VALUES.get(c, 'cast(null as varchar)')} AS {c}" for c in S.POS_COLUMNS)
POS_COLS = ", ".join(S.POS_COLUMNS)

FIXTURE_SQL: dict[str, str] = {
    "pos_base": f"""
  SELECT {_POS_SELECT},
    l_partkey AS p_partkey_, o_custkey AS p_custkey_, l_returnflag AS p_flag_, o_orderdate AS p_orderdate_
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "pos_lines": f"""
  SELECT {POS_COLS} FROM pos_base
  UNION ALL
  SELECT {POS_COLS} FROM pos_base WHERE p_partkey_ % 11 = 0""",
    "pos_lines_history": f"SELECT {POS_COLS} FROM pos_base WHERE p_partkey_ % 7 = 0",
    "member": f"""
  SELECT cast(c_custkey as integer) AS id,
         case when c_custkey % 3 <> 0 then concat('C', {_s('c_custkey')}) end AS consumerid,
         case when c_custkey % 9 <> 0 then {_email('c_custkey')} end AS email,
         TIMESTAMP '{SEED_MEMBER_TS}' AS lastupdatedat,
         '{SEED_MEMBER_BY}' AS lastupdatedby
  FROM customer""",
    "member_alt_id": f"""
  SELECT cast(c_custkey as integer) AS memberid, concat('A', {_s('c_custkey')}) AS altid
    FROM customer WHERE c_custkey % 4 <> 3
  UNION ALL SELECT cast(c_custkey + 1 as integer), concat('C', {_s('c_custkey')})
    FROM customer WHERE c_custkey % 8 = 0
  UNION ALL SELECT cast(c_custkey + 2 as integer), concat('A', {_s('c_custkey')})
    FROM customer WHERE c_custkey % 12 = 1
  UNION ALL SELECT cast(c_custkey + 3 as integer), concat('C', {_s('c_custkey')})
    FROM customer WHERE c_custkey % 16 = 0""",
    "loyalty_txn": """
  SELECT cast(null as bigint) AS id, cast(p_custkey_ as integer) AS memberid,
         cast(null as integer) AS benefitid, substring(country, 1, 2) AS country,
         hd_order_or_tran_id AS referencenumber, p_orderdate_ AS date,
         cast(null as varchar) AS channel, hd_store_id AS store, cast(null as varchar) AS associate,
         cast(itm_amt_after_disc as real) AS monetaryamount, hd_currency AS currency,
         cast(null as integer) AS points, cast(null as varchar) AS expirydate,
         case p_flag_ when 'N' then 'PURCHASE' when 'R' then 'RETURN' else 'VOID_PURCHASE' end AS type,
         cast(null as timestamp) AS createdat, cast(null as timestamp) AS lastupdatedat,
         cast(null as varchar) AS lastupdatedby
  FROM pos_base WHERE p_partkey_ % 3 = 0
  UNION ALL
  SELECT null, cast(p_custkey_ as integer), null, substring(country, 1, 2),
         hd_orig_tran_id, p_orderdate_, null, hd_store_id, null,
         cast(itm_amt_after_disc as real), hd_currency, null, null,
         case p_flag_ when 'R' then 'RETURN' else 'VOID_RETURN' end, null, null, null
  FROM pos_base WHERE p_flag_ <> 'N' AND p_partkey_ % 3 = 1""",
    "profile_dim": f"""
  SELECT concat('U', {_s('event_id // 10 + event_id % 3')}) AS uuid,
         case when event_id % 13 <> 0 then {_email('event_id // 8 + event_id % 2')} end AS email_address,
         case when event_type = 'error' then 0 else 1 end AS active_flag,
         case when event_type = 'signup' then 1 else 0 end AS is_disabled,
         ts AS last_update_ts
  FROM events
  UNION ALL
  SELECT concat('X', {_s('event_id')}), concat('x', {_s('event_id')}, 'a@example.com'), 1, 0, ts
  FROM events WHERE event_id % 250 = 7
  UNION ALL
  SELECT concat('X', {_s('event_id')}), concat('x', {_s('event_id')}, 'b@example.com'), 0, 0, ts
  FROM events WHERE event_id % 250 = 7""",
    "web_user": f"SELECT concat('USER', {_s('c_custkey')}, '@EXAMPLE.COM') AS p_uid FROM customer WHERE c_custkey % 3 <> 1",
    "crm_contact": f"""
  SELECT {_email('c_custkey')} AS email,
         case c_nationkey % 10 when 0 then 'BEL' when 1 then 'CZE' when 2 then 'DEU' when 3 then 'ESP'
              when 4 then 'FRA' when 5 then 'GBR' when 6 then 'ITA' when 7 then 'NLD' else 'USA' end
           AS loyaltyzonecode
  FROM customer""",
    "crm_profile": f"SELECT concat('P', {_s('c_custkey')}) AS uuid, lower({_email('c_custkey')}) AS email FROM customer WHERE c_custkey % 2 = 0",
    "web_profile": (f"SELECT concat('W', {_s('c_custkey')}) AS uuid, lower({_email('c_custkey')}) AS email "
                    "FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 4 = 0"),
    "crm_account_txn": f"""
  SELECT cast(null as varchar) AS email, concat('A', {_s('o_custkey')}) AS altid, 'BE' AS country,
         {_s('o_orderkey')} AS accounttransactionid, o_orderpriority AS rulesourceactionloyaltyzonecode,
         o_orderdate AS accounttransactiondate,
         cast(null as varchar) AS accounttransactionvaluevaliditystartdate,
         {_s('o_orderdate')} AS accounttransactionvaluevalidityenddate,
         cast(floor(o_totalprice / 1000) as integer) AS accounttransactionvalue,
         cast(null as varchar) AS accounttransactionvalueavailability,
         cast(null as varchar) AS isdeleted, cast(null as timestamp) AS deleteddate,
         o_orderdate AS createddate, o_orderdate AS updateddate,
         cast(null as varchar) AS segmentcode, cast(null as varchar) AS lastupdatedby
  FROM orders""",
    "crm_contact_stage": f"""
  SELECT {_email('c_custkey')} AS email, concat('A', {_s('c_custkey')}) AS altid,
         cast(null as varchar) AS idtype,
         case c_nationkey % 8 when 0 then 'BE' when 1 then 'CZ' when 2 then 'DE' when 3 then 'ES'
              when 4 then 'FR' when 5 then 'GB' when 6 then 'IT' else 'NL' end AS country,
         cast(null as varchar) AS preferredlanguage, cast(null as varchar) AS firstname,
         cast(null as varchar) AS lastname, cast(null as varchar) AS birthday,
         cast(null as timestamp) AS joindate, cast(floor(c_acctbal) as integer) AS totalpoints,
         cast(null as varchar) AS gender, c_mktsegment AS segmentcode,
         cast(null as varchar) AS lastupdatedby
  FROM customer""",
}

_DEPS = {"pos_lines": ["pos_base"], "pos_lines_history": ["pos_base"], "loyalty_txn": ["pos_base"]}


def with_fixtures(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it (and ``extra_ctes``) mention."""
    extra_ctes = extra_ctes or []
    text = body + " ".join(sql for _, sql in extra_ctes)
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPS.get(name, []):
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in FIXTURE_SQL:
        if name != "pos_base" and re.search(rf"\b{name}\b", text):
            add(name)
    ctes = [f"{n} AS MATERIALIZED ({FIXTURE_SQL[n]}\n)" for n in needed]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in extra_ctes]
    if not ctes:
        return body
    if body.lstrip().startswith("WITH "):
        body = f"SELECT * FROM (\n{body}\n) q"
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ----------------------------------------------------------------------------
# Reconciliation: a chain of steps, one resolve step for every kind
# ----------------------------------------------------------------------------
TS = "'%Y-%m-%d %H:%M:%S'"
KINDS = ("SALE", "RETU", "VOID")
#: transaction types that settle a line through its original transaction (fixed values)
SETTLING = {"RETU": ("RETURN",), "VOID": ("VOID_PURCHASE", "VOID_RETURN")}
_DISCOUNTS = [f"discount_code{i}" for i in range(1, 11)]
MISSED_FIELDS = ["extract_ts", "tran_id", "tran_ts", "loyalty_id", "country", "store_id", "currency", "itm_sku", "itm_quantity", "itm_amount",
                 *_DISCOUNTS, "orig_tran_id"]
MISSED_SELECT = ", ".join(f"p.{c}" for c in MISSED_FIELDS)

#: candidate columns as expressions of a POS line ``x``
CANDIDATE_FIELDS = ",\n       ".join([
    f"strptime(x.hd_file_extract_date_time, {TS}) AS extract_ts", "x.hd_order_or_tran_id AS tran_id",
    f"strptime(x.hd_order_date_time, {TS}) AS tran_ts", "x.hd_loyalty_id AS loyalty_id", "substring(x.country, 1, 2) AS country",
    "x.hd_store_id AS store_id", "x.hd_currency AS currency", "x.itm_sku AS itm_sku", "x.itm_quantity AS itm_quantity",
    "x.itm_amt_after_disc AS itm_amount", *[f"x.{c}" for c in _DISCOUNTS], "x.hd_orig_tran_id AS orig_tran_id"])


def _steps(kinds: tuple[str, ...]) -> str:
    """fresh: lines that history lacks; direct: members by loyalty id, as often as alternate rows name that id, once at least;
    owner: these, and alternate rows of the ids that no member has; candidate: fresh lines of the kinds that have an owner."""
    wanted = ", ".join(f"'{k}'" for k in kinds)
    return f"""fresh AS (
  SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history
), named AS (
  SELECT altid, count(*) AS times FROM member_alt_id GROUP BY altid
), direct AS (
  SELECT consumerid AS loyalty, id AS memberid, unnest(range(greatest(1, coalesce(times, 0)))) AS copy
    FROM member LEFT JOIN named ON altid = consumerid WHERE consumerid IS NOT NULL
), owner AS (
  SELECT loyalty, memberid FROM direct
  UNION ALL
  SELECT altid, memberid FROM member_alt_id WHERE memberid IS NOT NULL AND altid NOT IN (SELECT loyalty FROM direct)
), candidate AS (
  SELECT split_part(x.hd_order_or_tran_id, '#', 1) AS kind, owner.memberid AS memberid,
       {CANDIDATE_FIELDS}
    FROM owner JOIN fresh x ON x.hd_loyalty_id = owner.loyalty
   WHERE owner.memberid IS NOT NULL AND split_part(x.hd_order_or_tran_id, '#', 1) IN ({wanted})
)"""


def candidate_sql(kind: str | None) -> str:
    """Fresh lines with the member that they belong to."""
    return f"WITH {_steps((kind,) if kind else KINDS)}\nSELECT * FROM candidate"


def _missed(kinds: tuple[str, ...]) -> str:
    """Candidates that no booked transaction accounts for, neither one with the same header (of a purchase, for a
    sale) nor one that refers to the line's original transaction."""
    header = " AND ".join(f"booked.{t} = p.{c}" for t, c in (("memberid", "memberid"), ("date", "tran_ts"), ("country", "country"), ("store", "store_id"),
                                                            ("currency", "currency"), ("referencenumber", "tran_id")))
    by_origin = "\n".join(
        f"""   AND NOT EXISTS (SELECT 1 FROM loyalty_txn settled
                    WHERE p.kind = '{k}' AND settled.memberid = p.memberid AND settled.referencenumber = p.orig_tran_id
                      AND settled.type IN ({", ".join(f"'{t}'" for t in SETTLING[k])}))""" for k in kinds if k in SETTLING)
    return f"""WITH {_steps(kinds)}
SELECT {MISSED_SELECT}
  FROM candidate p
 WHERE NOT EXISTS (SELECT 1 FROM loyalty_txn booked
                    WHERE {header} AND booked.monetaryamount = CAST(p.itm_amount AS REAL)
                      AND (p.kind <> 'SALE' OR booked.type = 'PURCHASE'))
{by_origin}"""


def missed_sql(kind: str) -> str:
    return _missed((kind,))


MISSED_ALL_SQL = _missed(KINDS)


# ----------------------------------------------------------------------------
# Profiles, back-fill, migration
# ----------------------------------------------------------------------------
ZONES_SQL = "('BEL', 'CZE', 'DEU', 'ESP', 'FRA', 'GBR', 'ITA', 'NLD')"
IN_ZONE_WHERE = (f"active_flag = 1 AND email_address IN "
                 f"(SELECT email FROM crm_contact WHERE loyaltyzonecode IN {ZONES_SQL})")

def latest_profile_sql(users: str, column: str) -> str:
    """Of each e-mail that a user has, the active profile that changed last; undated ones come last, ties go to the larger uuid."""
    return f"""SELECT arg_max(struct_pack(u := p.uuid), struct_pack(dated := p.last_update_ts IS NOT NULL, at := coalesce(p.last_update_ts, TIMESTAMP '1000-01-01'), u := p.uuid)).u AS uuid,
       lower(p.email_address) AS email
  FROM profile_dim p
 WHERE p.active_flag = 1 AND EXISTS (SELECT 1 FROM {users} w WHERE lower(w.{column}) = lower(p.email_address))
 GROUP BY lower(p.email_address)"""


LATEST_PROFILE_SQL = latest_profile_sql("web_user", "p_uid")
LATEST_CRM_PROFILE_SQL = latest_profile_sql("crm_contact", "email")


def backfill_step_sql(member_sql: str, source_sql: str, run_ts: str, by: str) -> str:
    """One ``UPDATE member SET consumerid = s.uuid, audit … FROM source s WHERE
    lower(member.email) = s.email AND consumerid IS NULL`` as a SELECT."""
    hit = "m.consumerid IS NULL AND s.email IS NOT NULL"
    return f"""SELECT m.id,
       CASE WHEN {hit} THEN s.uuid ELSE m.consumerid END AS consumerid,
       m.email,
       CASE WHEN {hit} THEN TIMESTAMP '{run_ts}' ELSE m.lastupdatedat END AS lastupdatedat,
       CASE WHEN {hit} THEN '{by}' ELSE m.lastupdatedby END AS lastupdatedby
  FROM ({member_sql}) m LEFT JOIN ({source_sql}) s ON lower(m.email) = s.email"""


def account_txn_sql(run_ts: str, first: str = "") -> str:
    """Migrated rows, numbered by ``first`` (an ORDER BY prefix) and then by reference number and member."""
    empty = {"benefitid": "INTEGER", "channel": "VARCHAR", "store": "VARCHAR", "associate": "VARCHAR", "monetaryamount": "REAL", "currency": "VARCHAR"}
    taken = {"memberid": "owner.memberid", "country": "txn.country", "referencenumber": "txn.accounttransactionid", "date": "txn.accounttransactiondate",
             "points": "txn.accounttransactionvalue", "expirydate": "txn.accounttransactionvaluevalidityenddate", "type": "txn.rulesourceactionloyaltyzonecode",
             "createdat": "txn.createddate", "lastupdatedat": "txn.updateddate", "lastupdatedby": "txn.lastupdatedby"}
    columns = ", ".join([*(f"{v} AS {k}" for k, v in taken.items()), *(f"CAST(NULL AS {v}) AS {k}" for k, v in empty.items())])
    return f"""WITH moved AS (
  SELECT {columns} FROM member_alt_id owner JOIN crm_account_txn txn USING (altid)
)
SELECT CAST(1000 + row_number() OVER (ORDER BY {first}referencenumber NULLS FIRST, memberid NULLS FIRST) AS BIGINT) AS id, * FROM moved"""


def contact_target_sql(run_ts: str, source: str = "crm_contact_stage") -> str:
    return f"""SELECT email, CAST(NULL AS VARCHAR) AS consumerid, CAST(NULL AS VARCHAR) AS shopid, altid, idtype,
       country, preferredlanguage, firstname, lastname, birthday, joindate,
       CAST(NULL AS TIMESTAMP) AS subscribedate, CAST(NULL AS VARCHAR) AS status, totalpoints, gender,
       segmentcode, false AS crmid_reused, TIMESTAMP '{run_ts}' AS createdat,
       TIMESTAMP '{run_ts}' AS lastupdatedat, lastupdatedby
  FROM {source}"""


RUNNING_COUNT_SQL = """SELECT country, n_rows,
       CAST(sum(n_rows) OVER (ORDER BY country ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_rows
  FROM (SELECT country, count(*) AS n_rows FROM crm_contact_stage GROUP BY country) c"""


# ----------------------------------------------------------------------------
# Row JSON (export format: NULL fields kept, timestamps ISO with 'T')
# ----------------------------------------------------------------------------
def row_json_sql(source: str) -> str:
    fields = []
    for c in S.MISSED_COLUMNS:
        if c in ("extract_ts", "tran_ts"):
            fields.append(f"{c} := strftime({c}, '%Y-%m-%dT%H:%M:%S')")
        else:
            fields.append(f"{c} := {c}")
    return f"SELECT CAST(to_json(struct_pack({', '.join(fields)})) AS VARCHAR) AS row_json FROM ({source}) m"


def conflicts_sql(source: str) -> str:
    return f"""SELECT 'email_active_ids' AS conflict, email_address AS key, count(DISTINCT uuid) AS n
  FROM {source} WHERE email_address IS NOT NULL AND active_flag = 1
 GROUP BY email_address HAVING count(DISTINCT uuid) > 1
UNION ALL
SELECT 'id_one_active_email', uuid, count(DISTINCT email_address)
  FROM {source} GROUP BY uuid
HAVING count(DISTINCT email_address) > 1
   AND count(DISTINCT CASE WHEN active_flag = 1 THEN email_address END) = 1"""


def job_summary_sql(threshold: int) -> str:
    return f"""SELECT i.imported, n.new_lines, m.missed, m.missed < {threshold} AS passed,
       CASE WHEN m.missed < {threshold} THEN m.missed ELSE 0 END AS exported,
       CASE WHEN m.missed < {threshold} THEN n.new_lines ELSE 0 END AS archived
  FROM (SELECT count(*) AS imported FROM pos_lines) i,
       (SELECT count(*) AS new_lines FROM (SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history) x) n,
       (SELECT count(*) AS missed FROM ({MISSED_ALL_SQL}) a) m"""
