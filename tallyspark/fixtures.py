"""Bindings of the driver's synthetic tables to the input layouts.

The source job has no sample data, so each input table is derived from the
driver's TPC-H-like tables by one select (see FIXTURES.md, part C).  Every
binding is a lazy DataFrame over the parquet files, so the work of every query
grows with the tables.  The DuckDB oracle holds the same bindings as SQL text
(``tallyspark.plans.oracle``); the two are written independently.
"""

from __future__ import annotations

import functools
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas as S

# Fixed values for the bindings (FIXTURES.md part C).
ZONE_BY_NATION_MOD10 = ["BEL", "CZE", "DEU", "ESP", "FRA", "GBR", "ITA", "NLD"]  # else USA
COUNTRY_BY_NATION_MOD8 = ["BE", "CZ", "DE", "ES", "FR", "GB", "IT"]  # else NL
POS_COUNTRY_BY_NATION_MOD4 = ["GBR", "BEL", "DEU", "FRA"]
SEED_MEMBER_TS = "2024-01-01 00:00:00"
SEED_MEMBER_BY = "seed"


_MEMO: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def memoized(fn):
    """Build each binding once per (session, folder): queries then share the
    analysed plan, as they would share a registered view.  Nothing is cached
    in memory; every action still reads the parquet files."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args):
        per_session = _MEMO.setdefault(spark, {})
        key = (fn.__name__, sf_dir.rstrip("/"), args)
        if key not in per_session:
            per_session[key] = fn(spark, sf_dir, *args)
        return per_session[key]
    return wrapper


@memoized
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(key: Column, values: list[str], otherwise: str | None) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, v) if expr is None else expr.when(key == i, v)
    return expr.otherwise(otherwise)


def _email(key) -> Column:
    return F.concat(F.lit("User"), _s(key), F.lit("@Example.com"))


# ---------------------------------------------------------------- POS lines
@memoized
def pos_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer, what POS lines are made of.  Orders meet their customers first, so the lines are shuffled once."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    return li.join(oc, li.l_orderkey == oc.o_orderkey)


def pos_layout(j: DataFrame) -> DataFrame:
    """Joined lines in the 42-column POS layout, plus the helper columns the views filter on (``_partkey``, ``_custkey``, ``_flag``,
    ``_orderdate``)."""
    kind = (F.when(F.col("l_returnflag") == "N", "SALE")
            .when(F.col("l_returnflag") == "R", "RETU").otherwise("VOID"))
    line_ref = F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"))
    values = {
        "hd_file_extract_date_time": F.when(F.col("l_partkey") % 50 != 0, F.concat(F.substring(_s("o_orderdate"), 1, 8), F.lit("01 00:00:00"))),
        "hd_order_or_tran_id": F.concat(kind, F.lit("#"), line_ref),
        "hd_order_date_time": _s("o_orderdate"),
        "hd_loyalty_id": (F.when(F.col("o_custkey") % 5 == 0, F.lit(None).cast("string"))
                          .when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("C"), _s("o_custkey")))
                          .otherwise(F.concat(F.lit("A"), _s("o_custkey")))),
        "hd_store_id": F.when(F.col("l_suppkey") % 10 != 0, F.concat(F.lit("S"), _s("l_suppkey"))),
        "hd_currency": F.when(F.col("c_nationkey") % 4 == 0, "GBP").otherwise("EUR"),
        "itm_sku": _s("l_partkey"),
        "itm_quantity": _s(F.col("l_quantity").cast("int")),
        "itm_amt_after_disc": _s(F.col("l_extendedprice").cast("decimal(12,2)")),
        "discount_code1": F.when(F.col("l_linestatus") == "F",
                                 F.concat(F.lit("D"), _s("l_linenumber"))),
        "country": _pick(F.col("c_nationkey") % 4, POS_COUNTRY_BY_NATION_MOD4, None),
        "hd_orig_tran_id": F.when(F.col("l_returnflag") != "N",
                                  F.concat(F.lit("SALE#"), line_ref)),
    }
    cols = [values.get(c, F.lit(None).cast("string")).alias(c) for c in S.POS_COLUMNS]
    return j.select(*cols,
                    F.col("l_partkey").alias("_partkey"),
                    F.col("o_custkey").alias("_custkey"),
                    F.col("l_returnflag").alias("_flag"),
                    F.col("o_orderdate").alias("_orderdate"))


@memoized
def pos_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos_layout(pos_join(spark, sf_dir))


@memoized
def pos_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's batch: every line, plus exact re-deliveries of some lines (made in one pass over the lines)."""
    return lines_of(pos_base(spark, sf_dir))


def copied(rows: DataFrame, part: str) -> DataFrame:
    """Rows with the number of their copy (``_copy``): those of every eleventh part come twice."""
    copies = F.when(F.col(part) % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", F.explode(copies).alias("_copy"))


def lines_of(base: DataFrame) -> DataFrame:
    return copied(base, "_partkey").select(*S.POS_COLUMNS)


@memoized
def pos_lines_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines already processed by earlier runs."""
    return history_of(pos_base(spark, sf_dir))


def history_of(base: DataFrame) -> DataFrame:
    return base.where(F.col("_partkey") % 7 == 0).select(*S.POS_COLUMNS)


# ---------------------------------------------------------------- members
@memoized
def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("id"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("C"), _s("c_custkey"))).alias("consumerid"),
        F.when(F.col("c_custkey") % 9 != 0, _email("c_custkey")).alias("email"),
        F.to_timestamp_ntz(F.lit(SEED_MEMBER_TS)).alias("lastupdatedat"),
        F.lit(SEED_MEMBER_BY).alias("lastupdatedby"))


@memoized
def member_alt_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")

    def branch(offset: int, prefix: str, cond: Column) -> DataFrame:
        return c.where(cond).select((k + offset).cast("int").alias("memberid"),
                                    F.concat(F.lit(prefix), _s(k)).alias("altid"))

    return (branch(0, "A", k % 4 != 3)
            .unionByName(branch(1, "C", k % 8 == 0))
            .unionByName(branch(2, "A", k % 12 == 1))
            .unionByName(branch(3, "C", k % 16 == 0)))


@memoized
def loyalty_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions the loyalty platform already holds (17-column layout, id unset)."""
    return txn_of(pos_base(spark, sf_dir))


def txn_of(base: DataFrame) -> DataFrame:
    flag = F.col("_flag")
    header = F.col("_partkey") % 3 == 0  # else the transaction names the original line; one pass makes both
    values = {
        "memberid": F.col("_custkey").cast("int"),
        "country": F.substring("country", 1, 2),
        "referencenumber": F.when(header, F.col("hd_order_or_tran_id")).otherwise(F.col("hd_orig_tran_id")),
        "date": F.col("_orderdate"),
        "store": F.col("hd_store_id"),
        "monetaryamount": F.col("itm_amt_after_disc").cast("float"),
        "currency": F.col("hd_currency"),
        "type": (F.when(header, F.when(flag == "N", "PURCHASE").when(flag == "R", "RETURN").otherwise("VOID_PURCHASE"))
                 .otherwise(F.when(flag == "R", "RETURN").otherwise("VOID_RETURN"))),
    }
    return (base.where(header | ((flag != "N") & (F.col("_partkey") % 3 == 1)))
            .select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in S.LOYALTY_TXN_SCHEMA.fields]))


# ---------------------------------------------------------------- profiles
@memoized
def profile_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    main = e.select(
        F.concat(F.lit("U"), _s(F.expr("event_id div 10 + event_id % 3"))).alias("uuid"),
        F.when(F.col("event_id") % 13 != 0,
               _email(F.expr("event_id div 8 + event_id % 2"))).alias("email_address"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).cast("int").alias("active_flag"),
        F.when(F.col("event_type") == "signup", 1).otherwise(0).cast("int").alias("is_disabled"),
        F.col("ts").alias("last_update_ts"))
    twice = e.where(F.col("event_id") % 250 == 7)

    def pair(suffix: str, active: int) -> DataFrame:
        return twice.select(
            F.concat(F.lit("X"), _s("event_id")).alias("uuid"),
            F.concat(F.lit("x"), _s("event_id"), F.lit(suffix)).alias("email_address"),
            F.lit(active).cast("int").alias("active_flag"),
            F.lit(0).cast("int").alias("is_disabled"),
            F.col("ts").alias("last_update_ts"))

    return main.unionByName(pair("a@example.com", 1)).unionByName(pair("b@example.com", 0))


@memoized
def web_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 3 != 1).select(
        F.concat(F.lit("USER"), _s("c_custkey"), F.lit("@EXAMPLE.COM")).alias("p_uid"))


@memoized
def crm_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(_email("c_custkey").alias("email"),
                    _pick(F.col("c_nationkey") % 10, ZONE_BY_NATION_MOD10, "USA").alias("loyaltyzonecode"))


def _source_profile(spark, sf_dir, prefix: str, cond) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(cond(F.col("c_custkey"))).select(
        F.concat(F.lit(prefix), _s("c_custkey")).alias("uuid"),
        F.lower(_email("c_custkey")).alias("email"))


@memoized
def crm_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source_profile(spark, sf_dir, "P", lambda k: k % 2 == 0)


@memoized
def web_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source_profile(spark, sf_dir, "W", lambda k: (k % 5 == 0) | (k % 4 == 0))


# ---------------------------------------------------------------- CRM migration
@memoized
def crm_account_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    values = {
        "altid": F.concat(F.lit("A"), _s("o_custkey")),
        "country": F.lit("BE"),
        "accounttransactionid": _s("o_orderkey"),
        "rulesourceactionloyaltyzonecode": F.col("o_orderpriority"),
        "accounttransactiondate": F.col("o_orderdate"),
        "accounttransactionvaluevalidityenddate": _s("o_orderdate"),
        "accounttransactionvalue": F.floor(F.col("o_totalprice") / 1000).cast("int"),
        "createddate": F.col("o_orderdate"),
        "updateddate": F.col("o_orderdate"),
    }
    return o.select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                      for f in S.ACCOUNT_TXN_SCHEMA.fields])


@memoized
def crm_contact_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    values = {
        "email": _email("c_custkey"),
        "altid": F.concat(F.lit("A"), _s("c_custkey")),
        "country": _pick(F.col("c_nationkey") % 8, COUNTRY_BY_NATION_MOD8, "NL"),
        "totalpoints": F.floor(F.col("c_acctbal")).cast("int"),
        "segmentcode": F.col("c_mktsegment"),
    }
    return c.select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                      for f in S.CONTACT_STAGE_SCHEMA.fields])


FIXTURES = {
    "pos_lines": pos_lines,
    "pos_lines_history": pos_lines_history,
    "member": member,
    "member_alt_id": member_alt_id,
    "loyalty_txn": loyalty_txn,
    "profile_dim": profile_dim,
    "web_user": web_user,
    "crm_contact": crm_contact,
    "crm_profile": crm_profile,
    "web_profile": web_profile,
    "crm_account_txn": crm_account_txn,
    "crm_contact_stage": crm_contact_stage,
}
