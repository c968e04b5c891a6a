"""Named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the matching
DuckDB oracle text ``ORACLE[name]``.

Each query binds the driver's tables to the input layouts (``fixtures``) and
runs one operator or job over the whole tables.  Column names match the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import fixtures as FX
from tallyspark import schemas as S
from tallyspark.files import Files
from tallyspark.functions import amount_real, country_prefix, parse_pos_ts, row_json, run_stamp, tran_kind
from tallyspark.operators.delta import archived_history
from tallyspark.operators.reconcile import candidate_layout, with_kind
from tallyspark.operators.resolve import resolve_stored, stage_lines, store_lookup
from tallyspark.plans import backfill_job as BF
from tallyspark.plans import oracle as O
from tallyspark.plans import reconcile as R
from tallyspark.session import shuffles_removed, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = O.with_fixtures(oracle)
        return fn
    return deco


def _inputs(spark, d) -> R.ReconcileInputs:
    return R.ReconcileInputs.from_fixtures(spark, d)


# ------------------------------------------------------------------ set ops
@register("setop_new_lines", "SELECT DISTINCT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history")
def q_setop_new_lines(spark, d):
    return R.new_batch_lines(_inputs(spark, d))


@register("setop_archive_history",
          "SELECT * FROM pos_lines_history UNION ALL "
          "(SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history)")
def q_setop_archive_history(spark, d):
    return archived_history(FX.pos_lines(spark, d), FX.pos_lines_history(spark, d))


@register("distinct_pos_lines", "SELECT DISTINCT * FROM pos_lines")
def q_distinct_pos_lines(spark, d):
    return FX.pos_lines(spark, d).distinct()


@register("agg_count", "SELECT count(*) AS n_rows FROM pos_lines")
def q_agg_count(spark, d):
    return FX.pos_lines(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ projections / functions
@register("proj_pos_candidate",
          f"SELECT {O.CANDIDATE_FIELDS} FROM (SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history) x")
def q_proj_pos_candidate(spark, d):
    return candidate_layout(R.new_batch_lines(_inputs(spark, d)))


@register("filter_tran_kind",
          "SELECT * FROM pos_lines WHERE split_part(hd_order_or_tran_id, '#', 1) = 'VOID'")
def q_filter_tran_kind(spark, d):
    return FX.pos_lines(spark, d).where(tran_kind("hd_order_or_tran_id") == "VOID")


@register("fn_parse_timestamp",
          f"SELECT hd_order_or_tran_id, strptime(hd_order_date_time, {O.TS}) AS tran_ts, "
          f"strptime(hd_file_extract_date_time, {O.TS}) AS extract_ts FROM pos_lines")
def q_fn_parse_timestamp(spark, d):
    return FX.pos_lines(spark, d).select(
        "hd_order_or_tran_id", parse_pos_ts("hd_order_date_time").alias("tran_ts"),
        parse_pos_ts("hd_file_extract_date_time").alias("extract_ts"))


@register("fn_country_prefix",
          "SELECT country AS country3, substring(country, 1, 2) AS country FROM pos_lines")
def q_fn_country_prefix(spark, d):
    return FX.pos_lines(spark, d).select(F.col("country").alias("country3"),
                                         country_prefix("country").alias("country"))


@register("fn_amount_real",
          "SELECT itm_amt_after_disc, CAST(itm_amt_after_disc AS REAL) AS amount FROM pos_lines")
def q_fn_amount_real(spark, d):
    return FX.pos_lines(spark, d).select("itm_amt_after_disc",
                                         amount_real("itm_amt_after_disc").alias("amount"))


@register("fn_run_stamp", "SELECT DISTINCT o_orderdate, strftime(o_orderdate, '%Y%m%d_%H%M') AS stamp FROM orders")
def q_fn_run_stamp(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderdate", run_stamp("o_orderdate").alias("stamp")).distinct()


# ------------------------------------------------------------------ member resolution, reconciliation
@register("join_resolve_member",
          "SELECT p.memberid, " + O.MISSED_SELECT + " FROM (" + O.candidate_sql(None) + ") p")
def q_join_resolve_member(spark, d):
    return R.candidates(_inputs(spark, d)).drop("kind")


@register("join_resolve_bucketed", "SELECT p.memberid, " + O.MISSED_SELECT + " FROM (" + O.candidate_sql(None) + ") p")
def q_join_resolve_bucketed(spark, d):
    """New lines and the stored lookup in the same buckets, joined without a shuffle."""
    run = work_dir(spark, "lookup")
    lookup, lines = (f"{n}_{run.rsplit('-', 1)[1]}" for n in ("lookup", "lines"))
    store_lookup(FX.member(spark, d), FX.member_alt_id(spark, d), lookup, f"{run}/lookup", 16)
    stage_lines(with_kind(R.new_batch_lines(_inputs(spark, d)), ["SALE", "RETU", "VOID"]), lines, f"{run}/lines", 16)
    return candidate_layout(resolve_stored(spark.table(lines), spark.table(lookup)), keep=("memberid",))


@register("missed_sale", O.missed_sql("SALE"))
def q_missed_sale(spark, d):
    return R.missed_lines(_inputs(spark, d), "SALE")


@register("missed_return", O.missed_sql("RETU"))
def q_missed_return(spark, d):
    return R.missed_lines(_inputs(spark, d), "RETU")


@register("missed_void", O.missed_sql("VOID"))
def q_missed_void(spark, d):
    return R.missed_lines(_inputs(spark, d), "VOID")


@register("missed_all", O.MISSED_ALL_SQL)
def q_missed_all(spark, d):
    return R.missed_lines(_inputs(spark, d))


@register("agg_missed_by_kind",
          "SELECT split_part(tran_id, '#', 1) AS kind, count(*) AS n_rows FROM ("
          + O.MISSED_ALL_SQL + ") m GROUP BY 1")
def q_agg_missed_by_kind(spark, d):
    return R.missed_by_kind(R.missed_lines(_inputs(spark, d)))


@register("gate_missed_threshold",
          f"SELECT missed, CAST({R.DEFAULT_THRESHOLD} AS BIGINT) AS threshold, "
          f"missed < {R.DEFAULT_THRESHOLD} AS passed, missed > 0 AS non_empty "
          "FROM (SELECT count(*) AS missed FROM (" + O.MISSED_ALL_SQL + ") m) c")
def q_gate_missed_threshold(spark, d):
    return R.gate(R.missed_lines(_inputs(spark, d)), R.DEFAULT_THRESHOLD)


# ------------------------------------------------------------------ profiles
from tallyspark.operators import profiles as P  # noqa: E402
from tallyspark.operators import quality as C  # noqa: E402
from tallyspark.operators.backfill import BACKFILL_BY, backfill_ids  # noqa: E402
from tallyspark.operators import migrate as M  # noqa: E402
from tallyspark.operators.keys import assign_sequential_ids  # noqa: E402

# Fixed value for the fixtures: the run time standing in for NOW().
RUN_TS = "2024-03-01 00:00:00"
PROFILE_COLS = "uuid, email_address, active_flag, is_disabled, last_update_ts"


@register("semi_profile_in_zone", f"SELECT * FROM profile_dim WHERE {O.IN_ZONE_WHERE}")
def q_semi_profile_in_zone(spark, d):
    return P.profiles_in_zones(FX.profile_dim(spark, d), FX.crm_contact(spark, d))


@register("agg_count_distinct",
          f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT uuid) AS n_distinct_uuid FROM profile_dim WHERE {O.IN_ZONE_WHERE}")
def q_agg_count_distinct(spark, d):
    return P.count_and_distinct(q_semi_profile_in_zone(spark, d), "uuid")


@register("agg_multi_distinct",
          "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT uuid) AS n_distinct_uuid, "
          "COUNT(DISTINCT email_address) AS n_distinct_email_address FROM profile_dim WHERE active_flag = 1")
def q_agg_multi_distinct(spark, d):
    return P.count_and_distinct(P.active(FX.profile_dim(spark, d)), "uuid", "email_address")


@register("filter_zone_in", f"SELECT * FROM crm_contact WHERE loyaltyzonecode IN {O.ZONES_SQL}")
def q_filter_zone_in(spark, d):
    return P.contacts_in_zones(FX.crm_contact(spark, d))


@register("having_rows_per_id",
          "SELECT uuid, COUNT(email_address) AS n_emails FROM profile_dim GROUP BY uuid HAVING COUNT(email_address) > 1")
def q_having_rows_per_id(spark, d):
    return P.having_count(FX.profile_dim(spark, d), "uuid", "email_address", out="n_emails")


@register("having_emails_per_id",
          "SELECT uuid, COUNT(DISTINCT email_address) AS dcnt FROM profile_dim GROUP BY uuid HAVING dcnt > 1")
def q_having_emails_per_id(spark, d):
    return P.having_count(FX.profile_dim(spark, d), "uuid", "email_address", distinct=True, out="dcnt")


@register("having_ids_per_email",
          "SELECT email_address, COUNT(DISTINCT uuid) AS dcnt FROM profile_dim GROUP BY email_address HAVING dcnt > 1")
def q_having_ids_per_email(spark, d):
    return P.having_count(FX.profile_dim(spark, d), "email_address", "uuid", distinct=True, out="dcnt")


@register("limit_grouped",
          "SELECT uuid, COUNT(email_address) AS n_emails FROM profile_dim GROUP BY uuid "
          "HAVING COUNT(email_address) > 1 ORDER BY uuid LIMIT 100")
def q_limit_grouped(spark, d):
    return q_having_rows_per_id(spark, d).orderBy("uuid").limit(100)


@register("scan_limit",
          "SELECT * FROM profile_dim ORDER BY uuid NULLS FIRST, email_address NULLS FIRST, "
          "active_flag NULLS FIRST, is_disabled NULLS FIRST, last_update_ts NULLS FIRST LIMIT 100")
def q_scan_limit(spark, d):
    p = FX.profile_dim(spark, d)
    return p.orderBy(*[F.col(c).asc_nulls_first() for c in p.columns]).limit(100)


@register("filter_profile_by_email",
          "SELECT uuid, email_address, is_disabled, active_flag FROM profile_dim WHERE email_address = 'User7@Example.com'")
def q_filter_profile_by_email(spark, d):
    return (FX.profile_dim(spark, d).where(F.col("email_address") == "User7@Example.com")
            .select("uuid", "email_address", "is_disabled", "active_flag"))


@register("filter_profile_by_uuid",
          "SELECT uuid, email_address, is_disabled, active_flag FROM profile_dim WHERE uuid = 'X7'")
def q_filter_profile_by_uuid(spark, d):
    return (FX.profile_dim(spark, d).where(F.col("uuid") == "X7")
            .select("uuid", "email_address", "is_disabled", "active_flag"))


@register("join_case_insensitive",
          f"SELECT {PROFILE_COLS}, p_uid FROM (SELECT * FROM profile_dim WHERE active_flag = 1) a "
          "JOIN web_user ON lower(email_address) = lower(p_uid)")
def q_join_case_insensitive(spark, d):
    return P.match_case_insensitive(P.active(FX.profile_dim(spark, d)), FX.web_user(spark, d),
                                    "email_address", "p_uid")


@register("window_latest_profile", O.LATEST_PROFILE_SQL)
def q_window_latest_profile(spark, d):
    return P.latest_profile_per_email(FX.profile_dim(spark, d), FX.web_user(spark, d))


@register("check_identity_conflicts", O.conflicts_sql("profile_dim"))
def q_check_identity_conflicts(spark, d):
    return P.identity_conflicts(FX.profile_dim(spark, d))


# ------------------------------------------------------------------ quality checks
@register("check_unique",
          "SELECT email_address AS value, count(*) AS n FROM profile_dim WHERE email_address IS NOT NULL "
          "GROUP BY email_address HAVING count(*) > 1")
def q_check_unique(spark, d):
    return C.unique_violations(FX.profile_dim(spark, d), "email_address")


_NN_COLS = ["hd_order_or_tran_id", "hd_loyalty_id", "hd_store_id", "country"]


@register("check_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM pos_lines" for c in _NN_COLS))
def q_check_not_null(spark, d):
    return C.not_null_counts(FX.pos_lines(spark, d), _NN_COLS)


@register("check_primary_key", """
SELECT referencenumber, type, count(*) AS n, 'duplicate' AS problem FROM loyalty_txn
 WHERE referencenumber IS NOT NULL AND type IS NOT NULL
 GROUP BY referencenumber, type HAVING count(*) > 1
UNION ALL
SELECT referencenumber, type, count(*), 'null' FROM loyalty_txn
 WHERE referencenumber IS NULL OR type IS NULL GROUP BY referencenumber, type""")
def q_check_primary_key(spark, d):
    return C.primary_key_violations(FX.loyalty_txn(spark, d), ["referencenumber", "type"])


@register("check_foreign_key", """
SELECT c.* FROM (SELECT CASE WHEN memberid % 10 = 0 THEN -memberid ELSE memberid END AS memberid, altid FROM member_alt_id) c
  LEFT JOIN member p ON c.memberid = p.id WHERE c.memberid IS NOT NULL AND p.id IS NULL""")
def q_check_foreign_key(spark, d):
    """Every tenth member id of the child table is put where no member is."""
    child = FX.member_alt_id(spark, d).withColumn("memberid", F.when(F.col("memberid") % 10 == 0, -F.col("memberid")).otherwise(F.col("memberid")))
    return C.foreign_key_violations(child, "memberid", FX.member(spark, d), "id")


# ------------------------------------------------------------------ back-fill
_CRM_STEP = O.backfill_step_sql("SELECT * FROM member", "SELECT * FROM crm_profile", RUN_TS, BACKFILL_BY)


@register("backfill_crm", _CRM_STEP)
def q_backfill_crm(spark, d):
    return backfill_ids(FX.member(spark, d), [FX.crm_profile(spark, d)], RUN_TS)


@register("backfill_web", O.backfill_step_sql("SELECT * FROM member", "SELECT * FROM web_profile",
                                              RUN_TS, BACKFILL_BY))
def q_backfill_web(spark, d):
    return backfill_ids(FX.member(spark, d), [FX.web_profile(spark, d)], RUN_TS)


@register("backfill_chain", O.backfill_step_sql(_CRM_STEP, "SELECT * FROM web_profile", RUN_TS, BACKFILL_BY))
def q_backfill_chain(spark, d):
    return backfill_ids(FX.member(spark, d), [FX.crm_profile(spark, d), FX.web_profile(spark, d)], RUN_TS)


_BACKFILLED = O.backfill_step_sql(O.backfill_step_sql("SELECT * FROM member", O.LATEST_CRM_PROFILE_SQL, RUN_TS, BACKFILL_BY), O.LATEST_PROFILE_SQL, RUN_TS, BACKFILL_BY)


def _profile_sources(spark, d) -> list[DataFrame]:
    """The latest active profile per e-mail (W1) among CRM contacts, then among web users."""
    profiles = FX.profile_dim(spark, d)
    return [P.latest_profile_per_email(profiles, FX.crm_contact(spark, d), "email"), P.latest_profile_per_email(profiles, FX.web_user(spark, d))]


@register("job_profile_backfill", _BACKFILLED)
def q_job_profile_backfill(spark, d):
    return backfill_ids(FX.member(spark, d), _profile_sources(spark, d), RUN_TS)


@register("job_backfill_landed", _BACKFILLED)
def q_job_backfill_landed(spark, d):
    """The member table after two landing runs, the second from the web profiles as well."""
    run, (crm, web) = work_dir(spark, "member-target"), _profile_sources(spark, d)
    BF.land_members(FX.member(spark, d), f"{run}/member", 64)
    BF.run_backfill(spark, f"{run}/member", [crm], f"{run}/one", RUN_TS, "one")
    BF.run_backfill(spark, f"{run}/member", [crm, web], f"{run}/two", RUN_TS, "two")
    return BF.read_members(spark, f"{run}/member").select(*S.MEMBER_SCHEMA.names)


@register("window_latest_state", O.latest_profile_sql("(SELECT email_address FROM profile_dim)", "email_address"))
def q_window_latest_state(spark, d):
    """The stored state after three deliveries of the profiles, the second one delivered again."""
    run, profiles = work_dir(spark, "latest"), FX.profile_dim(spark, d)
    state = spark.createDataFrame([], P.STATE)
    for i, part in enumerate((2, 0, 1, 0)):
        delivery = profiles.where(F.pmod(F.xxhash64("uuid", "email_address", "last_update_ts"), F.lit(3)) == part)
        P.merge_latest(state, P.latest_state(delivery)).write.parquet(f"{run}/{i}")
        state = spark.read.parquet(f"{run}/{i}")
    return state.select("uuid", "email").where("email IS NOT NULL")


@register("job_profile_conflicts", O.conflicts_sql(
    f"(SELECT uuid, email_address, active_flag FROM profile_dim UNION ALL SELECT consumerid, email, 1 FROM ({_BACKFILLED}) m)"))
def q_job_profile_conflicts(spark, d):
    """Identity conflicts among the profiles and the members as the back-fill leaves them."""
    filled = q_job_profile_backfill(spark, d).select(F.col("consumerid").alias("uuid"), F.col("email").alias("email_address"), F.lit(1).alias("active_flag"))
    return P.identity_conflicts(FX.profile_dim(spark, d).select("uuid", "email_address", "active_flag").unionByName(filled))


# ------------------------------------------------------------------ migration
@register("join_account_txn", "SELECT e.*, a.memberid FROM crm_account_txn e JOIN member_alt_id a ON e.altid = a.altid")
def q_join_account_txn(spark, d):
    return M.join_alt_ids(FX.crm_account_txn(spark, d), FX.member_alt_id(spark, d))


_TXN_ORDER = [c for c in S.LOYALTY_TXN_COLUMNS if c != "id"]


@register("assign_txn_id",
          "SELECT CAST(1000 + row_number() OVER (ORDER BY "
          + ", ".join(f"{c} NULLS FIRST" for c in _TXN_ORDER)
          + ") AS BIGINT) AS id, " + ", ".join(_TXN_ORDER) + " FROM loyalty_txn")
def q_assign_txn_id(spark, d):
    return assign_sequential_ids(FX.loyalty_txn(spark, d), _TXN_ORDER, start=S.LOYALTY_TXN_ID_START)


@register("migrate_account_txn", O.account_txn_sql(RUN_TS))
def q_migrate_account_txn(spark, d):
    return M.account_txn_to_loyalty(FX.crm_account_txn(spark, d), FX.member_alt_id(spark, d), RUN_TS)


@register("apply_defaults", O.contact_target_sql(RUN_TS))
def q_apply_defaults(spark, d):
    return M.contacts_to_target(FX.crm_contact_stage(spark, d), RUN_TS)


@register("agg_running_load_count", O.RUNNING_COUNT_SQL)
def q_agg_running_load_count(spark, d):
    return M.running_load_counts(FX.crm_contact_stage(spark, d))


# ------------------------------------------------------------------ sources, sinks, jobs, stream
import datetime as _dt  # noqa: E402

from tallyspark import sinks as K  # noqa: E402
from tallyspark import sources as SRC  # noqa: E402
from tallyspark import streaming as ST  # noqa: E402
from tallyspark.functions import POS_TS_FORMAT  # noqa: E402
from tallyspark.plans.account_job import run_account_migration  # noqa: E402
from tallyspark.plans.key_store import KeyStore  # noqa: E402
from tallyspark.plans.contact_job import constraint_report, run_contact_load  # noqa: E402
from tallyspark.plans import history as H  # noqa: E402
from tallyspark.plans.ledger import StepLedger  # noqa: E402
from tallyspark.plans.pos_job import archive_lines, ledger_folder, run_pos_reconcile  # noqa: E402

# Fixed values for the file fixtures: drop prefix and file-name stamps.
DROP_PREFIX = "POSLOG_DAILY"
DROP_CODEC, DROP_FILES = "bzip2", "*.csv.bz2"  # the stream's drops: a tenth of the text, and still read in several splits
RUN_DT = _dt.datetime(2024, 3, 1, 0, 0)
CONTACT_COUNTRIES = FX.COUNTRY_BY_NATION_MOD8 + ["NL"]


def _write_csv(df: DataFrame, path: str, sep: str, partition_by: str | None = None, compression: str = "none") -> None:
    w = (df.write.option("compression", compression).mode("overwrite").option("header", "true").option("sep", sep)
         .option("escape", '"').option("timestampNTZFormat", POS_TS_FORMAT)
         .option("timestampFormat", POS_TS_FORMAT))
    if partition_by:
        w = w.partitionBy(partition_by)
    with shuffles_removed(df.sparkSession):
        w.csv(path)


def _pos_drop_folder(spark, d) -> str:
    """A drop folder holding today's batch, yesterday's lines and an unrelated file."""
    folder = work_dir(spark, "pos-drops")
    _write_csv(FX.pos_lines(spark, d), f"{folder}/{DROP_PREFIX}_20240201", "|")
    _write_csv(FX.pos_lines_history(spark, d), f"{folder}/{DROP_PREFIX}_20240131", "|")
    _write_csv(FX.pos_lines_history(spark, d), f"{folder}/OTHER_EXTRACT_20240201", "|")
    return folder


@register("src_pos_csv", "SELECT * FROM pos_lines")
def q_src_pos_csv(spark, d):
    folder = work_dir(spark, "pos-csv")
    _write_csv(FX.pos_lines(spark, d), f"{folder}/batch", "|")
    return SRC.read_pos_lines(spark, f"{folder}/batch")


@register("src_prefix_files", "SELECT * FROM pos_lines UNION ALL SELECT * FROM pos_lines_history")
def q_src_prefix_files(spark, d):
    return SRC.read_pos_drops(spark, _pos_drop_folder(spark, d), DROP_PREFIX).drop("drop_name")


@register("src_import_counts", f"""
SELECT '{DROP_PREFIX}_20240201' AS drop_name, count(*) AS n_rows FROM pos_lines
UNION ALL SELECT '{DROP_PREFIX}_20240131', count(*) FROM pos_lines_history
UNION ALL SELECT NULL, (SELECT count(*) FROM pos_lines) + (SELECT count(*) FROM pos_lines_history)""")
def q_src_import_counts(spark, d):
    return SRC.import_counts(SRC.read_pos_drops(spark, _pos_drop_folder(spark, d), DROP_PREFIX))


@register("src_account_csv", "SELECT * FROM crm_account_txn")
def q_src_account_csv(spark, d):
    folder = work_dir(spark, "account-csv")
    _write_csv(FX.crm_account_txn(spark, d), f"{folder}/accounttransaction_BE", ",")
    return SRC.read_account_txn(spark, f"{folder}/accounttransaction_BE")


def _load_with_bad_lines(spark, d) -> SRC.Load:
    """Today's batch with a file of lines that have two fields."""
    folder = work_dir(spark, "pos-bad")
    lines = FX.pos_lines(spark, d)
    _write_csv(lines, f"{folder}/in/good", "|")
    _write_csv(lines.where(F.col("itm_sku").cast("long") % 97 == 0).select(F.lit("broken").alias("a"), "hd_order_or_tran_id"), f"{folder}/in/bad", "|")
    return SRC.load_delimited(spark, [f"{folder}/in/good", f"{folder}/in/bad"], S.POS_SCHEMA, f"{folder}/staged", "|", most_bad=0.05)


@register("src_bad_rows", "SELECT * FROM pos_lines")
def q_src_bad_rows(spark, d):
    return _load_with_bad_lines(spark, d).good


@register("src_rejects", "SELECT 'bad' AS drop_name, concat('broken|', hd_order_or_tran_id) AS line FROM pos_lines WHERE CAST(itm_sku AS BIGINT) % 97 = 0")
def q_src_rejects(spark, d):
    return _load_with_bad_lines(spark, d).rejects.select(F.element_at(F.split("source_file", "/"), -2).alias("drop_name"), "line")


def _contact_files(spark, d, stage: DataFrame | None = None) -> list[str]:
    """One contact file set per country, as the CRM export delivers them."""
    folder = work_dir(spark, "contact-csv")
    stage = FX.crm_contact_stage(spark, d) if stage is None else stage
    _write_csv(stage.withColumn("file_country", F.col("country")), folder, ",", partition_by="file_country")
    return [f"{folder}/file_country={c}" for c in CONTACT_COUNTRIES]


@register("src_contact_csv", "SELECT * FROM crm_contact_stage")
def q_src_contact_csv(spark, d):
    return SRC.read_contacts(spark, _contact_files(spark, d))


@register("job_contact_load", O.RUNNING_COUNT_SQL)
def q_job_contact_load(spark, d):
    target = work_dir(spark, "contact-target") + "/contact"
    return run_contact_load(spark, _contact_files(spark, d), target, RUN_TS).running_counts


_UNTIDY = ("(SELECT CASE WHEN totalpoints < 0 THEN NULL ELSE email END AS email, country FROM crm_contact_stage "
           "UNION ALL SELECT email, country FROM crm_contact_stage WHERE country = 'BE') c")


@register("job_contact_checks", f"""
SELECT 'not_null' AS kind, 'email' AS column_name, count(*) FILTER (WHERE email IS NULL) AS n FROM {_UNTIDY}
UNION ALL SELECT 'not_null', 'country', count(*) FILTER (WHERE country IS NULL) FROM {_UNTIDY}
UNION ALL SELECT 'unique', 'email', count(*) FROM (SELECT email FROM {_UNTIDY} WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1) x
UNION ALL SELECT 'unique', 'consumerid', 0 UNION ALL SELECT 'unique', 'shopid', 0""")
def q_job_contact_checks(spark, d):
    """Constraint report of a load of every contact, some without an e-mail and one country delivered twice."""
    stage = FX.crm_contact_stage(spark, d)
    untidy = stage.withColumn("email", F.when(F.col("totalpoints") >= 0, F.col("email"))).unionByName(stage.where(F.col("country") == "BE"))
    target = work_dir(spark, "contact-target") + "/contact"
    return constraint_report(run_contact_load(spark, _contact_files(spark, d, untidy), target, RUN_TS))


def _run_account_loads(spark, d, loads=(0, 1)):
    """The account transactions of even numbers and then those of odd numbers, loaded into one target."""
    run, staged = work_dir(spark, "account-run"), FX.crm_account_txn(spark, d)
    results = []
    for load in loads:
        _write_csv(staged.where(F.col("accounttransactionid").cast("long") % 2 == load), f"{run}/in{load}", ",")
        results.append(run_account_migration(spark, f"{run}/in{load}", FX.member_alt_id(spark, d), FX.member(spark, d), f"{run}/target",
                                             f"{run}/work{load}", RUN_TS, f"load{load}"))
    return results


@register("job_account_migration", O.account_txn_sql(RUN_TS, "CAST(referencenumber AS BIGINT) % 2, "))
def q_job_account_migration(spark, d):
    """The target after two loads: the second one's ids continue the first one's."""
    return _run_account_loads(spark, d)[-1].target.select(*S.LOYALTY_TXN_COLUMNS)


@register("job_account_reload", O.account_txn_sql(RUN_TS, "CAST(referencenumber AS BIGINT) % 2, "))
def q_job_account_reload(spark, d):
    """The target after both loads and the first one again: it gets its own ids."""
    return _run_account_loads(spark, d, (0, 1, 0))[-1].target.select(*S.LOYALTY_TXN_COLUMNS)


@register("job_account_checks", """
SELECT count(*) AS loaded, CAST(0 AS BIGINT) AS key_violations, count(*) - count(m.id) AS orphans
  FROM (SELECT a.memberid FROM member_alt_id a JOIN crm_account_txn t ON a.altid = t.altid) x LEFT JOIN member m ON x.memberid = m.id""")
def q_job_account_checks(spark, d):
    """Rows of the target, and what the checks of the two loads found: ids that are not unique and rows without a member."""
    first, second = _run_account_loads(spark, d)
    counted = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    violations, orphans = first.key_violations.unionByName(second.key_violations), first.orphans.unionByName(second.orphans)
    return (counted(second.target, "loaded").withColumn("one", F.lit(1)).join(counted(violations, "key_violations").withColumn("one", F.lit(1)), "one")
            .join(counted(orphans, "orphans").withColumn("one", F.lit(1)), "one").drop("one"))


_TXN_KEY = T.StructType([T.StructField("referencenumber", T.StringType()), T.StructField("type", T.StringType())])


@register("check_keys_by_load", """
WITH delivered AS (SELECT referencenumber, type, CASE WHEN type = 'PURCHASE' THEN 'a' WHEN type IS NULL OR monetaryamount > 1000 THEN 'b' ELSE 'c' END AS load FROM loyalty_txn),
  upto AS (SELECT * FROM delivered UNION ALL SELECT referencenumber, 'PURCHASE', 'b' FROM delivered WHERE type = 'VOID_RETURN'),
  loads(load) AS (VALUES ('a'), ('b'), ('c'))
SELECT s.load, u.referencenumber, u.type, count(*) AS n,
       CASE WHEN u.referencenumber IS NULL OR u.type IS NULL THEN 'null' ELSE 'duplicate' END AS problem
  FROM loads s JOIN upto u ON u.load <= s.load GROUP BY s.load, u.referencenumber, u.type
HAVING count(*) FILTER (WHERE u.load = s.load) > 0 AND (count(*) > 1 OR u.referencenumber IS NULL OR u.type IS NULL)""")
def q_check_keys_by_load(spark, d):
    """Key violations that each of three loads reports when it is added, as a scan of all rows loaded until then would find them.  Load b also
    delivers purchases under the numbers of voided returns."""
    txn = FX.loyalty_txn(spark, d)
    load = F.when(F.col("type") == "PURCHASE", "a").when(F.col("type").isNull() | (F.col("monetaryamount") > 1000), "b").otherwise("c")
    again = txn.where("type = 'VOID_RETURN'").select("referencenumber", F.lit("PURCHASE").alias("type"), F.lit("b").alias("load"))
    delivered = txn.select("referencenumber", "type", load.alias("load")).unionByName(again)
    run = work_dir(spark, "key-store")
    store, found = KeyStore(spark, f"{run}/store", _TXN_KEY, 16), []
    for name in ("a", "b", "c"):
        store.add(name, delivered.where(F.col("load") == name), run)
        K.write_overwrite(store.violations(name).select(F.lit(name).alias("load"), "*"), f"{run}/found/{name}")
        found.append(spark.read.parquet(f"{run}/found/{name}"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@register("check_orphans_by_bucket", """
SELECT c.* FROM (SELECT CASE WHEN memberid % 10 = 0 THEN -memberid ELSE memberid END AS memberid, altid FROM member_alt_id) c
 WHERE c.memberid IS NOT NULL AND c.memberid NOT IN (SELECT id FROM member WHERE id IS NOT NULL)""")
def q_check_orphans_by_bucket(spark, d):
    """As check_foreign_key, against the stored keys of the members."""
    run = work_dir(spark, "member-keys")
    store = KeyStore(spark, f"{run}/store", T.StructType([S.MEMBER_SCHEMA["id"]]), 16)
    store.add("members", FX.member(spark, d), run)
    child = FX.member_alt_id(spark, d).withColumn("memberid", F.when(F.col("memberid") % 10 == 0, -F.col("memberid")).otherwise(F.col("memberid")))
    return store.missing(child, ["memberid"])


@register("sink_overwrite", O.MISSED_ALL_SQL)
def q_sink_overwrite(spark, d):
    path = work_dir(spark, "sink-overwrite") + "/missed"
    staged = path.rsplit("/", 1)[0] + "/staged"
    K.write_overwrite(R.missed_lines(_inputs(spark, d)), staged)  # found once, loaded twice
    m = spark.read.parquet(staged)
    K.write_overwrite(m, path)
    K.write_overwrite(m, path)  # a second load replaces, never adds
    return spark.read.parquet(path)


@register("sink_append", O.MISSED_ALL_SQL)
def q_sink_append(spark, d):
    run = work_dir(spark, "sink-append")
    path = f"{run}/missed"
    K.write_overwrite(R.missed_with_kind(_inputs(spark, d)).select(*S.MISSED_COLUMNS, "kind"), f"{run}/staged")  # all kinds found at once
    found = spark.read.parquet(f"{run}/staged")
    for kind in ("SALE", "RETU", "VOID"):  # one insert per branch
        K.write_append(found.where(F.col("kind") == kind), path, schema=S.MISSED_SCHEMA)
    return spark.read.parquet(path)


def _missed_stored(spark, d, run: str) -> DataFrame:
    """Missed lines of the driver's tables, found in steps below ``run``, which the caller removes after use."""
    batch, history, txn = _pos_tables(spark, d, run)
    inp = R.ReconcileInputs(batch, history, FX.member(spark, d), FX.member_alt_id(spark, d), txn)
    new = R.lines_to_resolve(inp, [r.kind for r in R.DEFAULT_RULES])
    return R.missed_in_steps(new, inp.member, inp.alt, inp.txn, f"{run}/matching").select(*S.MISSED_COLUMNS)


def _write_chunks(spark, d, run: str) -> None:
    rows = K.bulk_payload_chunks(_missed_stored(spark, d, f"{run}/steps"), max_rows=1000, stage=f"{run}/rows")
    Files(spark).delete(f"{run}/steps")  # the rows are placed
    K.write_payload(rows, f"{run}/chunks")
    Files(spark).delete(f"{run}/rows")


@register("sink_json_lines", O.row_json_sql(O.MISSED_ALL_SQL))
def q_sink_json_lines(spark, d):
    out = work_dir(spark, "export")
    path, _ = K.export_json_lines(_missed_stored(spark, d, f"{out}/steps"), out, "missed_transactions.json", RUN_DT)
    Files(spark).delete(f"{out}/steps")
    return spark.read.text(path).select(F.col("value").alias("row_json"))


@register("sink_export_count", f"SELECT count(*) AS exported FROM ({O.MISSED_ALL_SQL}) m")
def q_sink_export_count(spark, d):
    out = work_dir(spark, "export")
    _, n = K.export_json_lines(R.missed_lines(_inputs(spark, d)), out, "missed_transactions.json", RUN_DT)
    return spark.range(1).select(F.lit(n).cast("long").alias("exported"))


@register("sink_bulk_payload", O.row_json_sql(O.MISSED_ALL_SQL))
def q_sink_bulk_payload(spark, d):
    run = work_dir(spark, "payload")
    _write_chunks(spark, d, run)
    return K.payload_rows(K.read_payload(spark, f"{run}/chunks"))


@register("sink_payload_chunks", f"SELECT CAST(place // 1000 AS BIGINT) AS chunk_id, count(*) AS n_rows, count(*) AS rows_inside FROM "
          f"(SELECT row_number() OVER () - 1 AS place FROM ({O.MISSED_ALL_SQL}) m) x GROUP BY 1")
def q_sink_payload_chunks(spark, d):
    """Chunks of the payload: their numbers, the rows that they say they hold and the rows that they do."""
    run = work_dir(spark, "payload")
    _write_chunks(spark, d, run)
    return K.read_payload(spark, f"{run}/chunks").select(
        "chunk_id", "n_rows", F.size(F.from_json("payload", "array<string>")).cast("long").alias("rows_inside"))


@register("fn_row_json", O.row_json_sql(O.MISSED_ALL_SQL))
def q_fn_row_json(spark, d):
    return R.missed_lines(_inputs(spark, d)).select(row_json(S.MISSED_COLUMNS).alias("row_json"))


def _pos_tables(spark, d, run: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Today's batch, history and the transactions, all bound from one stored join of the driver's tables."""
    K.write_overwrite(FX.pos_join(spark, d), f"{run}/joined")
    base = FX.pos_layout(spark.read.parquet(f"{run}/joined"))
    return FX.lines_of(base), FX.history_of(base), FX.txn_of(base)


def _run_job(spark, d, threshold=None):
    """The job over the whole tables; without a threshold the gate is open and every step runs."""
    run = work_dir(spark, "pos-run")
    history_path = f"{run}/history"
    batch, history, txn = _pos_tables(spark, d, run)
    archive_lines(history, history_path, "before")
    result = run_pos_reconcile(spark, batch, history_path, FX.member(spark, d),
                               FX.member_alt_id(spark, d), txn, f"{run}/work",
                               f"{run}/out", threshold, run_ts=RUN_DT, batch_id="today")
    return result, history_path


@register("job_pos_reconcile", O.MISSED_ALL_SQL)
def q_job_pos_reconcile(spark, d):
    return spark.read.parquet(_run_job(spark, d)[0].missed_path).select(*S.MISSED_COLUMNS)


@register("job_pos_archive", "SELECT * FROM pos_lines_history UNION ALL "
          "(SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history)")
def q_job_pos_archive(spark, d):
    """History after a run that passed the gate."""
    return spark.read.parquet(_run_job(spark, d)[1]).select(*S.POS_COLUMNS)


@register("job_pos_export", O.row_json_sql(O.MISSED_ALL_SQL))
def q_job_pos_export(spark, d):
    """The rows inside the payload of a run that passed the gate."""
    return K.payload_rows(K.read_payload(spark, _run_job(spark, d)[0].payload_path))


@register("job_history_compacted", "SELECT * FROM pos_lines_history UNION ALL "
          "(SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history)")
def q_job_history_compacted(spark, d):
    """History of eight batches and today's new lines after compaction: every line is there, every day in one part."""
    run = work_dir(spark, "history")
    batch, history, _ = _pos_tables(spark, d, run)
    K.write_overwrite(history, f"{run}/delivered")  # eight batches are taken from it
    lines = spark.read.schema(S.POS_SCHEMA).parquet(f"{run}/delivered")
    for i in range(8):
        H.archive_lines(lines.where(F.pmod(F.xxhash64("itm_sku"), F.lit(8)) == i), f"{run}/history", f"b{i}")
    Files(spark).delete(f"{run}/delivered")
    K.write_overwrite(H.batch_days(batch), f"{run}/days")
    old = H.history_for_batch(H.read_history(spark, f"{run}/history"), spark.read.parquet(f"{run}/days"))
    H.archive_lines(H.new_lines_by_day(batch, old), f"{run}/history", "today", by_day=True)
    for done in ("joined", "days"):
        Files(spark).delete(f"{run}/{done}")
    H.compact(spark, f"{run}/history")
    return H.read_history(spark, f"{run}/history").select(*S.POS_COLUMNS)


class _Broken(RuntimeError):
    pass


class _BreaksOff(StepLedger):
    """A ledger whose run fails when ``last`` steps are done."""

    last = 0

    def step(self, name, mark, work):
        out = super().step(name, mark, work)
        if self.at == self.last:
            raise _Broken(name)
        return out


def _resumed_run(spark, d) -> StepLedger:
    """The job, broken off after each of its steps in turn and taken up again."""
    run = work_dir(spark, "pos-resumed")
    batch, history, txn = _pos_tables(spark, d, run)
    archive_lines(history, f"{run}/history", "before")
    for steps in (1, 2, 3, 4, 5, 6, 0):
        ledger = _BreaksOff(spark, ledger_folder(f"{run}/work", "today"))
        ledger.last = steps
        try:
            run_pos_reconcile(spark, batch, f"{run}/history", FX.member(spark, d), FX.member_alt_id(spark, d), txn,
                              f"{run}/work", f"{run}/out", None, run_ts=RUN_DT, batch_id="today", resume=ledger)
        except _Broken:
            pass
    return ledger


@register("job_pos_resumed", f"""
SELECT s.step, CASE s.step WHEN 'stage' THEN (SELECT count(*) FROM pos_lines) WHEN 'new-lines' THEN n.n WHEN 'archive' THEN n.n ELSE m.n END AS n_rows, 1 AS ran
  FROM (VALUES ('stage'), ('new-lines'), ('missed'), ('export'), ('payload'), ('archive')) s(step),
       (SELECT count(*) AS n FROM (SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history) x) n, (SELECT count(*) AS n FROM ({O.MISSED_ALL_SQL}) y) m""")
def q_job_pos_resumed(spark, d):
    """The ledger of a run that broke off after every step: each step is in it once and ran once."""
    entries = _resumed_run(spark, d).entries()
    return spark.createDataFrame([(e["step"], e["result"]["rows"], e["ran"]) for e in entries], "step string, n_rows long, ran int")


@register("job_pos_ready_export", O.row_json_sql(O.MISSED_ALL_SQL))
def q_job_pos_ready_export(spark, d):
    """What a reader of finished exports sees after a run."""
    run = _run_job(spark, d)[1].rsplit("/", 1)[0]
    return K.read_ready(spark, f"{run}/out").select("row_json")


@register("job_pos_gate_tripped", "SELECT count(*) AS history, false AS passed, CAST(0 AS BIGINT) AS exported, CAST(0 AS BIGINT) AS archived "
          "FROM pos_lines_history")
def q_job_pos_gate_tripped(spark, d):
    """A run that any missed line stops: history stays as it was, nothing is exported."""
    r, history_path = _run_job(spark, d, threshold=0)
    return spark.read.parquet(history_path).agg(F.count(F.lit(1)).alias("history")).select(
        "history", F.lit(r.passed).alias("passed"), F.lit(r.exported).cast("long").alias("exported"), F.lit(r.archived).cast("long").alias("archived"))


@register("job_run_summary", f"SELECT (SELECT count(*) FROM pos_lines) AS imported, n.new_lines, m.missed, true AS passed, m.missed AS exported, "
          f"n.new_lines AS archived FROM (SELECT count(*) AS new_lines FROM (SELECT * FROM pos_lines EXCEPT SELECT * FROM pos_lines_history) x) n, "
          f"(SELECT count(*) AS missed FROM ({O.MISSED_ALL_SQL}) y) m")
def q_job_run_summary(spark, d):
    r, _ = _run_job(spark, d)
    return spark.range(1).select(
        F.lit(r.imported).cast("long").alias("imported"), F.lit(r.new_lines).cast("long").alias("new_lines"),
        F.lit(r.missed).cast("long").alias("missed"), F.lit(r.passed).alias("passed"),
        F.lit(r.exported).cast("long").alias("exported"), F.lit(r.archived).cast("long").alias("archived"))


def _run_stream(spark, d) -> tuple[str, dict]:
    """Today's batch arrives as several files; the stream reconciles them two files at a time and moves them away."""
    root = work_dir(spark, "stream")
    _, before, txn = _pos_tables(spark, d, root)
    # dealt before they get their layout, in which they are longer; a copy may come in another file
    dealt = FX.copied(spark.read.parquet(f"{root}/joined"), "l_partkey").repartition(4, "l_orderkey", "_copy")
    _write_csv(FX.pos_layout(dealt).select(*S.POS_COLUMNS), f"{root}/in", "|", compression=DROP_CODEC)
    history = f"{root}/history"
    archive_lines(before, history, "before")
    # the lookups are tables at rest, read by every micro-batch
    tables = {}
    for name, rows in (("member", FX.member(spark, d)), ("member_alt_id", FX.member_alt_id(spark, d)), ("loyalty_txn", txn)):
        K.write_overwrite(rows, f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    Files(spark).delete(f"{root}/joined")  # all tables are bound
    results = ST.reconcile_stream(spark, f"{root}/in", f"{root}/ckpt", f"{root}/out", history, tables["member"], tables["member_alt_id"], tables["loyalty_txn"],
                                  archive_dir=f"{root}/processed", max_files_per_trigger=2, file_glob=DROP_FILES)
    return root, results


@register("stream_ingest_archive", O.MISSED_ALL_SQL)
def q_stream_ingest_archive(spark, d):
    """Missed lines of all micro-batches."""
    return ST.read_stream_output(spark, _run_stream(spark, d)[0] + "/out")


@register("stream_consumed_files", "SELECT CAST(0 AS BIGINT) AS left_in_drop, true AS all_moved, p.* FROM pos_lines p")
def q_stream_consumed_files(spark, d):
    """The lines of the files in the processed folder after one run, beside what is left in the drop folder."""
    root, _ = _run_stream(spark, d)
    left = [e for e in Files(spark).list(f"{root}/in") if e.name.endswith(DROP_FILES[1:])]
    moved = [e.path for e in Files(spark).walk(f"{root}/processed") if e.name.endswith(DROP_FILES[1:])]
    lines = SRC.read_pos_lines(spark, moved)
    return lines.select(F.lit(len(left)).cast("long").alias("left_in_drop"), F.lit(len(moved) == 4).alias("all_moved"), *S.POS_COLUMNS)
