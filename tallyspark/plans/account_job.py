"""Account-transaction migration job: stage a CRM export, migrate it under keys of its own, and check the target's declared
keys.

The keys of a load are a range that the job reserves in a ledger beside the target before it writes a row.  So any load, not
only the last, can be run again under its own ids, and two loads never share one.

Checks look at the load alone: its ids are held against those of earlier loads in a ``KeyStore`` beside the target, of which only
the buckets that the load touches are read, and its rows without a member are sought among its own rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.files import Files
from tallyspark.operators.keys import next_start, number_rows, place_rows
from tallyspark.operators.migrate import ACCOUNT_TXN_ORDER, account_txn_layout
from tallyspark.operators.quality import foreign_key_violations
from tallyspark.plans.key_store import KeyStore
from tallyspark.plans.ledger import KeyLedger
from tallyspark.sinks import write_overwrite
from tallyspark.sources import read_account_txn

LOAD_PARTITION = "load_id"
ID_BUCKETS = 64


@dataclass
class AccountMigration:
    staged: int
    loaded: int
    first_id: int
    target: DataFrame
    key_violations: DataFrame  # of ids that this load holds
    orphans: DataFrame  # rows of this load


def read_target(spark: SparkSession, target_path: str, but: str | None = None) -> DataFrame | None:
    """Migrated transactions, those of load ``but`` left out; None if nothing was loaded yet."""
    if not Files(spark).exists(target_path):
        return None
    schema = T.StructType([*S.LOYALTY_TXN_SCHEMA.fields, T.StructField(LOAD_PARTITION, T.StringType())])
    target = spark.read.schema(schema).parquet(target_path)
    return target if but is None else target.where(F.col(LOAD_PARTITION) != but)


def key_folder(target_path: str) -> str:
    return f"{target_path.rstrip('/')}-keys"


def id_store(spark: SparkSession, target_path: str, buckets: int = ID_BUCKETS) -> KeyStore:
    """The ids of the target by load; the first load of a target fixes the number of buckets."""
    return KeyStore(spark, f"{target_path.rstrip('/')}-ids", T.StructType([S.LOYALTY_TXN_SCHEMA["id"]]), buckets)


def _loads(spark: SparkSession, target_path: str) -> list[str]:
    prefix = f"{LOAD_PARTITION}="
    return [e.name[len(prefix):] for e in Files(spark).list(target_path) if e.is_dir and e.name.startswith(prefix)]


def run_account_migration(spark: SparkSession, paths: str | list[str], alt: DataFrame, member: DataFrame, target_path: str,
                          run_dir: str, run_ts, load_id: str, member_keys: KeyStore | None = None) -> AccountMigration:
    """Load one export as load ``load_id``, a partition of the target.  Running a load again replaces its own rows and no
    others, under the same ids; if it has grown, the rows more get a range behind all others.  ``member_keys``, a store of
    the members' ids, spares the foreign-key check the scan of ``member``."""
    if not re.fullmatch(r"[A-Za-z0-9-][A-Za-z0-9_-]*", load_id):
        raise ValueError(f"load id {load_id!r}: letters, digits, - and _ only, and no _ in front")
    staged = write_overwrite(read_account_txn(spark, paths), f"{run_dir}/staged")
    laid_out = account_txn_layout(spark.read.schema(S.ACCOUNT_TXN_SCHEMA).parquet(f"{run_dir}/staged"), alt, run_ts).drop("id")
    # ordered by all columns: rows that tie are equal, so a repeated load numbers its rows as it did before
    rest = [c for c in laid_out.columns if c not in ACCOUNT_TXN_ORDER]
    placed = place_rows(laid_out, [*ACCOUNT_TXN_ORDER, *rest], f"{run_dir}/placed")
    keys = KeyLedger(spark, key_folder(target_path), S.LOYALTY_TXN_ID_START)
    if not keys.ranges() and (earlier := read_target(spark, target_path)) is not None:  # rows from before there was a ledger
        keys.start = next_start(earlier, default=S.LOYALTY_TXN_ID_START)
    ranges = keys.reserve(load_id, placed.count())
    loaded = write_overwrite(number_rows(placed, "id", ranges).select(*S.LOYALTY_TXN_COLUMNS), f"{target_path}/{LOAD_PARTITION}={load_id}")
    Files(spark).delete(f"{run_dir}/placed")
    rows_of = lambda load: spark.read.schema(S.LOYALTY_TXN_SCHEMA).parquet(f"{target_path}/{LOAD_PARTITION}={load}")
    ids = id_store(spark, target_path)
    for other in sorted(set(_loads(spark, target_path)) - {load_id, *ids.loads()}):  # loads that broke off before this step, or are older than the store
        ids.add(other, rows_of(other), run_dir)
    ids.add(load_id, rows_of(load_id), run_dir)
    members = foreign_key_violations(rows_of(load_id), "memberid", member, "id") if member_keys is None else member_keys.missing(rows_of(load_id), ["memberid"])
    return AccountMigration(staged, loaded, ranges[0][0] if ranges else keys.start, read_target(spark, target_path), ids.violations(load_id), members)
