"""CRM migration: account transactions into the loyalty-transaction layout, and
contacts into the contact layout with declared defaults."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.operators.keys import assign_sequential_ids

# account-transaction column → loyalty-transaction column (the source insert list)
ACCOUNT_TXN_MAPPING = {
    "country": "country",
    "accounttransactionid": "referencenumber",
    "accounttransactiondate": "date",
    "accounttransactionvalue": "points",
    "accounttransactionvaluevalidityenddate": "expirydate",
    "rulesourceactionloyaltyzonecode": "type",
    "createddate": "createdat",
    "updateddate": "lastupdatedat",
    "lastupdatedby": "lastupdatedby",
}


def join_alt_ids(staged: DataFrame, alt: DataFrame) -> DataFrame:
    """Inner join staged rows to alternate ids: fan-out kept, unmatched dropped."""
    return staged.join(alt.select("altid", "memberid"), "altid", "inner")


def conform(df: DataFrame, schema: T.StructType, values: dict[str, Column] | None = None,
            defaults: dict[str, Column] | None = None) -> DataFrame:
    """Select ``df`` into ``schema`` order and types.

    A column comes from ``values`` when given, else from ``df`` when present
    (an explicit NULL stays NULL), else from ``defaults`` (the declared column
    default), else NULL.
    """
    values = values or {}
    defaults = defaults or {}
    present = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in values:
            e = values[f.name]
        elif f.name in present:
            e = F.col(f.name)
        elif f.name in defaults:
            e = defaults[f.name]
        else:
            e = F.lit(None)
        out.append(e.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _ts(run_ts) -> Column:
    """Run time as a zone-less timestamp; ``None`` means now (the source's ``NOW()``),
    taken once per query so every row gets the same value."""
    if run_ts is None:
        return F.localtimestamp()
    if isinstance(run_ts, str):
        return F.to_timestamp_ntz(F.lit(run_ts))
    if isinstance(run_ts, dt.datetime):
        return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return run_ts


def txn_defaults(run_ts=None) -> dict[str, Column]:
    return {"createdat": _ts(run_ts), "lastupdatedat": _ts(run_ts)}


def contact_defaults(run_ts=None) -> dict[str, Column]:
    return {"crmid_reused": F.lit(False), "createdat": _ts(run_ts), "lastupdatedat": _ts(run_ts)}


ACCOUNT_TXN_ORDER = ["referencenumber", "memberid"]


def account_txn_layout(staged: DataFrame, alt: DataFrame, run_ts=None) -> DataFrame:
    """Staged account transactions → loyalty-transaction rows, still without ids."""
    j = join_alt_ids(staged, alt)
    mapped = j.select("memberid", *[F.col(src).alias(dst) for src, dst in ACCOUNT_TXN_MAPPING.items()])
    return conform(mapped, S.LOYALTY_TXN_SCHEMA, defaults=txn_defaults(run_ts))


def account_txn_to_loyalty(staged: DataFrame, alt: DataFrame, run_ts=None, start: int = S.LOYALTY_TXN_ID_START,
                           order: list[str] | None = None) -> DataFrame:
    """Staged account transactions → loyalty-transaction rows with fresh ids."""
    return assign_sequential_ids(account_txn_layout(staged, alt, run_ts), order or ACCOUNT_TXN_ORDER, start=start)


def contacts_to_target(stage: DataFrame, run_ts=None) -> DataFrame:
    """Staged contacts → 20-column contact layout with column defaults."""
    return conform(stage, S.CONTACT_SCHEMA, defaults=contact_defaults(run_ts))


def running_load_counts(df: DataFrame, part_col: str = "country") -> DataFrame:
    """Rows per load part and the running total after each part (parts in
    name order).  The window runs over the per-part counts only: one row per
    part, a handful of rows."""
    per = df.groupBy(part_col).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.orderBy(part_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.select(part_col, "n_rows", F.sum("n_rows").over(w).alias("running_rows"))
