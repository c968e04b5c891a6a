"""Back-fill of member ids from source profiles, in priority order.

Source statements (one ``UPDATE … FROM`` per source, run in order): set the id
from the source row with the same (lower-cased) e-mail where the id is still
NULL, and stamp the audit columns.  Only the member side is lower-cased.

Here the chain is one pass producing a new snapshot: every source is reduced to
one row per e-mail (smallest id: a repeatable pick where the source statement
picked arbitrarily) and left-joined on the same key, so the member table is
shuffled once for all sources.  A matched source row whose id is NULL still
counts as a match (the audit columns change, the id stays NULL).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: audit text written on back-filled rows.
BACKFILL_BY = "profile back-fill"


def backfill_ids(member: DataFrame, sources: list[DataFrame], run_ts: dt.datetime | str | None = None,
                 by: str = BACKFILL_BY, id_col: str = "consumerid", email_col: str = "email",
                 source_id: str = "uuid", source_email: str = "email") -> DataFrame:
    cols = member.columns
    # NULL e-mails never match; give each one its own key so they spread over
    # partitions instead of all hashing to one (the residual keeps it exact)
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in cols]).cast("string"))
    m = member.withColumn("_key", F.coalesce(F.lower(email_col), spread))
    current = F.col(id_col)
    updated = F.lit(False)
    for i, src in enumerate(sources):
        s = (src.groupBy(F.col(source_email).alias(f"_key{i}"))
             .agg(F.min(source_id).alias(f"_id{i}"), F.lit(True).alias(f"_hit{i}")))
        on = (m["_key"] == s[f"_key{i}"]) & F.col(email_col).isNotNull()
        m = m.join(s, on, "left").drop(f"_key{i}")
        take = current.isNull() & F.col(f"_hit{i}").isNotNull()
        current = F.when(take, F.col(f"_id{i}")).otherwise(current)
        updated = updated | take
    if run_ts is None:
        ts = F.localtimestamp()              # NOW(), one value per query
    elif isinstance(run_ts, str):
        ts = F.to_timestamp_ntz(F.lit(run_ts))
    else:
        ts = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    out = m.select(*[
        current.alias(c) if c == id_col
        else F.when(updated, ts).otherwise(F.col(c)).alias(c) if c == "lastupdatedat"
        else F.when(updated, F.lit(by)).otherwise(F.col(c)).alias(c) if c == "lastupdatedby"
        else F.col(c)
        for c in cols])
    return out
