"""Consumer-profile analysis: counts, duplicates, zone filter, e-mail matching,
latest profile per e-mail, identity conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Loyalty zone codes of the programme's countries.
PROGRAMME_ZONES = ["BEL", "CZE", "DEU", "ESP", "FRA", "GBR", "ITA", "NLD"]


def active(profiles: DataFrame, flag: str = "active_flag") -> DataFrame:
    return profiles.where(F.col(flag) == 1)


def contacts_in_zones(contacts: DataFrame, zones=PROGRAMME_ZONES, zone_col: str = "loyaltyzonecode") -> DataFrame:
    return contacts.where(F.col(zone_col).isin(list(zones)))


def profiles_in_zones(profiles: DataFrame, contacts: DataFrame, zones=PROGRAMME_ZONES) -> DataFrame:
    """Active profiles whose e-mail is a contact in one of the zones (``IN`` subquery → semi join).
    A repeated e-mail is folded before the shuffle: the join cannot split its right side."""
    keys = contacts_in_zones(contacts, zones).select(F.col("email").alias("_zone_email")).distinct()
    p = active(profiles)
    return p.join(keys, p["email_address"] == keys["_zone_email"], "left_semi")


def count_and_distinct(df: DataFrame, *distinct_cols: str) -> DataFrame:
    """One row: ``n_rows`` plus ``n_distinct_<col>`` per column (NULLs not counted)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_distinct(c).alias(f"n_distinct_{c}") for c in distinct_cols])


def having_count(df: DataFrame, key: str, counted: str, distinct: bool = False,
                 min_count: int = 2, out: str = "n") -> DataFrame:
    """Keys with at least ``min_count`` (distinct) non-NULL values of ``counted``."""
    agg = F.count_distinct(counted) if distinct else F.count(counted)
    return df.groupBy(key).agg(agg.alias(out)).where(F.col(out) >= min_count)


def match_case_insensitive(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                           how: str = "inner") -> DataFrame:
    """Equi-join on ``lower(a) = lower(b)``: still a hash-partitioned join."""
    return left.join(right, F.lower(left[left_col]) == F.lower(right[right_col]), how)


def latest_per_key(df: DataFrame, key: Column, ts: str, value: str,
                   key_name: str = "key") -> DataFrame:
    """Top-1 row per key: latest ``ts`` (NULL last), ties broken by the larger ``value``.

    Written as an aggregate of ``max(struct(ts_present, ts, value))`` rather than
    ``row_number() = 1``: the partial aggregate keeps one row per key in each map
    task, so a hot key ships a handful of rows, and no sort is needed.
    """
    best = F.max(F.struct(F.col(ts).isNotNull().alias("p"), F.col(ts).alias("t"), F.col(value).alias("v")))
    return df.groupBy(key.alias(key_name)).agg(best.alias("_best")).select(
        F.col("_best.v").alias(value), F.col(key_name))


STATE = "email string, dated boolean, last_update_ts timestamp_ntz, uuid string"


def latest_state(profiles: DataFrame, key: str = "email_address") -> DataFrame:
    """The latest active profile of each lower-cased e-mail, as a state that can be merged (STATE)."""
    best = F.max(F.struct(F.col("last_update_ts").isNotNull().alias("dated"), "last_update_ts", "uuid")).alias("best")
    return active(profiles).groupBy(F.lower(key).alias("email")).agg(best).select("email", "best.*")


def merge_latest(state: DataFrame, delivery: DataFrame) -> DataFrame:
    """A state and another (of a later, a late or a repeated delivery) as one: a maximum of maxima, so the order of
    deliveries does not matter and a repeated one changes nothing."""
    best = F.max(F.struct("dated", "last_update_ts", "uuid")).alias("best")
    return state.unionByName(delivery).groupBy("email").agg(best).select("email", "best.*")


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """Top-k rows per key (``row_number() <= k``; Spark inserts a partial
    group limit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def latest_profile_per_email(profiles: DataFrame, users: DataFrame, user_col: str = "p_uid") -> DataFrame:
    """Latest active profile per lower-cased e-mail among the users (web users, CRM contacts): (uuid, email).

    The users' e-mails are folded before the shuffle: the semi join cannot split its right side."""
    keys = users.select(F.lower(user_col).alias("_user_email")).where(F.col("_user_email").isNotNull()).distinct()
    known = active(profiles).join(keys, F.lower("email_address") == F.col("_user_email"), "left_semi")
    return latest_per_key(known, F.lower("email_address"), "last_update_ts", "uuid", key_name="email")


def identity_conflicts(profiles: DataFrame, id_col: str = "uuid", email_col: str = "email_address",
                       flag: str = "active_flag") -> DataFrame:
    """(conflict, key, n):
    - ``email_active_ids``: a non-NULL e-mail held by several active ids;
    - ``id_one_active_email``: an id with several e-mails of which exactly one is active.
    """
    slim = profiles.select(id_col, email_col, (F.col(flag) == 1).alias("_act")).distinct()
    by_email = (slim.where(F.col(email_col).isNotNull() & F.col("_act"))
                .groupBy(email_col).agg(F.count_distinct(id_col).alias("n"))
                .where(F.col("n") > 1)
                .select(F.lit("email_active_ids").alias("conflict"), F.col(email_col).alias("key"), "n"))
    by_id = (slim.groupBy(id_col)
             .agg(F.count_distinct(email_col).alias("n"),
                  F.count_distinct(F.when(F.col("_act"), F.col(email_col))).alias("_n_act"))
             .where((F.col("n") > 1) & (F.col("_n_act") == 1))
             .select(F.lit("id_one_active_email").alias("conflict"), F.col(id_col).alias("key"), "n"))
    return by_email.unionByName(by_id)
