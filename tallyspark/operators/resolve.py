"""Loyalty-id → member resolution (direct id preferred over alternate id).

Source semantics (two left joins then ``COALESCE(direct.id, alt.memberid)``,
keep the line when either side hit):

- a line whose id hits ``d`` direct members and ``a`` alternate rows becomes
  ``d × max(a, 1)`` lines carrying the direct member ids (direct wins, but the
  alternate rows still multiply it);
- with no direct hit it becomes one line per alternate row with a member id;
- a NULL id never resolves.

Instead of joining the (large) line table twice, the dimension side is folded
once into a lookup with one ``(lookup_id, memberid)`` row per output copy: the
full outer join of direct ids and alternate rows gives ``d × max(a, 1)`` rows for a
direct hit and the alternate rows of other ids, and reads each table once.  Lines then inner-join the lookup once and the
fan-out of the two-join form comes out of the join itself.  Member ids are
primary keys (never NULL), as the foreign key on the transaction table states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_lookup(member: DataFrame, alt: DataFrame) -> DataFrame:
    """One row per resolved copy: (lookup_id, memberid).  Dimension-sized."""
    direct = (member.where(F.col("consumerid").isNotNull())
              .select(F.col("consumerid").alias("lookup_id"), F.col("id").alias("memberid")))
    alt_rows = (alt.where(F.col("altid").isNotNull())
                .select(F.col("altid").alias("lookup_id"), "memberid"))
    # every alternate row multiplies a direct hit, whatever its member id
    both = direct.join(alt_rows.withColumnRenamed("memberid", "_alt"), "lookup_id", "full")
    return both.select("lookup_id", F.coalesce("memberid", "_alt").alias("memberid")).where(F.col("memberid").isNotNull())


SALT, SALTS = "_salt", 8


def salted(lines: DataFrame) -> DataFrame:
    """Lines with a number by their transaction, so that a loyalty id with very many lines lies in ``SALTS`` places."""
    return lines.withColumn(SALT, F.pmod(F.xxhash64("hd_order_date_time", "hd_order_or_tran_id"), F.lit(SALTS)).cast("int"))


def resolve_members(lines: DataFrame, member: DataFrame, alt: DataFrame,
                    key: str = "hd_loyalty_id", out: str = "memberid") -> DataFrame:
    """Lines with a resolved ``memberid``; unresolved lines are dropped.  ``salted`` lines meet a lookup that has every id
    under each number."""
    lookup = member_lookup(member, alt)
    same = F.col(key) == lookup["lookup_id"]
    if SALT in lines.columns:
        lookup = lookup.withColumn("_lookup_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        same = (F.col(key) == F.col("lookup_id")) & (F.col(SALT) == F.col("_lookup_salt"))
    resolved = lines.where(F.col(key).isNotNull()).join(lookup, same, "inner")
    return resolved.drop("lookup_id", SALT, "_lookup_salt").withColumnRenamed("memberid", out)


def store_lookup(member: DataFrame, alt: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write the lookup as a table bucketed and sorted by ``lookup_id``: made once per change of the members, read by every batch."""
    (member_lookup(member, alt).repartition(buckets, "lookup_id").write.mode("overwrite").option("path", path)
     .bucketBy(buckets, "lookup_id").sortBy("lookup_id").saveAsTable(table))


def stage_lines(lines: DataFrame, table: str, path: str, buckets: int, key: str = "hd_loyalty_id") -> None:
    """Write the lines that can resolve (those with a loyalty id) in the same buckets."""
    (lines.where(F.col(key).isNotNull()).repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def resolve_stored(lines: DataFrame, lookup: DataFrame, key: str = "hd_loyalty_id", out: str = "memberid") -> DataFrame:
    """``resolve_members`` over a stored lookup.  Where both tables have the same buckets by their keys the join needs no shuffle;
    a loyalty id with very many lines then stays in its bucket's task, so stage lines unbucketed where that matters (the join
    then shuffles the lines alone, and Spark can split the frequent id)."""
    return lines.join(lookup, F.col(key) == lookup["lookup_id"], "inner").drop("lookup_id").withColumnRenamed("memberid", out)
