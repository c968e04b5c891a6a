"""Missed-transaction detection: POS lines with no matching loyalty transaction.

The source job runs three near-identical statements (SALE, RETU, VOID).  Here
the differences are data (``MatchRule``) and the work is one plan:

    new lines → candidate layout → member resolution (once, all kinds)
      → anti join on the 7 header keys (type predicate per kind)
      → anti join on (member, original tran id) for kinds that have one

Matching uses plain equality: a NULL in any key never matches, so such a line
is always reported.  Amounts compare as 32-bit floats.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions import amount_real, country_prefix, parse_pos_ts, real_key, tran_kind
from tallyspark.operators.resolve import resolve_members


@dataclass(frozen=True)
class MatchRule:
    kind: str                                   # text before '#' in the tran id
    header_types: tuple[str, ...] | None        # None = any transaction type
    original_types: tuple[str, ...] | None = None  # None = no original-tran check


# The reconciliation rules of the source job.
DEFAULT_RULES = (
    MatchRule("SALE", ("PURCHASE",)),
    MatchRule("RETU", None, ("RETURN",)),
    MatchRule("VOID", None, ("VOID_PURCHASE", "VOID_RETURN")),
)

HEADER_KEYS = [  # (candidate column, transaction column)
    ("memberid", "memberid"), ("tran_ts", "date"), ("country", "country"),
    ("store_id", "store"), ("currency", "currency"), ("tran_id", "referencenumber"),
    ("amount_real", "monetaryamount"),
]


# Columns of the missed line that no rule looks at; a job may carry them as one text (``functions.pack``).
CARRIED = ["itm_sku", "itm_quantity", *S.DISCOUNT_CODE_COLUMNS]


def candidate_layout(lines: DataFrame, strict_ts: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project and rename the 42-column POS line to the missed-line layout
    (``keep`` carries extra columns, such as the resolved member id, in front).  ``CARRIED`` columns that the lines lack are left out."""
    carried = [c for c in CARRIED if c in lines.columns]
    return lines.select(
        *keep,
        parse_pos_ts("hd_file_extract_date_time", strict_ts).alias("extract_ts"),
        F.col("hd_order_or_tran_id").alias("tran_id"),
        parse_pos_ts("hd_order_date_time", strict_ts).alias("tran_ts"),
        F.col("hd_loyalty_id").alias("loyalty_id"),
        country_prefix("country").alias("country"),
        F.col("hd_store_id").alias("store_id"),
        F.col("hd_currency").alias("currency"),
        *carried[:2],
        F.col("itm_amt_after_disc").alias("itm_amount"),
        *carried[2:],
        F.col("hd_orig_tran_id").alias("orig_tran_id"),
    )


def with_kind(lines: DataFrame, kinds: list[str], col: str = "hd_order_or_tran_id") -> DataFrame:
    """Keep lines of the given kinds (pushed below the joins by Catalyst)."""
    return lines.where(tran_kind(col).isin(kinds))


def resolved_candidates(new: DataFrame, member: DataFrame, alt: DataFrame,
                        rules=DEFAULT_RULES, strict_ts: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Member-resolved candidate lines of every rule kind: ``memberid``, ``keep``, the
    21 missed-line columns and ``kind``."""
    lines = with_kind(new, [r.kind for r in rules])
    resolved = resolve_members(lines, member, alt, key="hd_loyalty_id", out="memberid")
    return (candidate_layout(resolved, strict_ts, keep=("memberid", *keep))
            .withColumn("kind", tran_kind("tran_id")))


def _settles(rule: MatchRule) -> str:
    return f"_t_settles_{rule.kind}"


def _type_predicate(rules, kind: Column) -> Column | None:
    if all(r.header_types is None for r in rules):
        return None
    terms = [(kind == r.kind) if r.header_types is None else ((kind == r.kind) & F.col(_settles(r)))
             for r in rules]
    return reduce(lambda a, b: a | b, terms)


def header_keys(txn: DataFrame, rules) -> DataFrame:
    """One row per header key of the transactions, with a flag per type-bound rule: some transaction of that key
    has a type that settles the rule's kind.

    A semi or anti join cannot split its right side, so repeated keys are folded first: the partial aggregate ships one
    row per key and map task, and the join reuses the aggregate's partitioning.  A transaction with a NULL key part can
    never match (plain equality) and is dropped before the shuffle.  The amount is a key as text (``real_key``)."""
    keys = [(real_key(tc) if tc == "monetaryamount" else F.col(tc)).alias(f"_t_{tc}") for _, tc in HEADER_KEYS]
    complete = txn.where(reduce(lambda a, b: a & b, [F.col(tc).isNotNull() for _, tc in HEADER_KEYS]))
    flags = [F.max(F.col("type").isin(list(r.header_types))).alias(_settles(r)) for r in rules if r.header_types is not None]
    return complete.groupBy(*keys).agg(*flags) if flags else complete.select(*keys).distinct()


def missed(candidates: DataFrame, txn: DataFrame, rules=DEFAULT_RULES,
           header_txn: DataFrame | None = None) -> DataFrame:
    """Candidates (with ``memberid`` and ``kind``) that no loyalty transaction covers.

    ``header_txn`` may be a pruned subset of ``txn`` for the header match (e.g.
    only the candidates' transaction days); the original-transaction match
    always uses ``txn`` (an original sale can be from any day)."""
    return without_original(without_header(candidates, header_txn if header_txn is not None else txn, rules), txn, rules)


def without_header(candidates: DataFrame, txn: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """Candidates that no transaction has the header keys of."""
    t = header_keys(txn, rules)
    own = {"amount_real": real_key(amount_real("itm_amount"))}  # made where it is compared, not carried
    cond = reduce(lambda a, b: a & b, [own.get(cc, F.col(cc)) == F.col(f"_t_{tc}") for cc, tc in HEADER_KEYS])
    pred = _type_predicate(rules, F.col("kind"))
    if pred is not None:
        cond = cond & pred
    return candidates.join(t, cond, "left_anti")


def without_original(candidates: DataFrame, txn: DataFrame, rules=DEFAULT_RULES, staged: bool = False) -> DataFrame:
    """Candidates whose original line no transaction settles.  Lines of a kind without such a rule, or that name no original, have
    none: where the candidates are ``staged``, so that to read them twice costs little, these pass the join by."""
    with_orig = [r for r in rules if r.original_types]
    if not with_orig:
        return candidates
    all_types = sorted({ty for r in with_orig for ty in r.original_types})
    # one row per (transaction, kind it can settle); a type may serve several kinds
    kinds_of_type = F.filter(
        F.array(*[F.when(F.col("type").isin(list(r.original_types)), F.lit(r.kind)) for r in with_orig]),
        lambda x: x.isNotNull())
    t2 = (txn.where(F.col("type").isin(all_types) & F.col("memberid").isNotNull()
                    & F.col("referencenumber").isNotNull())
          .select(F.col("memberid").alias("_o_memberid"),
                  F.col("referencenumber").alias("_o_ref"),
                  F.explode(kinds_of_type).alias("_o_kind"))
          .distinct())  # a reference number that repeats is folded before the shuffle
    cond2 = ((F.col("memberid") == F.col("_o_memberid")) & (F.col("orig_tran_id") == F.col("_o_ref"))
             & (F.col("kind") == F.col("_o_kind")))
    if not staged:
        return candidates.join(t2, cond2, "left_anti")
    named = F.coalesce(F.col("kind").isin([r.kind for r in with_orig]), F.lit(False)) & F.col("orig_tran_id").isNotNull()
    return candidates.where(named).join(t2, cond2, "left_anti").unionByName(candidates.where(~named))
