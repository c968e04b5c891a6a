"""POS reconciliation as lazy plans over the input tables.

``ReconcileInputs`` bundles the five inputs; every function returns a lazy
DataFrame so Catalyst sees one plan per action (filters on ``kind`` are pushed
into the candidate scan, the lookups are folded once).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import fixtures as FX
from tallyspark import schemas as S
from tallyspark.files import Files
from tallyspark.functions import pack, tran_kind, unpack
from tallyspark.operators.delta import new_lines
from tallyspark.operators.reconcile import CARRIED, DEFAULT_RULES, missed, resolved_candidates, with_kind, without_header, without_original
from tallyspark.operators.resolve import SALT, salted
from tallyspark.sinks import write_overwrite

# Fixed value: example operating limit of the source job (strict "<" passes).
DEFAULT_THRESHOLD = 10000


@dataclass
class ReconcileInputs:
    batch: DataFrame
    history: DataFrame
    member: DataFrame
    alt: DataFrame
    txn: DataFrame

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "ReconcileInputs":
        return cls(FX.pos_lines(spark, sf_dir), FX.pos_lines_history(spark, sf_dir),
                   FX.member(spark, sf_dir), FX.member_alt_id(spark, sf_dir),
                   FX.loyalty_txn(spark, sf_dir))


def new_batch_lines(inp: ReconcileInputs, kinds: list[str] | None = None) -> DataFrame:
    """New lines, of the given kinds only: equal lines are of one kind, so the filter may go first, on both sides."""
    batch, history = inp.batch, inp.history
    if kinds is not None:
        batch, history = with_kind(batch, kinds), with_kind(history, kinds)
    return new_lines(batch, history, cols=S.POS_COLUMNS)


def lines_to_resolve(inp: ReconcileInputs, kinds: list[str]) -> DataFrame:
    """New lines with a loyalty id, by loyalty id: the difference and the member join share one shuffle of the lines.  Equal lines
    have equal ids, so lines without one may go first, on both sides."""
    batch, history = (salted(with_kind(side, kinds).where(F.col("hd_loyalty_id").isNotNull())) for side in (inp.batch, inp.history))
    return new_lines(batch, history, cols=[*S.POS_COLUMNS, SALT], near=["hd_loyalty_id", SALT])


def candidates(inp: ReconcileInputs, rules=DEFAULT_RULES, new: DataFrame | None = None) -> DataFrame:
    new = new if new is not None else lines_to_resolve(inp, [r.kind for r in rules])
    return resolved_candidates(new, inp.member, inp.alt, rules)


def missed_with_kind(inp: ReconcileInputs, rules=DEFAULT_RULES, new: DataFrame | None = None) -> DataFrame:
    return missed(candidates(inp, rules, new), inp.txn, rules)


def missed_in_steps(lines: DataFrame, member: DataFrame, alt: DataFrame, txn: DataFrame, work: str, rules=DEFAULT_RULES, strict_ts: bool = True,
                    header_txn: DataFrame | None = None) -> DataFrame:
    """``missed`` over new lines (with ``kind``), found in steps: the resolved candidates and what the header match leaves are written
    below ``work``, so the shuffle files of one join at a time lie on disk.  The caller removes ``work`` after use.  Columns that no rule looks at are
    carried as one text."""
    spark = lines.sparkSession
    slim = lines.select(*[c for c in lines.columns if c not in CARRIED], pack(CARRIED).alias("_carried"))

    def staged(df: DataFrame, name: str) -> DataFrame:
        write_overwrite(df, f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    cands = staged(resolved_candidates(slim, member, alt, rules, strict_ts, keep=("_carried",)), "candidates")
    left = staged(without_header(cands, header_txn if header_txn is not None else txn, rules), "no_header")
    Files(spark).delete(f"{work}/candidates")
    found = without_original(left, txn, rules, staged=True)
    return unpack(found, "_carried", CARRIED, *[c for c in S.MISSED_COLUMNS if c not in CARRIED], "kind")


def missed_lines(inp: ReconcileInputs, kind: str | None = None, rules=DEFAULT_RULES,
                 new: DataFrame | None = None) -> DataFrame:
    """Missed lines in the 21-column layout, for one kind or all.

    For one kind only that kind's rule is planned: a SALE-only run has no
    original-transaction join at all."""
    if kind is not None:
        rules = tuple(r for r in rules if r.kind == kind)
    return missed_with_kind(inp, rules, new).select(*S.MISSED_COLUMNS)


def missed_by_kind(missed_df: DataFrame) -> DataFrame:
    """Rows per branch (the per-statement insert counts of the source job)."""
    return (missed_df.groupBy(tran_kind("tran_id").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def gate(missed_df: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: missed count, threshold, passed (strict ``<``), non-empty."""
    return (missed_df.agg(F.count(F.lit(1)).alias("missed"))
            .select("missed", F.lit(threshold).cast("bigint").alias("threshold"),
                    (F.col("missed") < threshold).alias("passed"),
                    (F.col("missed") > 0).alias("non_empty")))
