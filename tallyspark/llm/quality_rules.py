"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

1. ``measure`` counts, in one pass over the whole texts, what the rules look at.
2. ``sketch`` puts each ratio into logarithmic bins (relative error ``ERROR``) and counts the bins of each
   (lang, source): a mergeable sketch, since sketches merge by adding counts.  Spark adds them in the map
   tasks already, so a source with a third of all rows costs no more than any other.
   Only documents that the base rules keep are sketched, so the short and the repetitive set no limit.
3. ``thresholds`` reads quantiles from the sketches.  A source with under ``LEAST`` sketched documents of a language
   takes the merged sketch of that language, a language with under ``LEAST`` the merged sketch of all.  The limits lie
   off the quartiles by the spread, and the spread is at least the mean spread inside the sources of the language (of all
   sources if the language has under ``LEAST``), which differences between sources do not widen.
4. ``judge`` joins the thresholds to the documents and compares.  What a document of n words, lines or characters has over a
   limit by chance alone (``CHANCE`` standard deviations of a count) is no failure.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import Hasher, text_blocks, windows, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_same"]
SYMBOLS = b"#*$%&|<>"
WIDTH = 8  # words of a window
ERROR = 0.01
LEAST = 50
FENCE = 5.0  # spreads between a quartile and the limit
CHANCE = 3.0
#: ratio -> (upper quantile of the least spread, what the ratio counts by, sides).  The spread is q75 - q25.  Where the quantile is
#: above 0.75 the least FENCE * spread is ``REACH`` times its mean distance from the sources' medians, if that is more: clean
#: texts with a refrain, a quoted passage or numbers are rare, so that both quartiles of these ratios are 0.  (In a source of under 100 documents that quantile is the largest.)
RULES = {
    "symbols": (0.75, "n_words", "high"),
    "repeats": (0.99, "n_words", "high"),
    "lines": (0.99, "n_lines", "high"),
    "runs": (0.75, "n_words", "high"),
    "upper": (0.75, "word_chars", "high"),
    "digits": (0.99, "word_chars", "high"),
    "length": (0.75, None, "both"),
}
REACH = 3.0
UNIT = {"repeats": WIDTH}  # words that count as one, as they repeat by windows


def count_text(raw: bytes, h: np.ndarray) -> tuple[int, ...]:
    """The COUNTS of one UTF-8 text with the word hashes ``h``.  A word is a run of bytes other than 0x20 and 0x09 to 0x0D."""
    n = len(h)
    if not n:
        return (0,) * len(COUNTS)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(raw) - int(by[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = 0
    if n > WIDTH:
        w = windows(h, WIDTH)
        order = np.argsort(w, kind="stable")
        same = w[order[1:]] == w[order[:-1]]
        if same.any():
            twice = np.zeros(len(w), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            step = np.zeros(n + 1, np.int64)
            step[:len(w)] += twice
            step[WIDTH:WIDTH + len(w)] -= twice
            repeats = int((np.cumsum(step)[:n] > 0).sum())
    return (n, chars - int(by[9:14].sum()) - int(by[32]), int(sum(by[c] for c in SYMBOLS)), len(lines) - len(set(lines)), repeats,
            len(lines), int(by[65:91].sum()), int(by[48:58].sum()), int((h[1:] == h[:-1]).sum()))


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and the COUNTS (long) of the whole ``text`` (null or without words: all 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            rows = [count_text(t, h) for _, _, texts in text_blocks(batch.column(len(keep))) for t, h in zip(texts, hasher.words(texts), strict=True)]
            counted = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(counted[:, i]) for i in range(len(COUNTS)))], [*keep, *COUNTS])

    schema: StructType = docs.select(*keep).schema
    for name in COUNTS:
        schema = schema.add(name, LongType())
    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def ratios() -> dict[str, Column]:
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words, "repeats": F.col("n_repeat_words") / words,
        "lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), "runs": F.col("n_same") / words, "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars, "length": F.col("word_chars") / words,
    }


_GAMMA = (1 + ERROR) / (1 - ERROR)
_ZERO_BIN = -100_000  # of ratios below 1e-9


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bin, n): bin b counts the ratios in (gamma**(b-1), gamma**b], documents that the base rules keep only."""
    pairs = F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ratio")) for k, v in ratios().items()])
    return (measured.where(~base_failed()).select("lang", "source", F.explode(pairs).alias("x"))
            .select("lang", "source", F.col("x.rule").alias("rule"), F.when(F.col("x.ratio") < 1e-9, F.lit(_ZERO_BIN)).otherwise(
                F.ceil(F.log("x.ratio") / F.lit(math.log(_GAMMA)))).cast("int").alias("bin"))
            .groupBy("lang", "source", "rule", "bin").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, total, q25, q50, q75, tail: the quantile of RULES) of the sketches merged by ``keys``; a group has as
    many rows as filled bins."""
    by = [*keys, "rule"]
    merged = sketches.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col("bin") == _ZERO_BIN, F.lit(0.0)).otherwise(2 * F.pow(F.lit(_GAMMA), F.col("bin")) / (_GAMMA + 1))
    seen = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*by))).withColumn("value", value)
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("value")))
    reached = F.coalesce(F.create_map(*[F.lit(x) for r, (q, _, _) in RULES.items() for x in (r, q)])[F.col("rule")], F.lit(0.75))
    return seen.groupBy(*by).agg(F.max("total").alias("total"), *[at(F.lit(q)).alias(f"q{q * 100:.0f}") for q in (0.25, 0.5, 0.75)], at(reached).alias("tail"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source) sketched: low_<rule> and high_<rule>, null where a side has no limit."""
    fields = F.struct("total", "q25", "q50", "q75")
    spread = F.col("q75") - F.col("q25")
    own = quartiles(sketches, ["lang", "source"])
    mean = lambda x: F.sum(F.col("total") * x) / F.sum("total")  # noqa: E731  of the sources, each by its documents
    inside = F.greatest(mean(spread) * FENCE, F.when(F.max(F.col("tail") - F.col("q75")) > 0, mean(F.col("tail") - F.col("q50")) * REACH))
    lang = (quartiles(sketches, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("rule").alias("l_rule"), fields.alias("l"))
            .join(own.groupBy(F.col("lang").alias("i_lang"), F.col("rule").alias("i_rule")).agg(inside.alias("l_inside")),
                  F.col("l_lang").eqNullSafe(F.col("i_lang")) & (F.col("l_rule") == F.col("i_rule"))))
    every = (quartiles(sketches, []).select(F.col("rule").alias("e_rule"), fields.alias("e"))
             .join(own.groupBy(F.col("rule").alias("j_rule")).agg(inside.alias("e_inside")), F.col("e_rule") == F.col("j_rule")))
    joined = (own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rule") == F.col("l_rule")))
              .join(every, F.col("rule") == F.col("e_rule")))
    q = F.when(F.col("total") >= LEAST, fields).when(F.col("l.total") >= LEAST, F.col("l")).otherwise(F.col("e"))
    least = F.when(F.col("l.total") >= LEAST, F.col("l_inside")).otherwise(F.col("e_inside"))
    limits = joined.select("lang", "source", "rule", q.alias("q"), least.alias("least")).select("lang", "source", "rule", "least", "q.*")
    off = F.greatest(spread * FENCE, F.col("least"))
    pick = lambda r, limit: F.max(F.when(F.col("rule") == r, limit))
    return limits.groupBy("lang", "source").agg(
        *[pick(r, F.col("q75") + off).alias(f"high_{r}") for r in RULES], *[pick(r, F.col("q25") - off).alias(f"low_{r}") for r in RULES if RULES[r][2] == "both"])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with base_failed, failed_rules (names, sorted) and kept.  A document of a (lang, source) without
    limits has failed the base rules."""
    named = limits.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = measured.join(named, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    checks = []
    for rule, ratio in ratios().items():
        high, of = F.col(f"high_{rule}"), RULES[rule][1]
        if of:
            n = F.greatest(F.col(of), F.lit(1)) / UNIT.get(rule, 1)
            high = high + CHANCE * F.sqrt(high / n) + CHANCE**2 / n
        bad = ratio > high
        if RULES[rule][2] == "both":
            bad = bad | (ratio < F.col(f"low_{rule}"))
        checks.append(F.when((F.col("n_words") > 0) & bad, F.lit(rule)))
    return (joined.withColumn("base_failed", base_failed()).withColumn("failed_rules", F.array_sort(F.array_compact(F.array(*checks))))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .select(*measured.columns, "base_failed", "failed_rules", "kept"))


def quality_rules(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Verdict on each row of ``docs`` (doc_id, text, lang, source; others are left out unless named in ``keep``).

    Columns: doc_id, lang, source, the COUNTS, base_failed, failed_rules, kept.  A null text has no words and
    fails the base; null lang or source form groups of their own; repeated rows are judged alike, each counts
    in the sketches; an empty table gives an empty result.
    """
    measured = written(measure(docs, keep or ["doc_id", "lang", "source"]), "measured")
    limits = written(thresholds(sketch(measured)), "limits")
    return judge(measured, limits)
