"""Mixing sources to target weights by entropy balancing.

Of all rates (copies per document) that give each source its target of tokens and leave the mix's token-weighted mean of
log size where the corpus has it, the ones nearest to 1 in relative entropy are exponentially tilted:
``rate = min(CAP, exp(lambda_source + mu * x))`` with x the centred log size.  The convex dual in (lambda, mu) is
solved by Newton steps.  Documents enter as cells (source, size class) with their count and tokens, summed in the map tasks:
the tilt is the same throughout a cell.  A step sums gradient and curvature per source in Spark; as lambda's part
of the Hessian is diagonal, only the four sums that give mu's step come to the driver, and lambda stays a table.

Rates become copies cell by cell: from the largest size class down a source's copies follow the running sum of its
rates, so the error left is about half the smallest document.  In a cell the documents that get one copy more are the first
by a hash of the doc_id; a cell of any size is numbered in parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, written

CAP = 3  # copies of a document at most, and the target of a source in units of its size
CLOSE = 1e-9  # relative error of a target, and step of mu, at which the solution stands
JOINT, ALONE = 20, 80  # steps at most of all unknowns together, then of lambda alone
FAR = 200.0  # |lambda| at most: rates from 1e-87 to CAP
SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text; null: 0."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACES), "")), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """The size with its ten leading bits: exact below 1024, within 0.2% above; under 600 classes a doubling from there on."""
    unit = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))) - 9, F.lit(0))).cast("long")
    return size - size % unit


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``at``: 0, 1, ... by code point of ``source``, null last.  Sorted in ranges, numbered inside each and moved by
    the counts of the ranges before, so any number of sources spreads over many tasks."""
    order = F.col("source").asc_nulls_last()
    ranges = written(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "source-ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return ranges.withColumn("inside", inside).join(starts, "range").select("source", "source_size", (F.col("start") + F.col("inside") - 1).cast("long").alias("at"))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, at, target) from (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; together they get the sum of all sizes by weight.  A source stops at
    CAP times its size and what is over is shared by weight among the others, until none is above.  The level that a unit of
    weight gets is raised round by round, each round one sum over the sources, until no further source stops.
    """
    s = ranked_sources(sources).withColumn("weight", (F.col("at") % 3 + 1).cast("double")).withColumn("cap", (F.col("source_size") * CAP).cast("double"))
    s = written(s.withColumn("stop", F.col("cap") / F.col("weight")), "weights")
    level, stopped = -1.0, -1
    while True:
        over = F.col("stop") <= F.lit(level)
        n, left, weights = s.agg(F.count(F.when(over, 1)), F.sum("source_size") - F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                                 F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == stopped or not weights:
            break
        stopped, level = n, left / weights
    return s.select("source", "source_size", "at", F.least("cap", F.col("weight") * F.lit(max(level, 0.0))).alias("target"))


def solve(cells: DataFrame, wanted: DataFrame) -> tuple[DataFrame, float]:
    """(at, target, lam) and mu.  ``cells``: at, class, n, tokens, x; ``wanted``: at, source_size, target, positive ones only.

    Sources that take CAP copies of everything have no lambda to find (rate CAP throughout).  Newton steps in all unknowns, cut to
    1 in each, run until mu rests, or for JOINT steps.  From then on lambda moves alone, and a source's tokens are one growing
    function of its lambda: a Newton step that leaves the bracket found for the root so far gives way to the bracket's middle, so
    every source comes within CLOSE of its target whatever mu has reached; if one does not in ALONE steps, the job stops.
    """
    full = F.col("target") >= F.col("source_size") * (CAP - CLOSE)
    lam = F.when(full, F.lit(1e4)).otherwise(F.log(F.col("target") / F.col("source_size")))
    state = written(wanted.select("at", "target", lam.alias("lam"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")), "lambda")
    mu, rests = 0.0, False
    for step in range(JOINT + ALONE):
        tilted = F.least(F.lit(float(CAP)), F.exp(F.least(F.col("lam") + F.lit(mu) * F.col("x"), F.lit(60.0)))) * F.col("tokens")
        rows = cells.join(state, "at").withColumn("t", tilted).withColumn("free", F.when(F.col("t") < F.col("tokens") * CAP, F.col("t")).otherwise(0.0))
        sums = written(rows.groupBy("at", "target", "lam", "low", "high").agg(
            (F.sum("t") - F.first("target")).alias("g"), F.sum("free").alias("ss"), F.sum(F.col("free") * F.col("x")).alias("sm"),
            F.sum(F.col("t") * F.col("x")).alias("gm"), F.sum(F.col("free") * F.col("x") * F.col("x")).alias("mm")), "newton")
        some = F.col("ss") > 0
        gm, mm, through, curve, off = sums.agg(
            F.sum("gm"), F.sum("mm"), F.sum(F.when(some, F.col("sm") * F.col("g") / F.col("ss"))), F.sum(F.when(some, F.col("sm") ** 2 / F.col("ss"))),
            F.max(F.abs("g") / F.col("target"))).first()
        off, schur = off or 0.0, (mm or 0.0) - (curve or 0.0)
        lead = not rests and step < JOINT and schur > 1e-9 * max(mm or 0.0, 1e-300)
        move = max(-1.0, min(1.0, -((gm or 0.0) - (through or 0.0)) / schur)) if lead else 0.0
        if off < CLOSE and abs(move) < CLOSE:
            return state.select("at", "target", "lam"), mu
        rests = abs(move) < CLOSE
        if rests:
            low, high = F.when(F.col("g") < 0, F.col("lam")).otherwise(F.col("low")), F.when(F.col("g") > 0, F.col("lam")).otherwise(F.col("high"))
            newton = F.col("lam") - F.col("g") / F.col("ss")
            turned = F.when(some & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
            turned = F.when(F.abs("g") < CLOSE * F.col("target"), F.col("lam")).otherwise(turned)
            state = sums.select("at", "target", turned.alias("lam"), low.alias("low"), high.alias("high"))
        else:
            turn = F.when(some, -(F.col("g") + F.col("sm") * F.lit(move)) / F.col("ss")).otherwise(F.lit(0.0))
            state = sums.select("at", "target", (F.col("lam") + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), turn))).alias("lam"), "low", "high")
            mu += move
        state = written(state, "lambda")
    raise RuntimeError(f"a source is {off:.3g} of its target away after {JOINT + ALONE} steps")


def round_source(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies in all (``copies``) of each size class of one source; at most some ten thousand classes."""
    cells = cells.sort_values("class", ascending=False, ignore_index=True)
    n, tokens, rate, target = cells["n"].to_numpy(), cells["tokens"].to_numpy(float), cells["rate"].to_numpy(float), float(cells["target"].iloc[0])
    got = float((rate * tokens).sum())
    rate = np.minimum(rate * (target / got if got > 0 else 0.0), CAP)
    each, copies, want, taken = tokens / n, np.zeros(len(n), np.int64), 0.0, 0.0
    for c in range(len(n)):
        want += rate[c] * tokens[c]
        lowest, most = math.floor(rate[c] + 1e-9) * n[c], math.ceil(rate[c] - 1e-9) * n[c]
        copies[c] = min(max(round((want - taken) / each[c]), lowest), most) if each[c] else 0
        taken += copies[c] * each[c]
    for c in range(len(n)):  # what the bounds above have left over
        if each[c]:
            more = min(max(round((target - taken) / each[c]), -int(copies[c])), CAP * int(n[c]) - int(copies[c]))
            copies[c] += more
            taken += more * each[c]
    return pd.DataFrame({"at": cells["at"], "class": cells["class"], "copies": copies, "n": n})


def mix(docs: DataFrame) -> DataFrame:
    """Copies of each row of ``docs`` (doc_id, text, source; others are left out) in the mix.

    Columns: doc_id, mark (hash of the row), source, size (words; null text: 0), source_size, target, copies (0 to CAP) and
    taken (copies * size).  One row per input row; repeated rows are documents of their own.  Rows without words take
    nothing.  A null source is the last source.  An empty table gives an empty result.  Reruns agree.
    """
    mark = F.xxhash64(F.col("doc_id"), F.col("text"), F.col("source"))
    slim = written(docs.select("doc_id", mark.alias("mark"), "source", word_count(F.col("text")).alias("size")).withColumn("class", size_class(F.col("size"))), "sizes")
    sources = written(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    named = sources.withColumnRenamed("source", "s")
    placed = slim.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    x = F.log1p(F.col("class").cast("double"))
    cells = placed.where("size > 0").groupBy("at", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"))
    cells = written(cells, "cells")
    mean = cells.agg(F.sum(F.col("tokens") * x) / F.sum("tokens")).first()[0] or 0.0
    cells = cells.withColumn("x", x - F.lit(mean))
    state, mu = solve(cells, sources.where("target > 0"))
    rate = F.least(F.lit(float(CAP)), F.exp(F.least(F.col("lam") + F.lit(mu) * F.col("x"), F.lit(60.0))))
    copies = written(cells.join(state, "at").withColumn("rate", rate).select("at", "class", "n", "tokens", "rate", "target")
                     .groupBy("at").applyInPandas(round_source, "at long, class long, copies long, n long"), "copies")
    ranked = numbered(slim.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s"), ["at", "class"], [F.xxhash64("doc_id"), F.col("doc_id"), F.col("mark")], "rank", 64)
    given = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("rank") < F.col("copies") % F.col("n"), 1).otherwise(0)
    return ranked.join(copies, ["at", "class"], "left").withColumn("copies", F.coalesce(given, F.lit(0)).cast("int")).select(
        "doc_id", "mark", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
