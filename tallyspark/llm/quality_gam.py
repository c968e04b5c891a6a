"""Quality classifier: an additive model with pairwise terms, learnt by cyclic boosting of shallow trees.

The model is a table per feature (a value per bin) and a table per chosen pair of features; a score is the sum of the
looked-up values through the logistic function.  Learning goes round the features; each step fits a tree of at most four
leaves to the gradients summed by bin, and adds it, shrunk, to the feature's table.  Then the pairs whose best
quartering still lowers the loss most get tables in the same way.

The model is fitted on the driver to a sample of about ``BOUND`` labelled documents (their features alone, chosen by a hash of
the doc_id); scoring runs in the tasks over all documents.  doc_id, lang, source and the labels are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hasher, text_blocks
from .quality_rules import COUNTS, count_text

BOUND = 20_000  # labelled documents to learn from
FEATURES = ["log_words", "word_length", "symbols", "upper", "digits", "shouts", "distinct", "same", "repeats", "dup_lines", "line_words", "high_bytes", "stops", "top_word"]
BINS, ROUNDS, RATE, SMOOTH = 48, 120, 0.1, 4.0
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 12, 60
THRESHOLD = 0.3


def features_of(raw: bytes, h: np.ndarray) -> tuple[float, ...]:
    """Features of one whole text; all 0 without words."""
    n = len(h)
    if not n:
        return (0.0,) * len(FEATURES)
    c = dict(zip(COUNTS, count_text(raw, h), strict=True))
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    runs = np.flatnonzero(np.diff(np.sort(h), prepend=np.uint64(0), append=np.uint64(0)) != 0)
    own = np.diff(runs) if len(runs) > 1 else np.array([n])
    chars = max(1, c["word_chars"])
    return (np.log1p(n), c["word_chars"] / n, c["n_symbols"] / n, c["n_upper"] / chars, c["n_digits"] / chars, by[33] / n, len(own) / n, c["n_same"] / n,
            c["n_repeat_words"] / n, c["n_dup_lines"] / max(1, c["n_lines"]), np.log1p(n / max(1, c["n_lines"])), by[128:].sum() / len(raw),
            (by[44] + by[46]) / n, own.max() / n)


def featured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``features`` array<double> of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            x = feature_matrix(batch.column(len(keep)), hasher)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(list(x), pa.list_(pa.float64()))], [*keep, "features"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "features array<double>"])
    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def feature_matrix(column: pa.Array, hasher: Hasher) -> np.ndarray:
    rows = [features_of(t, h) for _, _, texts in text_blocks(column) for t, h in zip(texts, hasher.words(texts), strict=True)]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


# -- the model ------------------------------------------------------------------------------------------------------


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of bins with summed gradients g and second derivatives h; (0, 0) for none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + SMOOTH) + gr**2 / (hr + SMOOTH) - g.sum() ** 2 / (h.sum() + SMOOTH)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value of each bin under a tree of depth 2 over the ordered bins."""
    out, (gain, at) = np.zeros(len(g)), best_cut(g, h)
    parts = [(0, at), (at, len(g))] if gain > 1e-9 else [(0, len(g))]
    for a, b in parts:
        gain, cut = best_cut(g[a:b], h[a:b])
        for x, y in [(a, a + cut), (a + cut, b)] if gain > 1e-9 else [(a, b)]:
            out[x:y] = -g[x:y].sum() / (h[x:y].sum() + SMOOTH)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree over a grid: one cut along the first feature, then one along the second on each side."""
    out, total = np.zeros(g.shape), 0.0
    gain, at = best_cut(g.sum(axis=1), h.sum(axis=1))
    best = (-1.0, at)
    for cut in range(1, len(g)):  # the cut that makes the later ones most worth while
        now = sum(best_cut(g[a:b].sum(axis=0), h[a:b].sum(axis=0))[0] for a, b in ((0, cut), (cut, len(g))))
        best = max(best, (now, cut))
    cut = best[1]
    for a, b in ((0, cut), (cut, len(g))):
        gain, c = best_cut(g[a:b].sum(axis=0), h[a:b].sum(axis=0))
        total += gain
        for x, y in ((0, c), (c, g.shape[1])):
            if y > x:
                out[a:b, x:y] = -g[a:b, x:y].sum() / (h[a:b, x:y].sum() + SMOOTH)
    return total, out


class Gam:
    """Bin edges, tables by feature, tables by pair and the intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
        self.pair_edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
        self.tables, self.pairs, self.pair_tables = [np.zeros(len(e) + 1) for e in self.edges], [], []
        share = np.clip(y.mean() if n else 0.5, 0.001, 0.999)
        self.intercept = float(np.log(share / (1 - share)))
        if n and 0 < y.sum() < n:
            self.fit(x, y)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        bins, score = self.bins(x, self.edges), np.full(len(y), self.intercept)

        def gradients() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return p - y, p * (1 - p)

        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, h = gradients()
                k = len(self.tables[f])
                step = RATE * shallow_tree(np.bincount(b, g, k), np.bincount(b, h, k))
                self.tables[f] += step
                score += step[b]
        coarse = self.bins(x, self.pair_edges)
        g, h = gradients()
        size = [len(e) + 1 for e in self.pair_edges]
        grid = lambda i, j, w: np.bincount(coarse[i] * size[j] + coarse[j], w, size[i] * size[j]).reshape(size[i], size[j])
        gains = sorted(((pair_tree(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(x.shape[1]) for j in range(x.shape[1]) if i < j), reverse=True)
        self.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
        self.pair_tables = [np.zeros((size[i], size[j])) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (i, j) in enumerate(self.pairs):
                g, h = gradients()
                step = RATE * pair_tree(grid(i, j, g), grid(i, j, h))[1]
                self.pair_tables[k] += step
                score += step[coarse[i], coarse[j]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self.bins(x, self.edges), strict=True):
            total += table[b]
        coarse = self.bins(x, self.pair_edges)
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


# -- Spark ----------------------------------------------------------------------------------------------------------


def held_out() -> Column:
    """Rows whose labels are never learnt from: crc32 of the doc_id as text divisible by 5, and rows without a doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Gam:
    """A model of ``labels`` (doc_id, quality 0 or 1), those not held out, joined to ``docs`` (doc_id, text).

    A labelled doc_id counts once, however many rows it has: of several texts the least by a hash stands for it.  So at most about
    ``bound`` rows of features come to the driver.  Other quality values are passed over; a document with several labels takes their majority, 1 if they tie.  Without
    both labels every document scores the share of label 1 (0.5 without any).
    """
    usable = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.round(F.avg("quality")).cast("double").alias("__label"))
    share = min(1.0, bound / max(1, usable.count()))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # about ``bound`` rows of two numbers
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("__label").alias("__label"))  # folded before the shuffle
    rows = featured(texts, ["doc_id", "__label"]).toArrow()
    x = np.array(rows.column("features").to_pylist(), np.float64).reshape(rows.num_rows, len(FEATURES))
    order = np.lexsort([*x.T, rows.column("doc_id").to_numpy()])
    return Gam(x[order], rows.column("__label").to_numpy()[order])


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from THRESHOLD on) of each row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            p = model.scores(feature_matrix(batch.column(2), hasher))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(p)], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Gam) -> DataFrame:
    """The rows of ``docs``, all columns, that the model predicts to be of label 1; no join, no shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            p = model.scores(feature_matrix(batch.column(at), hasher))
            yield batch.filter(pa.array(p >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
