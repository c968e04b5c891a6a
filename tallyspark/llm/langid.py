"""Language identification: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text's subwords are the runs of 1 to LONGEST bytes inside a word of its lower-cased letters (a space before and behind
a word counts as part of it), and its whole words.  Each is hashed to one of BUCKETS rows of an embedding table; the text is the
average of its subwords' rows, and a linear layer with a softmax gives the languages' probabilities.  Table and layer are
trained together by stochastic gradient descent in numpy, one text a step, on the driver, with at most about PER_LANGUAGE distinct
texts of each language (their bucket counts alone come from the tasks).

A fifth of these texts is kept out of the descent: on it the softmax is calibrated (one temperature), and then the least
probability is found from which on at most MAX_ERROR of the accepted texts are wrong; texts below it are rejected.

Scoring runs in the tasks over whole texts.  As averaging and the layer are both linear, the layer is applied to the table once
and a text sums a few numbers a subword.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed, text_blocks

PER_LANGUAGE = 500  # distinct texts of a language to learn from
BUCKETS, WIDTH, LONGEST = 1 << 15, 16, 5
EPOCHS, RATE, MAX_ERROR = 8, 0.4, 0.01
UNKNOWN = "und"
_random = np.random.default_rng(41)
_CODE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile("(?:[^\\W\\d_]|[\u0300-\u036f])+")  # letters and their combining accents
PIECE = 1 << 18  # characters of a text looked at together


def pieces(text: str) -> Iterator[str]:
    """The words of a text in lower case, one space before, between and behind them, in runs of about PIECE characters.

    No subword reaches over a space inside it, so the runs' subwords are the text's."""
    words, size = [], 0
    for m in _WORD.finditer(text.lower()):
        words.append(m[0])
        size += len(m[0]) + 1
        if size >= PIECE:
            yield f" {' '.join(words)} "
            words, size = [], 0
    if words:
        yield f" {' '.join(words)} "


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subwords(runs: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, run) of the subwords of runs made by ``pieces``, length by length and then the whole words; runs ascend."""
    raw = [t.encode("utf-8", "surrogatepass") for t in runs]
    a = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)), np.fromiter(map(len, raw), np.int64, len(raw)))
    space, codes = a == 32, _CODE[a]
    h, inner = np.zeros(len(a), np.uint64), np.zeros(len(a), bool)
    for n in range(1, min(LONGEST, len(a)) + 1):
        m = len(a) - n + 1
        h = h[:m] * _STEP + codes[n - 1:]
        inner = inner[:m] | space[n - 2:n - 2 + m] if n > 2 else inner[:m]  # a space that is neither first nor last
        good = ~inner & (owner[:m] == owner[n - 1:])
        at = np.flatnonzero(good & ~space if n == 1 else good)
        yield (mixed(h[at] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64), owner[at]
    places = np.flatnonzero(space)
    first, last = places[:-1] + 1, places[1:]
    words = last > first
    if words.any():
        first, last, index = first[words], last[words], np.arange(len(a))
        inside = (index - np.maximum.accumulate(np.where(space, index, 0)) + 2).astype(np.uint64)
        total = np.add.reduceat(codes * inside, np.column_stack([first, last]).reshape(-1))[0::2]
        yield (mixed(total * _STEP + np.uint64(77)) & np.uint64(BUCKETS - 1)).astype(np.int64), owner[first]


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for run in pieces(text):
        for ids, _ in subwords([run]):
            total += np.bincount(ids, minlength=BUCKETS)
    ids = np.flatnonzero(total)
    return ids, total[ids]


# -- the model ------------------------------------------------------------------------------------------------------


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Languages, embedding table, linear layer, temperature and least accepted probability."""

    def __init__(self, languages: list[str], seed: int = 5):
        r = np.random.default_rng(seed)
        self.languages = languages
        self.table = r.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        self.layer = r.normal(0, WIDTH**-0.5, (WIDTH, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.temperature, self.least = 1.0, 0.0

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 6) -> None:
        """``texts``: distinct buckets and their counts of each text.  The rate falls linearly to 0."""
        r, step, steps = np.random.default_rng(seed), 0, EPOCHS * max(1, len(texts))
        for _ in range(EPOCHS):
            for i in r.permutation(len(texts)):
                rate = np.float32(RATE * (1 - step / steps))
                step += 1
                ids, counts = texts[i]
                if not len(ids):
                    continue
                share = (counts / counts.sum()).astype(np.float32)
                rows = self.table[ids]
                hidden = share @ rows
                wrong = softmax(hidden @ self.layer + self.bias)
                wrong[labels[i]] -= 1
                back = self.layer @ wrong
                self.layer -= rate * np.outer(hidden, wrong)
                self.bias -= rate * np.float32(0.1) * wrong
                # a text has hundreds of subwords, each a small share of the average: their rows move by the share of the largest
                self.table[ids] = rows - rate * (share / share.max())[:, None] * back

    def calibrate(self, logits: np.ndarray, labels: np.ndarray) -> None:
        """The temperature of least loss, then the least probability from which on at most MAX_ERROR of the texts are wrong.

        Targets are smoothed as if one text more were wrong, so that a sample without errors does not make every score 1."""
        n, k = len(labels), len(self.languages)
        if not n or k < 2:
            return
        target = np.full((n, k), 1 / (n + 2) / (k - 1))
        target[np.arange(n), labels] = (n + 1) / (n + 2)
        loss = lambda t: -(target * np.log(np.maximum(softmax(logits / t), 1e-300))).sum()
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        self.temperature = float(grid[int(np.argmin([loss(t) for t in grid]))])
        p = softmax(logits / self.temperature)
        order = np.argsort(-p.max(axis=1), kind="stable")
        wrong = np.cumsum((p.argmax(axis=1) != labels)[order])
        fine = np.flatnonzero(wrong <= MAX_ERROR * np.arange(1, len(order) + 1))
        self.least = float(p.max(axis=1)[order[fine[-1]]]) if len(fine) else 1.0

    def per_bucket(self) -> np.ndarray:
        """Layer times table: what a subword adds to each language's sum, before the average."""
        return (self.table.astype(np.float64) @ self.layer).astype(np.float64)


def logits_of(folded: np.ndarray, bias: np.ndarray, texts: list[str]) -> np.ndarray:
    """Logits of each text from its subwords; the bias alone for a text without any."""
    runs, owner = [], []
    for i, text in enumerate(texts):
        for run in pieces(text):
            runs.append(run)
            owner.append(i)
    out, count = np.zeros((len(texts), folded.shape[1])), np.zeros(len(texts))
    for ids, run in subwords(runs) if runs else ():
        if len(ids):
            starts = np.flatnonzero(np.diff(run, prepend=-1))
            at = np.array(owner)[run[starts]]
            np.add.at(out, at, np.add.reduceat(folded[ids], starts, axis=0))
            np.add.at(count, at, np.diff(np.append(starts, len(ids))))
    return out / np.maximum(count, 1)[:, None] + bias


# -- Spark ----------------------------------------------------------------------------------------------------------


def held_out() -> Column:
    """Rows that are never learnt from: crc32 of the doc_id as text divisible by 5, and rows without a doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of ``docs`` (doc_id, text, lang), learnt from rows with a lang and a letter that are not held out.

    Equal texts of a language count once.  The sample of a language is chosen by a hash of the text; what comes to the driver is a
    row a language, then the distinct buckets of about ``per_language`` texts each.  Without any rows no language is known.
    """
    usable = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & ~held_out()).select(
        "lang", "text", F.xxhash64("text").alias("mark"))
    sizes = {r["lang"]: r["n"] for r in usable.select("lang", "mark").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    model = Model(languages)
    if not languages:
        return model
    unit = 1 << 30
    limits = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(int(unit * min(1.0, per_language / sizes[name]))))])
    chosen = usable.where(F.pmod("mark", F.lit(unit)) < limits[F.col("lang")]).groupBy("lang", "mark").agg(F.min("text").alias("text"))  # folded before the shuffle

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in text_blocks(batch.column(2)):
                found = [bag(t.decode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns[:2], pa.array([f[0] for f in found], pa.list_(pa.int32())),
                                                  pa.array([f[1] for f in found], pa.list_(pa.int32()))], ["lang", "mark", "ids", "counts"])

    rows = chosen.mapInArrow(count, "lang string, mark long, ids array<int>, counts array<int>").toArrow()
    marks, names = rows.column("mark").to_numpy(), rows.column("lang").to_pylist()
    order = sorted(range(rows.num_rows), key=lambda i: (names[i], marks[i]))
    ids, counts = rows.column("ids").combine_chunks(), rows.column("counts").combine_chunks()
    texts = [(ids[i].values.to_numpy(), counts[i].values.to_numpy()) for i in order]
    labels = np.array([languages.index(names[i]) for i in order])
    aside = np.array([(int(marks[i]) >> 31) % 5 == 0 for i in order], bool)  # for the calibration
    learn = np.flatnonzero(~aside)
    model.train([texts[i] for i in learn], labels[learn])
    folded, test = model.per_bucket(), np.flatnonzero(aside)
    logits = np.array([(folded[texts[i][0]] * texts[i][1][:, None]).sum(axis=0) / max(1, texts[i][1].sum()) + model.bias for i in test]).reshape(len(test), len(languages))
    model.calibrate(logits, labels[test])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (calibrated probability, 0 to 1) and rejected (score too low to be trusted) of each row.

    A null text and one without a letter have lang_pred ``und``, score 0 and are rejected, and so has every text if the model knows no
    language.  Repeated rows have equal results; ties go to the first language by name.  An empty table gives an empty result.
    """
    folded, bias = model.per_bucket(), model.bias.astype(np.float64)
    languages, temperature, least = model.languages, model.temperature, model.least
    given = docs.sparkSession.sparkContext.broadcast(folded)  # BUCKETS rows of a number a language
    names = np.array([*languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = np.full(batch.num_rows, len(languages)), np.zeros(batch.num_rows)
            for i, j, texts in text_blocks(batch.column(2), 1 << 18):
                plain = [t.decode("utf-8", "surrogatepass") for t in texts]
                some = np.array([k for k, t in enumerate(plain) if has_letter(t)], np.int64) if languages else np.zeros(0, np.int64)
                if len(some):
                    p = softmax(logits_of(given.value, bias, [plain[k] for k in some]) / temperature)
                    best[i + some], score[i + some] = p.argmax(axis=1), p.max(axis=1)
            known = best < len(languages)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(names[best], pa.string()), pa.array(score), pa.array(~known | (score < least))],
                                             ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
