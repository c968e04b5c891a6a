"""Helpers shared by the operators: shared work folder, written tables, gapless numbering, word hashing."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a one-process ``local`` session may go without the setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and (current := spark.sparkContext.getCheckpointDir()):
        root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyspark-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tallyspark-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, and a lost
    executor costs a reread, not a recomputation.  The size of the files is known to the planner."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str, pieces: int = 256) -> DataFrame:
    """Add the long column ``name``: 0, 1, 2 ... within each group of ``keys`` (non-null columns), without a gap.

    Each group is dealt over ``pieces`` parts by a hash of ``order``, counted, and numbered part by
    part behind the counts of the parts before, so a group of any size spreads over many tasks.
    ``df`` is read twice: pass a written table.  Rows equal in ``order`` get neighbouring numbers.
    """
    cut = df.withColumn("__piece", F.pmod(F.xxhash64(*order), F.lit(pieces)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    inside = Window.partitionBy(*keys, "__piece").orderBy(*order)
    return (cut.withColumn("__at", F.row_number().over(inside)).join(starts, [*keys, "__piece"])
            .withColumn(name, (F.col("__start") + F.col("__at") - 1).cast("long")).drop("__piece", "__at", "__start"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (xor-shift and multiply), so that all its bits depend on all of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each window of ``width`` consecutive word hashes (len(h) >= width)."""
    n, out = len(h) - width + 1, np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i:i + n]
    return mixed(out)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


_random = np.random.default_rng(77003)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95  # odd, so its powers can be undone modulo 2**64
SEGMENT = 1 << 18


class Hasher:
    """64-bit hashes of byte ranges: polynomials in the bytes' random codes, got from prefix sums modulo 2**64."""

    def __init__(self):
        self.power = self.undo = np.zeros(0, np.uint64)

    def ranges(self, a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the ranges a[start:end], in ascending order without overlap; about SEGMENT bytes at a time."""
        out, i = np.zeros(len(starts), np.uint64), 0
        while i < len(starts):
            base = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, side="right")))
            part = a[base:ends[j - 1]]
            if len(part) >= len(self.power):
                powers = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(part), x, np.uint64)]))
                self.power, self.undo = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[part] * self.power[:len(part)])])
            first = starts[i:j] - base
            out[i:j] = (sums[ends[i:j] - base] - sums[first]) * self.undo[first]
            i = j
        return mixed(out + (ends - starts).astype(np.uint64))

    def words(self, texts: list[bytes]) -> list[np.ndarray]:
        """Hashes of the words (runs of bytes other than 0x20 and 0x09 to 0x0D) of each text, in order."""
        if not texts:
            return []
        a = np.frombuffer(b"\n".join(texts), np.uint8)
        edges = np.flatnonzero(np.diff(_SPACE[a].view(np.int8), prepend=np.int8(1), append=np.int8(1)))
        starts, ends = edges[0::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return np.split(self.ranges(a, starts, ends), np.searchsorted(starts, np.cumsum(lengths)[:-1]))


def text_blocks(column: pa.Array, size: int = 1 << 20):
    """Runs (i, j, texts) of a string column: its rows i to j as UTF-8, about ``size`` bytes and whole texts.  Only one run's
    texts exist at a time."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, i = np.cumsum(lengths), 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - lengths[i] + size, side="right")))
        yield i, j, [utf8(t.as_py()) for t in column.slice(i, j - i)]
        i = j


def gather(flat: np.ndarray, start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """flat[start:start + width] of every range, one after the other."""
    ends = np.cumsum(width)
    return flat[np.repeat(start - (ends - width), width) + np.arange(int(ends[-1]) if len(ends) else 0)]
