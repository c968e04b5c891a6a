"""Near-duplicate documents: MinHash minima, banding, verification, alternating large-star and small-star.

1. ``signatures``: a document's set is its distinct ``WORDS``-word shingles (lower-cased A-Z).  MINIMA universal
   hashes x -> a * x + b (mod 2**32) give its minima; each of BANDS bands of ROWS minima becomes one key.  A pair of
   similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 1 - 3e-7 at s = 0.85.  Four bits of each
   of the minima make a sketch of 1536 bits.
2. Documents with equal sets become one class, stood for by one of its rows, before anything is paired.
3. Links in rounds.  In STAR_ROUNDS rounds every class is paired with one component of its buckets, by that component's
   smallest class: as many pairs as classes.  After each round buckets whose classes are all in one component are done;
   a group of near copies has few others.  The last round takes every pair left, that is of different components in
   one bucket.  A pair is dropped only if set sizes or distances known exactly rule it out or the sketch shows a
   similarity over DEVIATIONS standard deviations too low; the others are compared on their full sets.  No cap on buckets.
4. ``components`` alternates large-star and small-star until the links no longer change.  Each round is two
   aggregations with a join on the minima, written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hasher, mixed, text_blocks, windows, written

WORDS = 5
ROWS, BANDS = 6, 32
STAR_ROUNDS = 2
MINIMA = 2 * ROWS * BANDS
SKETCH = [f"s{i}" for i in range(MINIMA // 16)]  # four bits of each of the minima, 16 in a word
DEVIATIONS = 4.5
_LOWEST = 0x1111111111111111
BLOCK = 4096  # nodes of a bucket on either side of one comparison
_random = np.random.default_rng(20240611)
MULTIPLY = (_random.integers(0, 1 << 31, MINIMA, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
ADD = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
CHUNK = 128  # shingles hashed at a time


def shingle_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text's word hashes; with fewer than WORDS words the whole sequence is the one shingle."""
    if not len(h):
        return h
    return np.unique(windows(h, WORDS) if len(h) >= WORDS else mixed(windows(h, len(h)) + np.uint64(len(h))))


def sets_of(column: pa.Array, hasher: Hasher) -> Iterator[np.ndarray]:
    for _, _, texts in text_blocks(column):
        yield from map(shingle_set, hasher.words([t.lower() for t in texts]))  # of bytes: lowers A-Z only


def minima(shingles: np.ndarray) -> np.ndarray:
    x, out = (shingles >> np.uint64(32)).astype(np.uint32), np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    room = np.empty((CHUNK, MINIMA), np.uint32)
    for i in range(0, len(x), CHUNK):
        part = x[i:i + CHUNK, None]
        h = np.multiply(part, MULTIPLY, out=room[:len(part)])
        h += ADD
        np.minimum(out, h.min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low[:ROWS * BANDS].reshape(BANDS, ROWS).T:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + column)
    return h.view(np.int64)


def sketch_bits(low: np.ndarray) -> np.ndarray:
    four = (mixed(low.astype(np.uint64) + np.uint64(1)) & np.uint64(15)).reshape(len(SKETCH), 16)
    return (four << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, mark: hash of the text, n_shingles, h0, h1: digest of the set, bands array<long>, the SKETCH words); a text without
    words has no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, none = Hasher(), np.zeros(0, np.int64)
        for batch in batches:
            n, digest, bands, bits = [], [], [], []
            for own in sets_of(batch.column(2), hasher):
                n.append(len(own))
                digest.append(np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64))
                low = minima(own) if len(own) else None
                bands.append(none if low is None else band_keys(low))
                bits.append(np.zeros(len(SKETCH), np.int64) if low is None else sketch_bits(low))
            ends = np.concatenate([[0], np.cumsum([len(b) for b in bands])])
            digest, bits = np.array(digest, np.int64).reshape(-1, 2), np.array(bits, np.int64).reshape(-1, len(SKETCH))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([none, *bands])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *map(pa.array, digest.T.copy()), lists, *map(pa.array, bits.T.copy())],
                ["doc_id", "mark", "n_shingles", "h0", "h1", "bands", *SKETCH])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id long, mark long, n_shingles long, h0 long, h1 long, bands array<long>, " + ", ".join(f"{x} long" for x in SKETCH))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc, mark, shingles) of ``docs`` (doc, mark, text): the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = list(sets_of(part.column(2), hasher))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], lists], ["doc", "mark", "shingles"])

    return docs.select("doc", "mark", "text").mapInArrow(run, "doc long, mark long, shingles array<long>")


def most_differing(threshold: int) -> int:
    """Places of the sketches of two linked documents that may differ: DEVIATIONS standard deviations more than
    a pair on the threshold has on average (one such pair in 300,000 has more)."""
    share = threshold / 100
    equal, n = share + (1 - share) / 16, MINIMA
    return math.floor(n * (1 - equal) + DEVIATIONS * math.sqrt(n * equal * (1 - equal)))


def sketch_passes(threshold: int) -> Column:
    """Whether the sketches a_s*, b_s* leave a link possible."""
    differ = F.lit(0)
    for s in SKETCH:
        x = F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(_LOWEST)))
    return differ <= F.lit(most_differing(threshold))


def sizes_pass(threshold: int) -> Column:
    return F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * threshold


def side(nodes: DataFrame, which: str) -> DataFrame:
    return nodes.select(F.col("node").alias(which), F.col("n_shingles").alias(f"{which}_n"), *[F.col(s).alias(f"{which}_{s}") for s in SKETCH])


def of_row(doc_id: Column) -> Column:
    """A doc_id to join by: a null one is a value as well."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, common, union) of the pairs' full sets.  The sets of the classes that still occur in a pair are
    made again from their texts; no others are moved, and of equal rows one."""
    in_pair = pairs.select(F.col("a").alias("node")).distinct().union(pairs.select("b").distinct()).distinct()
    named = written(nodes.join(in_pair, "node").select("node", of_row(F.col("doc_id")).alias("doc"), "mark"), "named")
    wanted = written(named.select("doc").distinct(), "wanted")  # a number a class: small enough to be sent around far longer than the texts
    texts = docs.select(of_row(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("mark"), "text").join(wanted, "doc", "left_semi")
    sets = written(shingle_sets(texts).join(named, ["doc", "mark"]).select("node", "shingles"), "sets").dropDuplicates(["node"])
    one = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("common"),
                                                                (F.size("a_set") + F.size("b_set")).alias("sizes"))
    return both.select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("union")).distinct()


def split_join(left: DataFrame, right: DataFrame, key: str, name: str, how: str = "inner") -> DataFrame:
    """``left`` joined to one row a key: a merge of two shuffles, whose left side Spark splits where a key is frequent."""
    return left.join(written(right, name).hint("merge"), key, how)


_FIELDS = ["key", "i", "j", "side", "node", "root", "pivot", "n_shingles", *SKETCH]


def cross_pairs(placed: DataFrame, nodes: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """All pairs (a, b) of nodes of different components in one bucket (key, node, root) that sketch, sizes and the
    triangle inequality let through.

    One of the two is outside the bucket's most frequent component, so such nodes stand on one side and all on the
    other.  Both sides are dealt into blocks of about BLOCK nodes and each pair of blocks is compared by itself, so no task
    holds a large bucket.  A pair counts in the first bucket that it shares.  ``known`` (node, pivot, far: the Jaccard
    distance) is from the first round: distances of two nodes to one pivot that differ by more than a link's distance show
    that there is no link.
    """
    counts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    size = counts.groupBy("key").agg(F.max("n").alias("n"), F.sum("n").alias("all"))
    size = (counts.join(size, ["key", "n"]).groupBy("key", "n", "all").agg(F.min("root").alias("main"))
            .select("key", "main", F.ceil(F.col("all") / BLOCK).alias("rights"), F.ceil((F.col("all") - F.col("n")) / BLOCK).alias("lefts")))
    rows = written(split_join(placed, size, "key", "sizes"), "sized").join(nodes, "node").join(known, "node", "left")
    rows = written(rows, "placed")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = rows.where("root <> main").withColumn("i", block("lefts")).withColumn("j", every("rights")).withColumn("side", F.lit(0).cast("long"))
    right = rows.withColumn("j", block("rights")).withColumn("i", every("lefts")).withColumn("side", F.lit(1).cast("long"))
    both = left.unionByName(right).select(*[F.coalesce(c, F.lit(-1).cast("long")).alias(c) for c in _FIELDS], F.coalesce("far", F.lit(0.0)).alias("far"), "bands")
    most, far_most, mask = most_differing(threshold), 1 - threshold / 100 + 1e-9, np.uint64(_LOWEST)
    first_sketch = _FIELDS.index(SKETCH[0])

    def compare(x: np.ndarray, far: np.ndarray, bands: np.ndarray) -> Iterator[np.ndarray]:
        lefts = np.flatnonzero(x[:, 3] == 0)
        rights = np.flatnonzero(x[:, 3] == 1)
        sketches = x[:, first_sketch:].view(np.uint64)
        for one in lefts:
            n, m = x[rights, 7], x[one, 7]
            ok = (x[rights, 5] != x[one, 5]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * threshold)
            ok &= (x[rights, 6] != x[one, 6]) | (x[one, 6] < 0) | (np.abs(far[rights] - far[one]) <= far_most)
            rest = rights[ok]
            d = sketches[rest] ^ sketches[one]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            rest = rest[np.bitwise_count(d & mask).sum(axis=1) <= most]
            equal = bands[rest] == bands[one]
            rest = rest[bands[one][equal.argmax(axis=1)] == x[one, 0]]
            if len(rest):
                yield np.column_stack([np.minimum(x[rest, 4], x[one, 4]), np.maximum(x[rest, 4], x[one, 4])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of the last block pair, which may go on

        def closed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            x, far, bands = (np.concatenate(p) for p in zip(*parts, strict=True))
            edges = np.append(np.flatnonzero(np.append(True, (x[1:, :3] != x[:-1, :3]).any(axis=1))), len(x))
            found = [p for a, b in zip(edges[:-1], edges[1:], strict=True) for p in compare(x[a:b], far[a:b], bands[a:b])]
            if found:
                out = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:len(_FIELDS)]])
            bands = batch.column(len(_FIELDS) + 1).flatten().to_numpy().reshape(-1, BANDS)
            last = int(np.flatnonzero((x[:, :3] != x[-1, :3]).any(axis=1)).max(initial=-1)) + 1  # the batch's last block pair begins here
            part = (x, batch.column(len(_FIELDS)).to_numpy(), bands)
            if held and (last or (held[0][0][0, :3] != x[0, :3]).any()):
                yield from closed([*held, tuple(p[:last] for p in part)])
                held = []
            elif last:
                yield from closed([tuple(p[:last] for p in part)])
            held.append(tuple(p[last:] for p in part))
        if held:
            yield from closed(held)

    return (both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side").mapInArrow(run, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b): the smallest node of its component.  Alternating large-star and small-star."""

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star")
    seen = mark(now)
    while seen[0]:
        # large-star: every larger neighbour of u goes to the least of u and its neighbours
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "star")
        # small-star: u and its smaller neighbours go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "star")
        if (after := mark(now)) == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())


def linked(docs: DataFrame, threshold: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """Signatures of the rows of ``docs`` (doc_id, text), with ``node``, their class, and (node, root) of the classes that
    have links.  ``by_id``: rows that share a doc_id are linked for that, and rows without one take no part."""
    sig = written(signatures(docs).withColumn("row", F.monotonically_increasing_id()), "signatures")  # a number that writing fixes
    full = sig.where("n_shingles > 0 AND doc_id IS NOT NULL" if by_id else "n_shingles > 0")
    # equal sets are one class, which one row stands for; classes are numbered in the order of their least doc_ids, so that the first
    # of a group, which its copies were made from if any was, is what the others are compared with first
    classes = full.groupBy("h0", "h1").agg(F.min("row").alias("row"), F.min("doc_id").alias("low")).orderBy(F.col("low").asc_nulls_last(), "row")
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()).drop("low"), "classes")
    member = written(full.select("doc_id", "mark", "h0", "h1").join(classes, ["h0", "h1"]).select("doc_id", "mark", "node"), "member")
    nodes = written(full.join(classes.select("row", "node"), "row").drop("row"), "nodes")
    slim = nodes.drop("bands")

    rows = nodes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    in_bucket = written(split_join(rows, shared, "key", "shared", "left_semi"), "buckets")
    edges = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    if by_id:  # a doc_id of several texts ties its classes together
        several = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
        edges = member.join(several, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))
    found = written(components(edges), "components")

    for turn in range(STAR_ROUNDS + 1):
        # what is left are buckets with nodes of several components
        placed = in_bucket.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        placed = written(placed, "rooted")
        ends = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        in_bucket = written(split_join(placed, ends, "key", "ends"), "open")
        if turn < STAR_ROUNDS:
            pivot = F.when(F.col("root") != F.col("low"), F.col("low")).otherwise(F.col("high"))
            pairs = in_bucket.groupBy("node").agg((F.min if turn == 0 else F.max)(pivot).alias("b")).select(F.col("node").alias("a"), "b")
            pairs = (pairs.join(side(slim, "a"), "a").join(side(slim, "b"), "b").where(sizes_pass(threshold) & sketch_passes(threshold))
                     .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        else:
            pairs = cross_pairs(in_bucket.select("key", "node", "root"), nodes, known, threshold)
        pairs = written(compared(written(pairs, "candidates"), docs, slim), "compared")
        if turn == 0:
            far = (1 - F.col("common") / F.col("union")).alias("far")
            known = written(pairs.select(F.col("a").alias("pivot"), F.col("b").alias("node"), far).union(pairs.select("b", "a", far))
                            .groupBy("node").agg(F.min(F.struct("pivot", "far")).alias("x")).select("node", "x.*"), "known")
        links = pairs.where(F.col("common") * 100 >= F.col("union") * threshold).select("a", "b")
        found = written(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)), "components")
        in_bucket = in_bucket.select("key", "node")
    return sig, member.join(found, "node", "left").select("doc_id", "mark", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others are left out): doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= threshold * union of their sets.  component_id is the
    smallest doc_id reachable, kept tells doc_id = component_id.  Empty sets (null texts, texts without words) are
    linked with nothing.  Rows that share a doc_id are one document: their texts' classes are linked.  A null doc_id takes
    no part: its component_id is null and kept true.  An empty table gives an empty result.
    """
    sig, member = linked(docs, threshold, True)
    least = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    reached = member.select("doc_id", "root").distinct().join(least, "root").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sig.select("doc_id", "n_shingles").join(reached, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def representatives(docs: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, mark: xxhash64 of the text) of one document of each group of ``docs`` (doc_id, text): a document is a doc_id with a text,
    and texts alone link documents.  The smallest doc_id stays (null last), of its texts the one with the smallest mark.
    Documents without words are linked with nothing: each stays.  An empty table gives an empty result."""
    sig, member = linked(docs, threshold, False)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    best = member.groupBy("root").agg(first).select("first.doc_id", "first.mark")
    return best.union(sig.where("n_shingles = 0").select("doc_id", "mark").distinct())
