"""Byte-level BPE on padded numpy matrices.

The driver reads the rank file (its size is bounded by the vocabulary) and broadcasts an open-addressing
hash table from token pairs to merged tokens.  In a task, the distinct pieces of a block of texts are
put into buckets by length; a bucket is one padded matrix of token ids with a matrix of pair ranks
beside it.  Each round every row merges its leftmost pair of least rank, closes the gap, and looks up the
two pairs that changed; rows without a mergeable pair leave the matrix.  Pieces of over ``WIDE`` bytes
take the same merges in the same order through a heap over a linked list, since a round over such a row costs its
whole length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from .common import Hasher, gather, text_blocks

NONE = np.int32(2**31 - 1)  # rank of a pair that does not merge
WIDE = 8192  # measured: matrix 21 ms a piece of 4,096 bytes against 168 by the heap, 910 against 750 at 16,384
CELLS = 1 << 18  # of a matrix
BLOCK = 1 << 20  # bytes of text looked up together
UNITS = 300_000  # distinct units remembered in a task, about


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id of a rank file (base64 token, space, id a line).  The ids run from 0 without a gap."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))) or {bytes([b]) for b in range(256)} - set(ranks.values()):
        raise ValueError(f"{path} lacks ids or single bytes")
    return [ranks[i] for i in range(len(ranks))]


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def pair_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, merged ids, bits) of the hash table: a pair (a, b) has key a * 2**32 + b; -1 marks a free slot."""
    ids = {t: i for i, t in enumerate(tokens)}
    found = [((ids[t[:k]] << 32) + ids[t[k:]], i) for i, t in enumerate(tokens) for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids]
    keys, merged = np.array([k for k, _ in found] or [0], np.int64)[:len(found)], np.array([m for _, m in found], np.int32)
    bits = max(4, int(len(found) * 2).bit_length())
    table, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
    at = slots(keys, bits)
    while len(keys):  # one key takes a free slot, the others try the next
        _, first = np.unique(at, return_index=True)
        first = first[table[at[first]] == -1]
        table[at[first]], values[at[first]] = keys[first], merged[first]
        left = np.ones(len(keys), bool)
        left[first] = False
        keys, merged, at = keys[left], merged[left], (at[left] + 1) & ((1 << bits) - 1)
    return table, values, bits


class Bpe:
    """Encoder and decoder of one vocabulary; ``pair_table`` may be given ready-made."""

    def __init__(self, tokens: list[bytes], table: tuple[np.ndarray, np.ndarray, int] | None = None):
        self.table, self.values, self.bits = table or pair_table(tokens)
        single = {t: i for i, t in enumerate(tokens) if len(t) == 1}
        self.byte = np.array([single[bytes([b])] for b in range(256)], np.int32)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.width = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.width) - self.width
        hashes = Hasher().ranges(self.flat, self.start, self.start + self.width)
        self.known_id = np.argsort(hashes, kind="stable")
        self.known = hashes[self.known_id]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair (its rank), NONE where it does not merge or a side is padding (-1)."""
        keys = (a.astype(np.int64) << 32) + b
        keys[(a < 0) | (b < 0)] = -2
        at = slots(keys, self.bits)
        got = self.table[at]
        out = np.where(got == keys, self.values[at], NONE)
        open_ = np.flatnonzero((got != keys) & (got != -1) & (keys != -2))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.table[at[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (got != -1)]
        return out

    def merge_matrix(self, raw: np.ndarray, start: np.ndarray, width: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens of the pieces at raw[start:start + width] (widths of at least 2): as rows end, their numbers, their
        counts of tokens, and these tokens one after the other."""
        wide = int(width.max())
        columns = np.arange(wide)
        inside = columns < width[:, None]
        ids = np.where(inside, self.byte[raw[np.minimum(start[:, None] + columns, len(raw) - 1)]], np.int32(-1))
        rank = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), wide - 1)
        row = np.arange(len(ids))
        while True:
            at = rank.argmin(axis=1)  # the leftmost of the least
            best = rank[np.arange(len(row)), at]
            ended = best == NONE
            if ended.any():
                out = ids[ended]
                full = out >= 0
                yield row[ended], full.sum(axis=1), out[full]
                row, ids, rank, at, best = row[~ended], ids[~ended], rank[~ended], at[~ended], best[~ended]
                if not len(row):
                    return
            line, n = np.arange(len(row)), len(row)
            ids[line, at] = best
            stay = np.ones(ids.shape, bool)
            stay[line, at + 1] = False
            ids = ids[stay].reshape(n, -1)
            if ids.shape[1] == 1:
                rank = np.full((n, 1), NONE, np.int32)
                continue
            stay = np.ones(rank.shape, bool)
            stay[line, at] = False
            rank = rank[stay].reshape(n, -1)
            for p in (at - 1, at):  # the pairs left and right of the merged token
                ok = np.flatnonzero((p >= 0) & (p < rank.shape[1]))
                rank[ok, p[ok]] = self.ranks(ids[ok, p[ok]], ids[ok, p[ok] + 1])

    def merge_wide(self, piece: np.ndarray) -> np.ndarray:
        ids = self.byte[piece]
        rank = self.ranks(ids[:-1], ids[1:])
        heap = [(int(rank[i]), int(i)) for i in np.flatnonzero(rank != NONE)]
        heapq.heapify(heap)
        n, ids, rank = len(ids), ids.tolist(), rank.tolist() + [int(NONE)]
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def look(i: int) -> None:
            rank[i] = r = int(self.ranks(np.array([ids[i]]), np.array([ids[after[i]]]))[0]) if after[i] < n else int(NONE)
            if r != NONE:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if not live[i] or rank[i] != r:
                continue
            gone = after[i]
            ids[i], live[gone], after[i] = r, False, after[gone]
            if after[i] < n:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return np.array([ids[i] for i in range(n) if live[i]], np.int32)

    def encode_ranges(self, raw: np.ndarray, start: np.ndarray, width: np.ndarray, hashes: np.ndarray) -> "Ranges":
        """Tokens of the pieces raw[start:start + width].  A piece that is a token itself stays whole, the others
        are merged in buckets of like length."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        own = np.where((self.known[at] == hashes) & (self.width[self.known_id[at]] == width), self.known_id[at], -1)
        maybe = np.flatnonzero(own >= 0)
        differ = gather(raw, start[maybe], width[maybe]) != gather(self.flat, self.start[own[maybe]], width[maybe])
        own[maybe[np.repeat(np.arange(len(maybe)), width[maybe])[differ]]] = -1
        whole = np.flatnonzero(own >= 0)
        parts, rows, counts = [own[whole].astype(np.int32)], [whole], [np.ones(len(whole), np.int64)]
        bucket = np.where((own >= 0) | (width == 0), -1, np.where(width > WIDE, -2, (width + 3) // 4))
        for i in np.flatnonzero(bucket == -2):
            parts.append(self.merge_wide(raw[start[i]:start[i] + width[i]]))
            rows.append(np.array([i]))
            counts.append(np.array([len(parts[-1])]))
        for size in np.unique(bucket[bucket > 0]):
            members = np.flatnonzero(bucket == size)
            step = max(1, CELLS // (4 * int(size)))
            for k in range(0, len(members), step):
                part = members[k:k + step]
                for row, count, ids in self.merge_matrix(raw, start[part], width[part]):
                    rows.append(part[row])
                    counts.append(count)
                    parts.append(ids)
        first, count = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        row, n = np.concatenate(rows), np.concatenate(counts)
        first[row], count[row] = np.cumsum(n) - n, n
        return Ranges(np.concatenate(parts), first, count)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.start[ids], self.width[ids]).tobytes()


class Ranges(NamedTuple):
    """flat[start:start + width] by number."""

    flat: np.ndarray
    start: np.ndarray
    width: np.ndarray

    def at(self, i: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[i], self.width[i])

    def and_(self, more: "Ranges") -> "Ranges":
        return Ranges(np.concatenate([self.flat, more.flat]), np.concatenate([self.start, more.start + len(self.flat)]), np.concatenate([self.width, more.width]))


class Store:
    """Token ids of byte strings met before in this task, found by hash; the bytes are kept to make sure."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.hashes, self.number = np.zeros(0, np.uint64), none
        self.raw, self.ids = Ranges(np.zeros(0, np.uint8), none, none), Ranges(np.zeros(0, np.int32), none, none)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each string, -1 if unknown."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.number[at], -1)

    def add(self, hashes: np.ndarray, raw: Ranges, ids: Ranges) -> None:
        number = np.concatenate([self.number, np.arange(len(hashes)) + len(self.ids.width)])
        joined = np.concatenate([self.hashes, hashes])
        order = np.argsort(joined, kind="stable")
        self.hashes, self.number = joined[order], number[order]
        self.raw, self.ids = self.raw.and_(raw), self.ids.and_(ids)


def cuts(raw: np.ndarray) -> np.ndarray:
    """Places of the spaces (0x20) that follow a character other than white space.  After a character of three or
    four bytes only if it is none of the blocks that hold white space; a cut left out does no harm."""
    at = np.flatnonzero(raw == 32)
    at = at[at > 0]
    one = raw[at - 1]
    fine = (one > 32) & (one < 127)
    high = np.flatnonzero(one >= 128)
    two, three = raw[np.maximum(at[high] - 2, 0)], raw[np.maximum(at[high] - 3, 0)]
    fine[high] = ((two >= 0xC3) & (two < 0xE0)) | ((two >= 128) & (two < 0xC0) & (three >= 0xE4)) | (
        (three == 0xE2) & (two == 0x80) & (one[high] >= 0x90) & (one[high] < 0xA8))
    return at[fine]


class Texts:
    """Encodes texts, each match of ``pattern`` separately.

    ``pattern`` is the one of the public rank files: a match never runs from a character other than white space
    into a space, and does not look behind.  So a text may be cut before each space that follows such a character, and
    the matches are those of its units.  Distinct units are matched once a task, distinct matches merged once.
    """

    def __init__(self, bpe: Bpe, pattern: str):
        self.bpe, self.matches, self.hasher = bpe, regex.compile(pattern).findall, Hasher()
        self.units, self.pieces = Store(), Store()

    def pieces_of(self, raw: np.ndarray, starts: np.ndarray, safe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte widths of the matches in units that begin at ``starts`` (one after the other), and how many each unit has.
        Runs of units between which the text is cut again (``safe``: from this unit on it is) are matched together."""
        text, ends = raw.tobytes(), np.append(starts[1:], len(raw))
        heads = np.flatnonzero(~safe)
        found: list[str] = []
        for i, j in zip(heads, np.append(heads[1:], len(starts)), strict=True):
            found += self.matches(text[starts[i]:ends[j - 1]].decode("utf-8", "surrogatepass"))
        chars = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # of characters
        stops = begins[chars]
        return np.diff(stops, prepend=0), np.diff(np.searchsorted(stops, ends, side="right"), prepend=0)

    def learn(self, raw: np.ndarray, starts: np.ndarray, safe: np.ndarray, hashes: np.ndarray) -> None:
        wide, counts = self.pieces_of(raw, starts, safe)
        ends = np.cumsum(wide)
        first = ends - wide
        own = self.hasher.ranges(raw, first, ends)
        _, pick = np.unique(own, return_index=True)
        pick = np.sort(pick[self.pieces.find(own[pick]) < 0])
        fresh = Ranges(gather(raw, first[pick], wide[pick]), np.cumsum(wide[pick]) - wide[pick], wide[pick])
        self.pieces.add(own[pick], fresh, self.bpe.encode_ranges(*fresh, own[pick]))
        at, given = self.pieces.find(own), self.pieces.ids
        if not self.same(self.pieces, at, wide, raw):  # two pieces of one hash
            given = self.bpe.encode_ranges(raw, first, wide, own)
            at = np.arange(len(own))
        n = given.width[at]
        stops = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))]
        units = Ranges(raw, starts, np.diff(starts, append=len(raw)))
        self.units.add(hashes, units, Ranges(given.at(at), stops[:-1], np.diff(stops)))

    @staticmethod
    def same(store: Store, at: np.ndarray, wide: np.ndarray, raw: np.ndarray) -> bool:
        return np.array_equal(store.raw.width[at], wide) and np.array_equal(store.raw.at(at), raw)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        if len(self.units.hashes) > UNITS:
            self.units, self.pieces = Store(), Store()
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        heads = np.append(0, ends[:-1])[np.diff(ends, prepend=0) > 0]
        begins, head = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        head[heads] = begins[heads] = begins[cuts(raw)] = True
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        wide = np.diff(starts, append=len(raw))
        hashes = self.hasher.ranges(raw, starts, starts + wide)
        distinct, pick, back = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.sort(pick[self.units.find(distinct) < 0])
        if len(new):
            # a unit is cut off again if it begins with a cut and the one put before it ends at a cut
            cut = ~head[starts]
            before = np.append(cut[1:], False)[new]
            safe = cut[new] & np.append(False, before[:-1])
            taken = gather(raw, starts[new], wide[new])
            self.learn(taken, np.cumsum(wide[new]) - wide[new], safe, hashes[new])
        at, given = self.units.find(distinct)[back], self.units.ids
        if not self.same(self.units, at, wide, raw):  # two units of one hash
            whole = Texts(self.bpe, self.matches.__self__.pattern)
            whole.learn(raw, starts, np.zeros(len(starts), bool), np.arange(len(starts)).astype(np.uint64))
            at, given = np.arange(len(starts)), whole.units.ids
        n = given.width[at]
        return given.at(at), np.diff(np.append(0, np.cumsum(n))[np.searchsorted(starts, ends, side="left")], prepend=0)


def encode(docs: DataFrame, rank_file: str, pattern: str, keep: list[str], text: str = "text", out: str = "ids") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``out``: array<int>, the token ids of the whole ``text`` (null: empty array).

    One row per input row, repeated rows included; no special tokens; no shuffle.
    """
    sc = docs.sparkSession.sparkContext
    tokens = read_ranks(rank_file)
    given = sc.broadcast((tokens, pair_table(tokens)))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Texts(Bpe(*given.value), pattern)
        for batch in batches:
            for i, j, texts in text_blocks(batch.column(len(keep)), BLOCK):
                ids, counts = coder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), lists], [*keep, out])

    kept = docs.select(*keep)
    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, kept.schema.add(out, ArrayType(IntegerType())))


def decode(rows: DataFrame, rank_file: str, keep: list[str], ids: str = "ids", out: str = "decoded", packed: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``out``: binary, the bytes that the array ``ids`` stands for (null: empty).  With
    ``packed``, also the ids as binary, unsigned 32-bit little-endian."""
    given = rows.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(given.value, (np.zeros(1, np.int64), np.zeros(1, np.int32), 1))
        for batch in batches:
            lists = batch.column(len(keep))
            flat = lists.values.to_numpy(zero_copy_only=False)
            bounds, i = lists.offsets.to_numpy(), 0
            while i < batch.num_rows:  # rows of about BLOCK bytes of ids at a time, or one longer row
                j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BLOCK // 4, side="right")) - 1)
                parts = [flat[a:b] for a, b in zip(bounds[i:j], bounds[i + 1:j + 1], strict=True)]
                made = [pa.array([bpe.decode(p) for p in parts], pa.binary())]
                if packed:
                    made.append(pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), *made], [*keep, out, *[packed] * bool(packed)])
                i = j

    schema = rows.select(*keep).schema.add(out, "binary")
    return rows.select(*keep, rows[ids].alias("__ids")).mapInArrow(run, schema.add(packed, "binary") if packed else schema)
