"""Chat formatting by token-level assembly.

Every turn is encoded by itself with the public byte-level BPE (``encode_ordinary``: no special token can come out of a
text).  A conversation's ids are then spliced together: reserved ids, which lie above the vocabulary, mark the turns; running
sums of the segment lengths give each segment's place, and the loss mask is set over the segments of assistant texts.

Turns are put in order (a shuffle on conv_id, sorted in the tasks, which can spill) and read as a stream: ``splice_turns`` writes a
row a turn with its place in the sequence, and ``digests`` reads such rows back, some megabytes at a time, however long a
conversation is.  Only ``format_chats`` makes one array of a conversation, which must then fit in a row (2 GB).

Control strings that occur in a text are escaped before encoding, so the rendered string can be read back as well: after
the first character of a control string comes one backslash more than there was.  ``unescape`` takes it out again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import text_blocks

# the marks of the template; mark i has the id "vocabulary size + i"
MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[END]"]
BLOCK = 1 << 18  # ids of the turns that are looked at together
FRAMES = {"system": (0, 1), "user": (2, 3), "assistant": (4, 5)}  # marks around a text; other roles are named in [ROLE]..[/ROLE] text [END]
_heads = [(re.escape(m[0]), re.escape(m[1:])) for m in MARKS]
_ESCAPE = re.compile("|".join(rf"{a}(?=\\*{b})" for a, b in _heads))
_UNESCAPE = re.compile("|".join(rf"(?<={a})\\(?=\\*{b})" for a, b in _heads))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text) if "<" in text or "[" in text else text  # every mark begins with one of these


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text) if "\\" in text else text


def coder(tokens: list[bytes], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def encode_turns(turns: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """conv_id, turn, role and ids of the escaped text of each row (null text or role: empty); no shuffle."""
    given = turns.sparkSession.sparkContext.broadcast(read_ranks(rank_file))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lists = coder(given.value, pattern), pa.list_(pa.int32())
        names = {r: [] for r in FRAMES}
        for batch in batches:
            for i, j, texts in text_blocks(batch.column(3)):
                part = batch.slice(i, j - i)
                roles = part.column(2).to_pylist()
                ids = [own.encode_ordinary(escape(t.decode("utf-8", "surrogatepass"))) for t in texts]
                named = [names[r] if r in names else own.encode_ordinary(escape(r)) for r in roles]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(named, lists), pa.array(ids, lists)], ["conv_id", "turn", "role", "name_ids", "ids"])

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), "text").mapInArrow(
        run, "conv_id long, turn long, role string, name_ids array<int>, ids array<int>")


def splice(segments: list[tuple[np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of (ids, in the loss) segments, places by running sums."""
    if not segments:
        return np.zeros(0, np.int32), np.zeros(0, bool)
    sizes, loss = np.array([len(ids) for ids, _ in segments]), np.array([x for _, x in segments], bool)
    ends = np.cumsum(sizes)
    step = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(step, (ends - sizes)[loss], 1)
    np.add.at(step, ends[loss], -1)
    return np.concatenate([ids for ids, _ in segments]).astype(np.int32), np.cumsum(step)[:-1] > 0


def frame(role: str, name_ids: np.ndarray, ids: np.ndarray, marks: list[np.ndarray]) -> list[tuple[np.ndarray, bool]]:
    if role in FRAMES:
        a, b = FRAMES[role]
        return [(marks[a], False), (ids, role == "assistant"), (marks[b], False)]
    return [(marks[6], False), (name_ids, False), (marks[7], False), (ids, False), (marks[8], False)]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column without nulls, as views of its values."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about BLOCK ids, whole rows, by the lists in ``column``."""
    for batch in batches:
        ends, i = batch.column(column).offsets.to_numpy(), 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + BLOCK, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def splice_turns(encoded: DataFrame, marks: int) -> DataFrame:
    """A row a turn: conv_id, at (its place among the conversation's turns, from 0), start (of its ids in the sequence), input_ids
    array<int>, loss_mask array<boolean>; the sequence is the turns' arrays one after the other.

    Turns are ordered by turn (null first), then role and ids, and all rows of a conversation stand in order in one partition."""
    reserved = [marks + i for i in range(len(MARKS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = [np.array([i], np.int32) for i in reserved]
        last, at, start = (), 0, 0  # no conv_id equals the empty tuple
        for part in _blocks(batches, 3):
            rows = [frame(r, n, x, ids_of) for r, n, x in zip(part.column(1).to_pylist(), _lists(part.column(2)), _lists(part.column(3)), strict=True)]
            flat, mask = splice([segment for row in rows for segment in row])
            sizes, places, starts = [sum(len(x) for x, _ in row) for row in rows], [], []
            for conv, size in zip(part.column(0).to_pylist(), sizes, strict=True):
                at, start, last = (at, start, last) if conv == last else (0, 0, conv)
                places.append(at)
                starts.append(start)
                at, start = at + 1, start + size
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(places, pa.int64()), pa.array(starts, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat)),
                                              pa.ListArray.from_arrays(ends, pa.array(mask))], ["conv_id", "at", "start", "input_ids", "loss_mask"])

    ordered = encoded.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "name_ids", "ids")])
    return ordered.select("conv_id", "role", "name_ids", "ids").mapInArrow(run, "conv_id long, at long, start long, input_ids array<int>, loss_mask array<boolean>")


def assemble(segments: DataFrame) -> DataFrame:
    """conv_id, input_ids, loss_mask: one row per conv_id of the rows of ``splice_turns``."""
    turns = segments.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "input_ids", "loss_mask"))).alias("t"))
    return turns.select("conv_id", F.flatten("t.input_ids").alias("input_ids"), F.flatten("t.loss_mask").alias("loss_mask"))


def read_parts(ids: np.ndarray, tokens: list[bytes]) -> list[tuple[int, str]]:
    """(mark, escaped text behind it) of each reserved id of a sequence."""
    places = np.flatnonzero(ids >= len(tokens)).tolist()
    flat = ids.tolist()
    return [(flat[a] - len(tokens), b"".join(map(tokens.__getitem__, flat[a + 1:b])).decode("utf-8", "surrogatepass")) for a, b in zip(places, [*places[1:], len(flat)], strict=True)]


def turns_of(parts: list[tuple[int, str]]) -> list[tuple[str, str]]:
    """(role, text) of each turn: the marks tell where the parts begin and end."""
    opened, out, role = {a: r for r, (a, _) in FRAMES.items()}, [], None
    for mark, text in parts:
        if mark in opened:
            out.append((opened[mark], unescape(text)))
        elif mark == 6:
            role = unescape(text)
        elif mark == 7:
            out.append((role, unescape(text)))
    return out


def loss_texts(ids: np.ndarray, mask: np.ndarray, tokens: list[bytes]) -> list[str]:
    """The unescaped text of each run of the loss mask, which covers no mark."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()
    return [unescape(b"".join(map(tokens.__getitem__, ids[a:b].tolist())).decode("utf-8", "surrogatepass")) for a, b in zip(edges[0::2], edges[1::2], strict=True)]


def rendered(parts: list[tuple[int, str]]) -> str:
    return "".join(MARKS[mark] + text for mark, text in parts)


def read_back(sequences: DataFrame, rank_file: str) -> DataFrame:
    """What sequences say (of whole conversations, or of turns): conv_id, roles and texts (arrays, a turn each), loss_texts (the
    unescaped text of each run of the loss mask), formatted (the rendered string)."""
    given = sequences.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, strings = given.value, pa.list_(pa.string())
        for part in _blocks(batches, 1):
            rows = []
            for ids, mask in zip(_lists(part.column(1)), _lists(part.column(2)), strict=True):
                parts = read_parts(ids, tokens)
                turns = turns_of(parts)
                rows.append(([r for r, _ in turns], [t for _, t in turns], loss_texts(ids, mask, tokens), rendered(parts)))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[i] for r in rows], strings if i < 3 else pa.string()) for i in range(4))],
                                             ["conv_id", "roles", "texts", "loss_texts", "formatted"])

    return sequences.select("conv_id", "input_ids", "loss_mask").mapInArrow(
        run, "conv_id long, roles array<string>, texts array<string>, loss_texts array<string>, formatted string")


def digests(segments: DataFrame, rank_file: str) -> DataFrame:
    """What the rows of ``splice_turns`` say, a row a conversation: conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed per
    turn), loss_chars and loss_sha256 (of the text under the loss mask), formatted_chars.  The rows are read as they come from
    ``splice_turns``, in order; of a conversation no more than a block of turns is held."""
    given = segments.sparkSession.sparkContext.broadcast(read_ranks(rank_file))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, open_ = given.value, None
        for part in _blocks(batches, 2):
            done = []
            for conv, at, ids, mask in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _lists(part.column(2)), _lists(part.column(3)), strict=True):
                if at == 0:
                    if open_:
                        done.append(open_)
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                parts = read_parts(ids, tokens)
                for role, text in turns_of(parts):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for text in loss_texts(ids, mask, tokens):
                    open_[3] += len(text)
                    open_[4].update(text.encode("utf-8", "surrogatepass"))
                open_[5] += len(rendered(parts))
            yield _closed(done)
        if open_:
            yield _closed([open_])

    def _closed(done: list[list]) -> pa.RecordBatch:
        rows = [[x.hexdigest() if i in (2, 4) else x for i, x in enumerate(row)] for row in done]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return segments.select("conv_id", "at", "input_ids", "loss_mask").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_turns(turns: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``turns`` (conv_id, turn, role, text; others are left out) as rows of sequences: see ``splice_turns``.  Nulls, repeated rows and
    empty tables as in ``format_chats``."""
    return splice_turns(encode_turns(turns, rank_file, pattern), len(read_ranks(rank_file)))


def format_chats(turns: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``turns`` (conv_id, turn, role, text; others are left out) as sequences: conv_id, input_ids, loss_mask.

    One row per conv_id; a null conv_id is a conversation of its own.  Null texts and roles are empty, an empty
    assistant text has no loss; repeated rows are turns of their own.  An empty table gives an empty result.
    """
    return assemble(format_turns(turns, rank_file, pattern))
