"""Conversation structure repair over a suffix-shared automaton.

A conversation's rows become a signature, one byte a row: the role's initial and the row's fault.  Cheapest edits that lead
to the grammar ``(s?(ua)+)?`` depend on the signature alone, and from any place in it on what follows alone.  Signatures are
therefore read from the end: two conversations that end alike share the nodes of that ending, and a node (a suffix of
signatures) has, for each of the grammar's four states, its cost-to-go and the first letter of its best audit suffix, got once
from the node behind it.  The rest of the audit suffix hangs on that node, so none is ever copied.

Signatures meet by a range shuffle on their reversed bytes (then conv_id, so that a signature which many conversations share
is split over tasks).  In that order neighbours share their longest ending: a task keeps the nodes of the current
signature alone and goes back to the branching point, so its memory is one signature, and a node is made again only where a
task begins.

Rows are put in order and read as streams (a shuffle on conv_id, sorted in the tasks): a task holds a byte a row of the
conversation at hand, never its texts.  ``conv_id`` is the unit of order and of the digest, so its rows pass through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BLANK, DUPLICATE, TRUNCATED, FINE = 3, 2, 1, 0
INITIALS = "sua"  # classes 0, 1, 2; 3 is any other initial, or none
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT is what a truncated row costs that stays
# the grammar: state 0 nothing yet, 1 after s, 2 after u, 3 after a; it may end in 0 and 3
AFTER = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))  # by state and initial
WANTED = (1, 1, 2, 1)  # the initial that Rerole and Insert put in each state: u, but a after u
ROLES = {1: "user", 2: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}  # neighbours su, ua, au
FOREVER = 1 << 60
DROPPED = 4  # fault of a row that is not there; its conversation is


# -- rows -----------------------------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text; a null role or text is one space) damaged by crc32 of ``conv_id:turn`` (a null is one
    space there too) modulo 20: 0 drops the row, 1 empties its text, 2 takes . ! ? out of it, 3 puts it twice, 4 makes the role
    user.  Column ``gone`` marks dropped rows, whose conversations remain known."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("__hit"))
    hit = F.col("__hit")
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    made = rows.select("conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (hit == 0).alias("gone"),
                       F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__twice"))
    return made.drop("__twice")


def laid_out(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls: one space), gone, digest of the text: the columns that order and faults come from."""
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce(gone, F.lit(False)).alias("gone"))
    return rows.withColumn("digest", F.md5(F.col("text").cast("binary")))


ORDER = ["turn", "role", "digest"]  # in a conversation: by turn, null first; rows of one turn by role and digest, so equal rows stand together


def own_fault() -> Column:
    """BLANK, TRUNCATED or FINE of a row by itself."""
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    return F.when(last == "", F.lit(BLANK)).when(last.isin(".", "!", "?"), F.lit(FINE)).otherwise(F.lit(TRUNCATED))


def symbols(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one row with their number ``n``, the initial's class and the fault of the first of them
    (the others are duplicates, or blank): conv_id, turn, role, digest, n, initial, fault."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", F.lit(0)).when(initial == "u", F.lit(1)).when(initial == "a", F.lit(2)).otherwise(F.lit(3))
    slim = rows.select("conv_id", "turn", "role", "digest", code.alias("initial"), F.when(F.col("gone"), F.lit(DROPPED)).otherwise(own_fault()).alias("own"))
    # a dropped row is no row: it only keeps its conversation known
    folded = (slim.withColumn("role", F.when(F.col("own") < DROPPED, F.col("role"))).withColumn("digest", F.when(F.col("own") < DROPPED, F.col("digest")))
              .withColumn("turn", F.when(F.col("own") < DROPPED, F.col("turn")))
              .groupBy("conv_id", "turn", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("initial").alias("initial"), F.max("own").alias("own")))
    # the first turn that says it: one row per turn by now, and a maximum of its own partial sums
    seen = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    keys = ["conv_id", "role", "digest"]
    first = folded.groupBy(*[F.col(c).alias(f"__{c}") for c in keys]).agg(F.min(seen).alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    joined = folded.join(first, same[0] & same[1] & same[2]).withColumn("__first", F.col("__first.turn").eqNullSafe(F.col("turn")))
    fault = F.when(F.col("own").isin(BLANK, DROPPED), F.col("own")).when(F.col("__first"), F.col("own")).otherwise(F.lit(DUPLICATE))
    return joined.select("conv_id", "turn", "role", "digest", "n", "initial", fault.alias("fault"))


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, pa.RecordBatch]]:
    """(begins, conv_id, rows): runs of rows of one conversation; a run that a batch cuts goes on with ``begins`` false."""
    last: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else np.array(ids.to_pylist(), object)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((values[1:] != values[:-1]) | (null[1:] != null[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            conv = ids[a].as_py()
            yield (conv,) != last, conv, batch.slice(a, b - a)
            last = (conv,)


def batches_of(rows: Iterator[tuple], types: list[tuple[str, pa.DataType]], weight=lambda row: 1, full: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``full`` by weight."""
    held, heavy = [], 0
    pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, (_, t) in enumerate(types)], [n for n, _ in types])
    for row in rows:
        held.append(row)
        heavy += weight(row)
        if heavy >= full:
            yield pack()
            held, heavy = [], 0
    if held:
        yield pack()


_SAME = bytes(12 + DUPLICATE if s & 3 >= DUPLICATE else s for s in range(16)) + bytes(240)  # rows that must go are one symbol
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_legal = np.zeros((4, 4), bool)
_legal[tuple(zip(*LEGAL, strict=True))] = True


def counted(conv: int | None, raw: bytearray, gaps: int) -> tuple:
    own = np.frombuffer(bytes(raw), np.uint8)
    initial, fault = own >> 2, own & 3
    illegal = int((~_legal[initial[:-1], initial[1:]]).sum()) if len(own) else 0
    return (conv, bytes(raw).translate(_SAME)[::-1], gaps, *(int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal)


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, back (its signature, a byte a row, last row first), COUNTS."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, raw, turns, low, high = (), bytearray(), 0, 0, 0
        for begins, conv, part in by_conversation(batches):
            if begins:
                if now:
                    yield counted(now[0], raw, high - low + 1 - turns if turns else 0)
                now, raw, turns = (conv,), bytearray(), 0
            for turn, n, initial, fault in zip(*(part.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                if fault == DROPPED:
                    continue
                raw.append(initial * 4 + fault)
                raw += bytes([initial * 4 + max(fault, DUPLICATE)]) * (n - 1)
                if turn is not None and not (turns and high == turn):  # turns ascend
                    low, high, turns = turn if not turns else low, turn, turns + 1
        if now:
            yield counted(now[0], raw, high - low + 1 - turns if turns else 0)

    types = [("conv_id", pa.int64()), ("back", pa.binary()), *((c, pa.int64()) for c in COUNTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(made(batches), types, lambda row: 64 + len(row[1]), 1 << 20)

    ordered = (symbols(rows).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ORDER])
               .select("conv_id", "turn", "n", "initial", "fault"))
    return ordered.mapInArrow(run, "conv_id long, back binary, " + ", ".join(f"{c} long" for c in COUNTS))


# -- the automaton --------------------------------------------------------------------------------------------------


def settled(costs: list[int], letters: list[str]) -> tuple[list[int], list[str]]:
    """Inserts in front of a node: state after state until none helps.  Of equal costs the least letter stands."""
    changed = True
    while changed:
        changed = False
        for state in range(4):
            other = INSERT + costs[AFTER[state][WANTED[state]]]
            if (other, "I") < (costs[state], letters[state] or "~"):
                costs[state], letters[state], changed = other, "I", True
    return costs, letters


class Nodes:
    """The nodes of the current signature's suffixes, from the end: node i stands for its last i rows."""

    def __init__(self):
        costs, letters = settled([0, FOREVER, FOREVER, 0], ["", "", "", ""])
        self.path, self.costs, self.letters, self.made = bytearray(), [costs], [letters], 0

    def behind(self, symbol: int, then: list[int]) -> tuple[list[int], list[str]]:
        """Cost-to-go and first letter by state of a node whose row is ``symbol`` and whose next node costs ``then``."""
        initial, fault = symbol >> 2, symbol & 3
        stays, costs, letters = fault < DUPLICATE, [], []
        cut = CUT if fault == TRUNCATED else 0
        for state in range(4):
            options = [(DELETE + then[state], "D")]
            if stays:
                if initial < 3 and (to := AFTER[state][initial]) is not None:
                    options.append((KEEP + cut + then[to], "K"))
                options.append((REROLE + cut + then[AFTER[state][WANTED[state]]], "R"))
            cost, letter = min(options)
            costs.append(cost)
            letters.append(letter)
        return settled(costs, letters)

    def reach(self, reversed_signature: bytes) -> None:
        """Go back to the ending that both signatures share, then add the nodes in front of it."""
        a, b = np.frombuffer(bytes(self.path), np.uint8), np.frombuffer(reversed_signature, np.uint8)
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        shared = int(differ[0]) if len(differ) else n
        del self.path[shared:], self.costs[shared + 1:], self.letters[shared + 1:]
        for symbol in reversed_signature[shared:]:
            costs, letters = self.behind(symbol, self.costs[-1])
            self.path.append(symbol)
            self.costs.append(costs)
            self.letters.append(letters)
            self.made += 1

    def audit(self) -> str:
        """The best audit of the whole signature: letter by letter along the nodes."""
        out, state, at = [], 0, len(self.path)
        while letter := self.letters[at][state]:
            out.append(letter)
            if letter == "I":
                state = AFTER[state][WANTED[state]]
                continue
            if letter == "K":
                state = AFTER[state][self.path[at - 1] >> 2]
            elif letter == "R":
                state = AFTER[state][WANTED[state]]
            at -= 1
        return "".join(out)


def audits(sigs: DataFrame) -> DataFrame:
    """conv_id, COUNTS, cost and audit of each signature."""
    keep = ["conv_id", *COUNTS]
    types = [*((c, pa.int64()) for c in keep), ("cost", pa.int64()), ("audit", pa.string())]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        nodes = Nodes()
        best = nodes.costs[0][0], nodes.audit()
        for batch in batches:
            for back, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if back != nodes.path:
                    nodes.reach(back)
                    best = nodes.costs[-1][0], nodes.audit()
                yield (*row, *best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(made(batches), types, lambda row: 64 + len(row[-1]), 1 << 20)

    return sigs.select("back", *keep).orderBy("back", F.col("conv_id").asc_nulls_first()).mapInArrow(
        run, ", ".join(f"{c} long" for c in [*keep, "cost"]) + ", audit string")


# -- repair ---------------------------------------------------------------------------------------------------------


def plan_repairs(turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``turns`` (conv_id, turn, role, text, and ``gone`` for dropped rows; others are left out): conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit.

    A null role or text is one space; a null conv_id is a conversation of its own; null turns come first.  Repeated rows are
    duplicates.  Rows of one turn are ordered by role and the text's MD5.  A conversation without rows has zeros and an
    empty audit; an empty table gives an empty result.
    """
    return written(audits(written(signatures(laid_out(turns)), "signatures")), "audits")


def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, list[tuple[str, str, str]], bool]]:
    """(begins, conv_id, [(role, text, edit)], ends) from rows (conv_id, audit, role, text) in order, each conversation's audit in front."""
    audit, at, state, open_ = "", 0, 0, ()

    def inserted(rows: list) -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            rows.append((ROLES[WANTED[state]], "", "I"))
            state, at = AFTER[state][WANTED[state]], at + 1

    for begins, conv, part in by_conversation(batches):
        if begins and open_:
            yield False, open_[0], [], True
        rows: list[tuple[str, str, str]] = []
        texts = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True))
        if begins:
            audit, at, state, open_ = texts[0][0], 0, 0, (conv,)
            texts = texts[1:]
            inserted(rows)
        for _, role, text in texts:
            edit, at = audit[at], at + 1
            if edit == "K":
                rows.append((role, text, edit))
                state = AFTER[state][INITIALS.index(role[0])]
            elif edit == "R":
                rows.append((ROLES[WANTED[state]], text, edit))
                state = AFTER[state][WANTED[state]]
            inserted(rows)
        yield begins, conv, rows, False
    if open_:
        yield False, open_[0], [], True


def with_audits(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows and audits in one stream: by conversation, its audit first, then its rows in order."""
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    rows = laid_out(turns).where("NOT gone").select("conv_id", "turn", "role", "digest", "text", none("audit", "string"), F.lit(1).alias("__side"))
    front = plans.select("conv_id", none("turn", "long"), none("role", "string"), none("digest", "string"), none("text", "string"), "audit", F.lit(0).alias("__side"))
    ordered = rows.unionByName(front).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "__side", *[F.col(c).asc_nulls_first() for c in ORDER])
    return ordered.select("conv_id", "audit", "role", "text")


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, edit (K, R or I) of each row that they have then."""
    types = [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = 0
        for begins, conv, rows, _ in mended(batches):
            place = 0 if begins else place
            yield from ((conv, place + i, *r) for i, r in enumerate(rows))
            place += len(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(made(batches), types, lambda row: 64 + len(row[3]), 1 << 20)

    return with_audits(turns, plans).mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: of each repaired conversation's ``role:text`` lines, hashed as they stream by."""
    types = [("conv_id", pa.int64()), ("repaired_sha256", pa.string())]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, joint = hashlib.sha256(), ""
        for begins, conv, rows, ends in mended(batches):
            if begins:
                now, joint = hashlib.sha256(), ""
            for role, text, _ in rows:
                now.update(f"{joint}{role}:{text}".encode("utf-8", "surrogatepass"))
                joint = "\n"
            if ends:
                yield conv, now.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(made(batches), types)

    return with_audits(turns, plans).mapInArrow(run, "conv_id long, repaired_sha256 string")
