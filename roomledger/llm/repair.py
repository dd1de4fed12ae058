"""Structure repair of conversations: the cheapest edits that make the roles alternate.

A repaired conversation is empty or an optional system turn followed by user/assistant pairs, by the
roles' initials ``(s?(ua)+)?``. Every row is kept (K, free), gets the role user or assistant (R, 1) or is
deleted (D, 2); empty turns may be inserted anywhere (I, 5). Blank and duplicate rows must be deleted;
a truncated row that stays costs 5 more. Among the cheapest edit strings the ASCII-least is taken.

Method: rows are repartitioned by conversation and sorted by turn; ``mapInPandas`` then reads them as a
stream and carries the state of the dynamic programme from one Arrow batch to the next. The grammar is
a four-state automaton (start, s, u, a), and an edit leads from each state to one other, so the state of
the programme is the best cost per automaton state and the order of their edit strings. (Inserts are
counted with the edit that follows them, so no such string is the beginning of another and their order
never changes later.) Costs relative to the least take few values (a state too dear to matter is dropped): each (state, kind of row) is worked
out once per worker and looked up afterwards. A row leaves one byte of backpointers per automaton state.
Backpointers and rows wait in spooled temporary files, which go to disk beyond ``SPOOL`` bytes; at
the end of a conversation the backpointers are read from the last block to the first and the rows are
replayed. So memory does not depend on a conversation's length (but the edit string is one cell).

A conversation is one stream in one task, as the method asks; only its rows are shuffled, once. Which rows
repeat an earlier one is found there by a window of Spark, which sorts on disk where needed.

Defined results: a null role or text is one space; a null conversation id is a conversation of its own;
null turns come first, rows of one turn are ordered by role and text; repeated rows are duplicates after
the first; a conversation of ``lost`` rows only gives zeros, an empty edit string and the empty string's
digest; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import frame, worker_cache

INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5  # costs
BLANKS = " \t\n\v\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
EXPECTED = ("user", "user", "assistant", "user")  # the role that an insert or a new role gives, by state
ACCEPTED = (START, ASSISTANT)
# Two inserts lead from any state to ASSISTANT, a third to USER, and a deletion spares a system turn: a
# state that is dearer than the least by more than that can be on no cheapest way.
HOPELESS = 3 * INSERT + DELETE
LEGAL_PAIRS = ("su", "ua", "au")
BLOCK = 1 << 16  # backpointers handled at once
SPOOL = 16 << 20  # bytes of a conversation's rows or backpointers that stay in memory
HEAD, TURN = "<II", "<?q"  # sizes of a row's role and text; whether it has no turn, and the turn

AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_rows long, n_repaired long"
)
TURNS = "conv_id long, place long, edit string, turn long, role string, text string"


def damage(turns: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20; ``lost`` marks dropped ones."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = (
        F.when(fault <= 1, F.lit("")).when(fault == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    )
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(filled("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("lost"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


class Programme:
    """The dynamic programme's states and steps, worked out on first use."""

    MOVES = ("D", "K", "R", "IK", "IR", "IIK", "IIR")

    def __init__(self):
        self.first = ((0, 0), None, None, None)  # (cost above the least, order of the edit string) by state
        self.steps: dict[tuple, tuple] = {}

    def moves(self, state: int, initial: str, forced: bool, truncated: bool):
        """(cost, move number, next state) of each edit of one row, with the inserts before it."""
        yield DELETE, 0, state
        if forced:
            return
        for inserts in range(3):
            cost = INSERT * inserts + (TRUNCATED if truncated else 0)
            if (state, initial) in NEXT:
                yield cost, 2 * inserts + 1, NEXT[state, initial]
            state = NEXT[state, EXPECTED[state][0]]
            yield cost + REROLE, 2 * inserts + 2, state

    def step(self, vector: tuple, initial: str, forced: bool, truncated: bool) -> tuple[tuple, int, int]:
        """(next vector, cost added to the least, packed backpointers)."""
        found = self.steps.get((vector, initial, forced, truncated))
        if found is None:
            best: dict[int, tuple] = {}
            for state, held in enumerate(vector):
                if held:
                    for cost, move, after in self.moves(state, initial, forced, truncated):
                        way = (held[0] + cost, held[1], self.MOVES[move], state, move)
                        best[after] = min(best.get(after, way), way)
            least = min(way[0] for way in best.values())
            best = {s: way for s, way in best.items() if way[0] <= least + HOPELESS}
            order = {s: n for n, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
            vector_after = tuple((best[s][0] - least, order[s]) if s in best else None for s in range(4))
            pointers = sum((way[3] << 3 | way[4]) << 8 * s for s, way in best.items())
            found = self.steps[vector, initial, forced, truncated] = (vector_after, least, pointers)
        return found

    def last(self, vector: tuple) -> tuple[int, int, int]:
        """(cost added, state after the last row, inserts at the end) of the best ending."""
        ways = []
        for state, held in enumerate(vector):
            after = state
            for inserts in range(3):
                if held and after in ACCEPTED:
                    ways.append((held[0] + INSERT * inserts, held[1], inserts, state))
                after = NEXT[after, EXPECTED[after][0]]
        cost, _, inserts, state = min(ways)
        return cost, state, inserts


class Conversation:
    """What is kept of one conversation while its rows pass."""

    def __init__(self, conv_id: int | None, programme: Programme, spool: int = SPOOL):
        self.conv_id, self.programme, self.vector = conv_id, programme, programme.first
        self.rows = self.cost = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.lowest = self.highest = None
        self.before = ""
        self.texts = tempfile.SpooledTemporaryFile(max_size=spool)
        self.pointers, self.spilled = array("I"), tempfile.SpooledTemporaryFile(max_size=spool)

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        stripped = text.rstrip(BLANKS)
        blank, repeated = not stripped, bool(stripped) and repeated
        cut = not (blank or repeated) and stripped[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + repeated, self.truncated + cut
        initial = role[:1]
        self.illegal += self.rows > 0 and self.before + initial not in LEGAL_PAIRS
        self.before = initial
        if turn is not None and turn != self.highest:  # turns come in ascending order
            self.turns, self.highest = self.turns + 1, turn
            self.lowest = turn if self.lowest is None else self.lowest
        self.vector, cost, pointers = self.programme.step(self.vector, initial, blank or repeated, cut)
        self.cost += cost
        self.rows += 1
        self.pointers.append(pointers)
        if len(self.pointers) == BLOCK:
            self.spilled.write(self.pointers.tobytes())
            self.pointers = array("I")
        own = role.encode(), text.encode()
        self.texts.write(struct.pack(HEAD, len(own[0]), len(own[1])) + own[0] + own[1] + struct.pack(TURN, turn is None, turn or 0))

    def path(self) -> tuple[tempfile.SpooledTemporaryFile, int]:
        """A file with one move per row, in order, and the number of inserts at the end."""
        cost, state, inserts = self.programme.last(self.vector)
        self.cost += cost
        moves = tempfile.SpooledTemporaryFile(max_size=SPOOL)
        for block in range(self.rows // BLOCK, -1, -1):
            pointers = self.pointers
            if block < self.rows // BLOCK:
                self.spilled.seek(4 * BLOCK * block)
                pointers = array("I", self.spilled.read(4 * BLOCK))
            own = bytearray(len(pointers))
            for n in range(len(pointers) - 1, -1, -1):
                pointer = pointers[n] >> 8 * state & 0xFF
                own[n], state = pointer & 7, pointer >> 3
            moves.seek(BLOCK * block)
            moves.write(own)
        moves.seek(0)
        return moves, inserts

    def replay(self) -> Iterator[tuple[str, str | None, str | None, int | None]]:
        """(edit, role, text, turn) of every edit in order; a deleted row has no role."""
        moves, trailing = self.path()
        self.texts.seek(0)
        state = START
        while block := moves.read(BLOCK):
            for move in block:
                role_size, text_size = struct.unpack(HEAD, self.texts.read(8))
                own = self.texts.read(role_size + text_size + 9)
                role, text = own[:role_size].decode(), own[role_size:-9].decode()
                no_turn, turn = struct.unpack(TURN, own[-9:])
                turn = None if no_turn else turn
                for edit in self.programme.MOVES[move]:
                    if edit == "D":
                        yield "D", None, None, turn
                    elif edit == "K":
                        state = NEXT[state, role[0]]
                        yield "K", role, text, turn
                    else:
                        wanted = EXPECTED[state]
                        state = NEXT[state, wanted[0]]
                        yield (edit, wanted, "", None) if edit == "I" else (edit, wanted, text, turn)
        for _ in range(trailing):
            wanted = EXPECTED[state]
            state = NEXT[state, wanted[0]]
            yield "I", wanted, "", None
        moves.close()

    def close(self) -> None:
        self.texts.close()
        self.spilled.close()

    def audit(self) -> tuple:
        digest, edits, kept = hashlib.sha256(), bytearray(), 0
        for edit, role, text, _ in self.replay():
            edits += edit.encode()
            if role is not None:
                digest.update(f"{chr(10) if kept else ''}{role}:{text}".encode())
                kept += 1
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.conv_id, *counts, edits.decode(), digest.hexdigest(), self.rows, kept)


def ordered(turns: DataFrame) -> DataFrame:
    """One shuffle by conversation; rows in order of turn, marked where an earlier row is the same."""
    lost = F.coalesce(F.col("lost"), F.lit(False)) if "lost" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(lost, F.lit("")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(lost, F.lit("")).otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
        lost.alias("lost"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "lost", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumn("repeated", F.row_number().over(same) > 1)
    # Pandas would read a column of longs with nulls as doubles, so nulls travel as flags.
    return marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "repeated").select(
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("no_id"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNull().alias("no_turn"),
        "role",
        "text",
        "lost",
        "repeated",
    )


def conversations(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Each conversation of a sorted stream, when its last row has passed."""
    programme = worker_cache(("repair",), Programme)
    current, key = None, None
    for batch in batches:
        columns = ("conv_id", "no_id", "turn", "no_turn", "role", "text", "lost", "repeated")
        for conv_id, no_id, turn, no_turn, role, text, lost, repeated in zip(*(batch[c].tolist() for c in columns), strict=True):
            if key != (no_id, conv_id):
                if current is not None:
                    yield current
                current, key = Conversation(None if no_id else conv_id, programme), (no_id, conv_id)
            if not lost:
                current.add(None if no_turn else turn, role, text, repeated)
    if current is not None:
        yield current


def in_batches(rows: Iterator[tuple], schema: str, size: int, weight) -> Iterator[pd.DataFrame]:
    """Frames of ``schema`` whose rows weigh about ``size`` together."""
    part, total = [], 0
    for row in rows:
        part.append(row)
        total += weight(row)
        if total >= size:
            yield frame(part, schema)
            part, total = [], 0
    yield frame(part, schema)


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and the edits of its repair, a digest of the repaired turns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for found in conversations(batches):
                yield found.audit()
                found.close()

        yield from in_batches(rows(), AUDIT, 1 << 20, lambda row: 200 + len(row[7]))

    return ordered(turns).mapInPandas(run, AUDIT)


def repair(turns: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (K, R or I), the row's own turn, role, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for found in conversations(batches):
                place = 0
                for edit, role, text, turn in found.replay():
                    if role is not None:
                        yield found.conv_id, place, edit, turn, role, text
                        place += 1
                found.close()

        yield from in_batches(rows(), TURNS, 4 << 20, lambda row: 100 + len(row[5]))

    return ordered(turns).mapInPandas(run, TURNS)
