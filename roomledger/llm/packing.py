"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

Harmonic classes divide lengths at the reciprocals of the capacity: class ``k`` holds pieces of at most
``capacity // k`` tokens (its *share*), and its sequences take a fixed number of pieces, whatever
their lengths. A sequence is thus full after a count, no length is ever compared with another's, and
each task fills its own sequences. What a piece lacks to its share is padding; as documents may be
cut, a rest that would lack more than ``slack`` of its share is cut at the next smaller share, which
it fills exactly, and what remains is classed in turn (as in the greedy expansion into unit fractions,
two or three cuts do).

Steps:

1. one pass over the documents encodes, cuts and fills; full sequences are final there. The result is
   written to the shared folder, so texts are encoded once and a lost executor costs only a re-read;
2. pieces in sequences that a task could not fill (fewer than one sequence per class and task) are
   numbered within their class over all tasks (a range shuffle, prefix sums over partitions) and
   filled by the same count;
3. what remains is less than one sequence per class: at most ``sum(capacity // share - 1)`` pieces
   (about 10,000 for 2048), whatever the data. One task packs them by first-fit decreasing.

Sequences of step 3 have ids from 0 (fewer than the capacity), those of step 2 from the capacity on, those
of step 1 from 2**33 on, ``(task + 1) << 33 | number``. A sequence holds at most ``capacity`` tokens, its pieces lie without gaps from offset 0, padding
comes last (a sequence whose length is a power of two needs none).

Defined results: null text is empty (a document of the end id alone); repeated rows and ids are
documents of their own; a null id stays null; a document longer than the capacity fills sequences of
its own and only its rest is classed; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import frame, id_text, worker_cache
from roomledger.llm.vocabularies import ByteLevel
from roomledger.operators.numbering import ascending, number_large
from roomledger.session import stage

SLACK = 1 / 32  # share of its place that a piece may leave empty
TASK_BITS = 33
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, share long, sequence_id long, offset long"
ROWS = 20_000  # pieces in one batch of the result


def cuts(rest: int, capacity: int, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, share) of the pieces that ``rest`` < ``capacity`` tokens are cut into."""
    pieces = []
    while rest:
        per_sequence = capacity // rest
        share = capacity // per_sequence
        if share - rest > slack * share:
            share = capacity // (per_sequence + 1)
        pieces.append((min(rest, share), share))
        rest -= pieces[-1][0]
    return pieces


class Filler:
    """Sequences of one task: a class's sequence closes with its last piece."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}

    def add(self, share: int, piece: tuple) -> list[tuple]:
        """The rows that are final with this piece (none while its sequence has room)."""
        waiting = self.open.setdefault(share, [])
        waiting.append(piece)
        if len(waiting) < self.capacity // share:
            return []
        del self.open[share]
        rows, offset = [], 0
        for found in waiting:
            rows.append((*found, self.next_id, offset))
            offset += found[2]
        self.next_id += 1
        return rows

    def rest(self) -> list[tuple]:
        return [(*piece, None, None) for waiting in self.open.values() for piece in waiting]


def fill(
    docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, capacity: int, slack: float, with_ids: bool
) -> DataFrame:
    """Step 1: one row per piece; ``sequence_id`` is null where the task could not fill the sequence."""
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def ordered(rows: list[tuple]) -> list[tuple]:
        """The filler puts sequence and offset behind the ids, the schema before them."""
        return [(*row[:6], *row[7:], row[6]) for row in rows] if with_ids else rows

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = worker_cache(("packing", tokenizer_path), lambda: ByteLevel(tokenizer_path, pattern))
        plans = worker_cache(("packing", capacity, slack), lambda: [cuts(n, capacity, slack) for n in range(capacity)])
        filler = Filler(capacity, (TaskContext.get().partitionId() + 1) << TASK_BITS)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, no_id, text in zip(batch["doc_id"].tolist(), batch["no_id"].tolist(), batch["text"], strict=True):
                ids = np.append(encoder.encode(text, special=True), end_id).astype("<u4")
                data, total, start = memoryview(ids.tobytes()), len(ids), 0
                whole, rest = divmod(total, capacity)
                for length, share in [(capacity, capacity)] * whole + plans[rest]:
                    own = data[4 * start : 4 * (start + length)]
                    piece = (None if no_id else doc_id, start, length, zlib.crc32(own), total, share)
                    if with_ids:
                        piece = (*piece, ids[start : start + length].astype(np.int32))
                    rows += filler.add(share, piece)
                    start += length
                    if len(rows) >= ROWS:
                        yield frame(ordered(rows), schema)
                        rows = []
        yield frame(ordered(rows + filler.rest()), schema)

    # Pandas would read a column of longs with nulls as doubles, so null ids travel as a flag.
    rows = id_text(docs).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    return rows.mapInPandas(pack, schema)


def fill_across_tasks(left: DataFrame, capacity: int) -> DataFrame:
    """Step 2: number the pieces of each class over all tasks, fill by count; what is short stays null."""
    order = ascending(["share", "doc_id", "start", "length", "ids_crc32"])
    numbered = number_large(left.drop("sequence_id", "offset"), order, "_number")
    per = F.floor(F.lit(capacity) / F.col("share")).cast("long")
    # One row per class (about 90 for a capacity of 2048), so their running total is a small window.
    classes = numbered.groupBy("share").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_pieces"))
    before = Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.floor(F.col("_pieces") / per).cast("long")
    classes = classes.withColumn("_filled", filled).withColumn("_base", F.lit(capacity) + F.coalesce(F.sum("_filled").over(before), F.lit(0)))
    placed = numbered.join(F.broadcast(classes), "share").withColumn("_rank", F.col("_number") - F.col("_first"))
    placed = placed.withColumn("_bin", F.floor(F.col("_rank") / per).cast("long"))
    within = Window.partitionBy("share", "_bin").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    is_full = F.col("_bin") < F.col("_filled")
    return placed.withColumn("offset", F.when(is_full, F.coalesce(F.sum("length").over(within), F.lit(0)))).withColumn(
        "sequence_id", F.when(is_full, F.col("_base") + F.col("_bin"))
    )


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each piece, longest pieces first, each into the first sequence with room."""
    used: list[int] = []
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((n for n, taken in enumerate(used) if taken + lengths[i] <= capacity), len(used))
        if at == len(used):
            used.append(0)
        sequence[i], offset[i] = at, used[at]
        used[at] += lengths[i]
    return sequence, offset


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    end_id: int = 1,
    capacity: int = 2048,
    slack: float = SLACK,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, share[, ids]."""
    pieces = stage(fill(docs, tokenizer_path, pattern, end_id, capacity, slack, with_ids), "packed")
    names = pieces.columns
    full = pieces.where(F.col("sequence_id").isNotNull())
    second = stage(fill_across_tasks(pieces.where(F.col("sequence_id").isNull()), capacity).select(*names), "packed-rest")
    done = second.where(F.col("sequence_id").isNotNull())
    short = second.where(F.col("sequence_id").isNull())

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=False, kind="stable", ignore_index=True)
        sequence, offset = first_fit(group["length"].tolist(), capacity)
        return group.assign(sequence_id=sequence, offset=offset)[names]

    # Less than one sequence per class: bounded by the capacity, not by the data.
    # Ids travel as text, as pandas would read longs with nulls as doubles.
    texts = short.withColumn("doc_id", F.col("doc_id").cast("string"))
    last = texts.groupBy().applyInPandas(place, texts.schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    return full.unionByName(done).unionByName(last)


def sequences(pieces: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens): the sequences themselves, from pieces packed ``with_ids``.

    Padded to the capacity, except where the length is a power of two. A sequence has at most
    ``capacity`` pieces, so its array is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"), F.sum("length").alias("n_tokens"))
    size = F.col("n_tokens")
    lacking = F.when(size.bitwiseAND(size - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - size)
    return joined.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), lacking.cast("int"))).alias("ids"), "n_tokens")
