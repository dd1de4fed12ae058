"""Alignment of two tokenizers over a corpus, with counts of linked id pairs by external merging.

Both tokenizers cut the same bytes. Offsets at which a token of each ends cut a document into groups;
the two tokens that end there are linked. How often the corpus links two ids is what the pair counts
say, and each document is told how its links stand among them.

Method, external spill counting:

1. a pass over the documents encodes them and collects (pair, document) records. Whenever ``FLUSH`` links
   have come together they are sorted, summed and written as *runs*, one for each residue of the B id
   modulo the number of radix partitions: zstd frames of the distinct pairs with their counts, and of
   the documents of each pair. All runs go to the shared folder; texts are read and encoded once;
2. each radix partition gets the pair frames of its runs (not the documents') and merges them: a heap holds
   the last pair of every run's loaded block, and what is not above the least of them is final. More
   than ``FAN_IN`` runs are merged in several rounds over a temporary file. The order is B-major, so
   a B id's highest count is known as soon as the next B id begins, and only the pairs of one B
   id wait for it;
3. the totals of a radix partition, then its runs, stream past once more and each run's documents get their
   sums. A frequent B id has more runs than others: its radix partition is dealt into as many chunks as
   its records ask for, each with a copy of the totals;
4. a run's sums are added up over the radix partitions, next to its documents' rows.

A record is never expanded to a row of Spark: shuffles carry compressed runs, the memory of a task is that
of one run, ``FAN_IN`` blocks and the totals of one radix partition (distinct pairs, whatever the text).

Defined results: documents with null or empty text, or whose tokens do not spell the text with a
space in front (as where the text holds the mark that the pieces write for a space), have zeros and an
empty group string; ids may be null or repeated, each row is a document; an empty table gives no rows;
extra columns are ignored; a document's tokens are held in memory together, as its text is.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import frame, id_text, worker_cache
from roomledger.llm.vocabularies import ByteLevel, Pieces
from roomledger.session import default_parallelism, stage

FLUSH = 2_000_000  # links that a task collects before it writes runs
TOGETHER = 1 << 20  # characters of text that are encoded at once
FAN_IN = 64  # runs that are merged at once
BLOCK = 1 << 14  # pairs in one frame of a run
CHUNK = 8_000_000  # records of a radix partition that one task streams back
SPOOL = 16 << 20
WIDTHS = ("u1", "<u2", "<u4", "<u8")

ENCODED = (
    "task int, run int, place int, no_id boolean, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
    "groups string, radix int, records long, pairs binary, docs binary"
)
TOTALS = "radix int, part int, pairs binary, totals binary"
SUMS = "task int, run int, sums binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


# --- frames -------------------------------------------------------------------------------------------------


def squeeze(*columns: np.ndarray) -> bytes:
    """Unsigned columns of one length as a zstd frame, each in the narrowest type that holds it."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        most = int(column.max()) if len(column) else 0
        width = next(n for n, kind in enumerate(WIDTHS) if most < 1 << 8 * np.dtype(kind).itemsize)
        parts += [bytes([width]), column.astype(WIDTHS[width]).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueeze(frame: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    size, at, columns = int.from_bytes(data[:8], "little"), 8, []
    while at < len(data):
        kind = np.dtype(WIDTHS[data[at]])
        columns.append(np.frombuffer(data, kind, size, at + 1))
        at += 1 + size * kind.itemsize
    return columns


def framed(frames: list[bytes]) -> bytes:
    return b"".join(len(frame).to_bytes(8, "little") + frame for frame in frames)


def frames_of(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        yield data[at + 8 : at + 8 + size]
        at += 8 + size


def pair_blocks(pairs: np.ndarray, *columns: np.ndarray) -> Iterator[bytes]:
    """Frames of at most ``BLOCK`` ascending pairs: the first pair, the steps from each to the next, other columns."""
    for at in range(0, len(pairs), BLOCK):
        own = pairs[at : at + BLOCK].astype(np.uint64)
        steps = np.concatenate([[0], np.diff(own)]).astype(np.uint64)
        yield own[:1].tobytes() + squeeze(steps, *(column[at : at + BLOCK] for column in columns))


def unblock(frame: bytes) -> list[np.ndarray]:
    steps, *columns = unsqueeze(frame[8:])
    return [np.frombuffer(frame, "<u8", 1)[0] + np.cumsum(steps, dtype=np.uint64), *columns]


def summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct pairs and the sums of their counts."""
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order].astype(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[starts], np.add.reduceat(counts, starts)


def merged(runs: list[Iterator[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of runs of ascending pairs: final blocks of (pairs, counts) in ascending order."""
    held: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(n: int) -> None:
        frame = next(runs[n], None)
        if frame is not None:
            held[n] = unblock(frame)[:2]
            heapq.heappush(heap, (int(held[n][0][-1]), n))

    for n in range(len(runs)):
        load(n)
    while heap:
        bound, n = heapq.heappop(heap)
        taken = []
        for own in list(held):
            pairs, counts = held[own]
            upto = len(pairs) if own == n else int(np.searchsorted(pairs, np.uint64(bound), side="right"))
            if upto:
                taken.append((pairs[:upto], counts[:upto]))
                held[own] = [pairs[upto:], counts[upto:]]
        del held[n]
        if taken:  # else another run ended with the same pair
            yield summed(np.concatenate([p for p, _ in taken]), np.concatenate([c for _, c in taken]))
        load(n)


# --- pass 1: documents to runs ------------------------------------------------------------------------------


class Vocabularies:
    """The two tokenizers, and how a link of their ids is written as a number in radix-major, B-major order."""

    def __init__(self, a_path: str, pattern: str, b_path: str, radixes: int):
        self.a, self.b, self.radixes = ByteLevel(a_path, pattern), Pieces(b_path), radixes
        self.per_radix = -(-self.b.size // radixes)
        ends = ((b",", b"|"), (b",", b";", b""))
        self.spelled = [b"%d%s" % (i, end) for i in range(self.a.size) for end in ends[0]]
        self.spelled += [b"%d%s" % (i, end) for i in range(self.b.size) for end in ends[1]]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        own = b.astype(np.uint64)
        radix, place = own % np.uint64(self.radixes), own // np.uint64(self.radixes)
        return (radix * np.uint64(self.per_radix) + place) * np.uint64(self.a.size) + a.astype(np.uint64)

    def ids(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a, b) of pair numbers."""
        side, a = np.divmod(pairs, np.uint64(self.a.size))
        radix, place = np.divmod(side, np.uint64(self.per_radix))
        return a.astype(np.int64), (place * np.uint64(self.radixes) + radix).astype(np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both id sequences of each text; none where either does not spell it."""
        found = []
        for text, b in zip(texts, self.b.encode(texts), strict=True):
            data = (" " + text).encode()
            a = self.a.encode(" " + text, special=False)
            spells = text and b"".join(map(self.b.bytes_of.__getitem__, b)) == data
            spells = spells and b"".join(map(self.a.bytes_of.__getitem__, a.tolist())) == data
            found.append((a, np.array(b, dtype=np.int64)) if spells else None)
        return found


class Aligned:
    """Documents laid end to end: their tokens, links and groups, as arrays over all of them."""

    def __init__(self, own: Vocabularies, tokens: list[tuple[np.ndarray, np.ndarray]]):
        self.n_a, self.n_b = (np.array([len(t[side]) for t in tokens]) for side in (0, 1))
        a, b = (np.concatenate([t[side] for t in tokens]).astype(np.int64) for side in (0, 1))
        a_end, b_end = np.cumsum(own.a.lengths[a]), np.cumsum(own.b.lengths[b])
        at_a, at_b = (np.zeros(a_end[-1] + 1, dtype=bool) for _ in range(2))
        at_a[a_end] = at_b[b_end] = True
        a_linked, b_linked = at_b[a_end], at_a[b_end]
        a_last, b_last = np.flatnonzero(a_linked), np.flatnonzero(b_linked)  # of each group
        self.a, self.b = a[a_last], b[b_last]
        # Groups end where documents do, so the groups of the first n documents are those up to their last token.
        upto = np.searchsorted(a_last, np.cumsum(self.n_a) - 1, side="right")
        self.n_links = np.diff(upto, prepend=0)
        # Where a token stands when the groups are written out: after its own side's tokens and the other's of the
        # groups before (for B: and of its own group).
        a_group, b_group = np.cumsum(a_linked) - a_linked, np.cumsum(b_linked) - b_linked
        place_a = np.arange(len(a)) + np.concatenate([[0], b_last + 1])[a_group]
        place_b = np.arange(len(b)) + (a_last + 1)[b_group]
        ends = np.where(b_linked, 1, 0)
        ends[np.cumsum(self.n_b) - 1] = 2
        self.keys = np.empty(len(a) + len(b), dtype=np.int64)
        self.keys[place_a] = 2 * a + a_linked
        self.keys[place_b] = 2 * own.a.size + 3 * b + ends
        self.spelled = own.spelled
        self.upto = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])

    def groups(self, n: int) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of document ``n``."""
        return b"".join(map(self.spelled.__getitem__, self.keys[self.upto[n] : self.upto[n + 1]].tolist()))


def runs_of(own: Vocabularies, pairs: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(radix, records, pair frames, document frame) of the links ``pairs`` in documents ``docs``."""
    bits = np.uint64(max(1, int(docs.max()).bit_length()))
    links = np.sort(pairs << bits | docs.astype(np.uint64))
    starts = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
    times = np.diff(starts, append=len(links)).astype(np.uint64)
    pairs, docs = links[starts] >> bits, links[starts] & ((np.uint64(1) << bits) - np.uint64(1))
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    found, counts = pairs[starts], np.add.reduceat(times, starts)
    shared = np.diff(starts, append=len(pairs)).astype(np.uint64)
    starts = np.append(starts, len(pairs))
    edges = np.searchsorted(found, np.arange(own.radixes + 1, dtype=np.uint64) * np.uint64(own.per_radix * own.a.size))
    for radix in np.flatnonzero(np.diff(edges)).tolist():
        low, high = edges[radix], edges[radix + 1]
        part = slice(starts[low], starts[high])
        frames = framed(list(pair_blocks(found[low:high], counts[low:high], shared[low:high])))
        yield radix, int(starts[high] - starts[low]), frames, squeeze(docs[part], times[part])


def encode_runs(docs: DataFrame, a_path: str, pattern: str, b_path: str, radixes: int, with_groups: bool = False) -> DataFrame:
    """Rows of documents (``radix`` null) and of runs (``radix`` set), of each task and flush."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own = worker_cache(("align", a_path, b_path, radixes), lambda: Vocabularies(a_path, pattern, b_path, radixes))
        task, run, place, links = TaskContext.get().partitionId(), 0, 0, []

        def documents(part: pd.DataFrame) -> list[tuple]:
            nonlocal place
            found = own.encode(part["text"].tolist())
            tokens = [t for t in found if t]
            aligned = Aligned(own, tokens) if tokens else None
            rows, n = [], 0
            for (no_id, doc_id), spelled in zip(part[["no_id", "doc_id"]].itertuples(index=False, name=None), found, strict=True):
                if spelled is None:
                    rows.append((task, run, None, no_id, doc_id, 0, 0, 0, "", "" if with_groups else None, *[None] * 4))
                    continue
                groups = aligned.groups(n)
                counts = (int(aligned.n_a[n]), int(aligned.n_b[n]), int(aligned.n_links[n]))
                text = groups.decode() if with_groups else None
                rows.append((task, run, place + n, no_id, doc_id, *counts, hashlib.sha256(groups).hexdigest(), text, *[None] * 4))
                n += 1
            if tokens:
                links.append((own.pair(aligned.a, aligned.b), np.repeat(np.arange(place, place + n), aligned.n_links)))
                place += n
            return rows

        def flush() -> list[tuple]:
            nonlocal run, place, links
            pairs, places = (np.concatenate([link[side] for link in links]) for side in (0, 1))
            rows = [(task, run, *[None] * 8, *found) for found in runs_of(own, pairs, places)]
            run, place, links = run + 1, 0, []
            return rows

        for batch in batches:
            together = (batch["text"].str.len().cumsum() // TOGETHER).to_numpy()
            for n in np.unique(together):
                yield frame(documents(batch[together == n]), ENCODED)
                if sum(len(pairs) for pairs, _ in links) >= FLUSH:
                    yield frame(flush(), ENCODED)
        if links:
            yield frame(flush(), ENCODED)

    # Pandas would read a column of longs with nulls as doubles, so null ids travel as a flag.
    rows = id_text(docs).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    return rows.mapInPandas(encode, ENCODED)


# --- pass 2: runs to totals ---------------------------------------------------------------------------------


def spooled(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[bytes]:
    """The frames of a merged run, from a temporary file that goes to disk beyond ``SPOOL`` bytes."""
    with tempfile.SpooledTemporaryFile(max_size=SPOOL) as file:
        for pairs, counts in blocks:
            for frame in pair_blocks(pairs, counts):
                file.write(len(frame).to_bytes(8, "little") + frame)
        file.seek(0)
        while size := file.read(8):
            yield file.read(int.from_bytes(size, "little"))


def merge_all(runs: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All runs merged, ``FAN_IN`` at a time: beyond that, level by level through temporary files."""
    levels: list[list[Iterator[bytes]]] = [[]]
    for run in runs:
        levels[0].append(frames_of(run))
        level = 0
        while len(levels[level]) == FAN_IN:
            whole = spooled(merged(levels[level]))
            first = next(whole)  # merges now, so that the runs themselves can go
            levels[level] = []
            level += 1
            if level == len(levels):
                levels.append([])
            levels[level].append(chained(first, whole))
    yield from merged([run for level in levels for run in level])


def chained(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def with_maxima(blocks: Iterator[tuple[np.ndarray, np.ndarray]], a_size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, totals, is the highest of its B id) for blocks that come in B-major order."""
    pairs, totals = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def known(pairs, totals):
        side = pairs // np.uint64(a_size)
        starts = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        highest = np.repeat(np.maximum.reduceat(totals, starts), np.diff(starts, append=len(side)))
        return pairs, totals, totals == highest

    for more, counts in blocks:
        pairs, totals = np.concatenate([pairs, more]), np.concatenate([totals, counts])
        side = pairs // np.uint64(a_size)
        waiting = int(np.searchsorted(side, side[-1]))  # the last B id may have more pairs
        if waiting:
            yield known(pairs[:waiting], totals[:waiting])
            pairs, totals = pairs[waiting:], totals[waiting:]
    if len(pairs):
        yield known(pairs, totals)


def count_pairs(encoded: DataFrame, a_size: int) -> DataFrame:
    """The totals of every radix partition, as frames of (pairs, totals, is highest) in order."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch[["radix", "pairs"]].itertuples(index=False, name=None))
        for radix, own in groupby(rows, key=itemgetter(0)):
            for part, (pairs, totals, best) in enumerate(with_maxima(merge_all(pairs for _, pairs in own), a_size)):
                frames = framed(list(pair_blocks(pairs, totals, best.astype(np.uint64))))
                yield pd.DataFrame({"radix": [radix], "part": [part], "pairs": [frames], "totals": [b""]})

    runs = encoded.where(F.col("radix").isNotNull()).select("radix", "task", "run", "pairs")
    # The frames hold the totals too; the last column only gives totals and runs one shape in pass 3.
    return runs.repartition("radix").sortWithinPartitions("radix", "task", "run").mapInPandas(merge, TOTALS)


def pair_counts(encoded: DataFrame, a_path: str, pattern: str, b_path: str, radixes: int) -> DataFrame:
    """The counted pairs themselves: a_id, b_id, links, is_best."""
    a_size = vocabulary_size(a_path, pattern)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = worker_cache(("align", a_path, b_path, radixes), lambda: Vocabularies(a_path, pattern, b_path, radixes))
        for batch in batches:
            for block in (block for data in batch["pairs"] for block in frames_of(data)):
                pairs, totals, best = unblock(block)
                a, b = own.ids(pairs)
                yield pd.DataFrame({"a_id": a, "b_id": b, "links": totals.astype(np.int64), "is_best": best.astype(bool)})

    return count_pairs(encoded, a_size).select("pairs").mapInPandas(spell, "a_id long, b_id long, links long, is_best boolean")


def vocabulary_size(a_path: str, pattern: str) -> int:
    return worker_cache(("align", a_path), lambda: ByteLevel(a_path, pattern)).size


# --- pass 3 and 4: totals back to documents -----------------------------------------------------------------


def contributions(encoded: DataFrame, totals: DataFrame) -> DataFrame:
    """(task, run, sums): what each radix partition adds to the documents of each run."""
    runs = encoded.where(F.col("radix").isNotNull())
    # One row per radix partition, of which there are as many as shuffle partitions: small enough to send.
    sizes = runs.groupBy("radix").agg(F.ceil(F.sum("records") / CHUNK).cast("int").alias("chunks"))
    runs = runs.join(F.broadcast(sizes), "radix").select(
        "radix", F.pmod(F.xxhash64("task", "run"), "chunks").cast("int").alias("chunk"), "task", "run", "pairs", "docs"
    )
    copies = totals.join(F.broadcast(sizes), "radix").select(
        "radix", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(-1).alias("task"),
        F.col("part").alias("run"), "pairs", F.col("totals").alias("docs"),
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["radix", "chunk", "task", "run", "pairs", "docs"]
        rows = (row for batch in batches for row in batch[columns].itertuples(index=False, name=None))
        for _, own in groupby(rows, key=itemgetter(0, 1)):
            known, pending = None, []
            for _, _, task, run, frames, docs in own:
                if task < 0:  # totals come first
                    pending += [unblock(frame) for frame in frames_of(frames)]
                    continue
                if known is None:
                    known, pending = [np.concatenate([block[n] for block in pending]) for n in range(3)], []
                blocks = [unblock(frame) for frame in frames_of(frames)]
                pairs, _, shared = (np.concatenate([block[n] for block in blocks]) for n in range(3))
                at = np.repeat(np.searchsorted(known[0], pairs), shared.astype(np.int64))
                places, times = unsqueeze(docs)
                times = times.astype(np.int64)
                sums = np.zeros((2, int(places.max()) + 1), dtype=np.int64)
                np.add.at(sums[0], places, times * known[2][at].astype(np.int64))
                np.add.at(sums[1], places, times * known[1][at].astype(np.int64))
                yield pd.DataFrame({"task": [task], "run": [run], "sums": [squeeze(*sums)]})

    both = runs.unionByName(copies).repartition("radix", "chunk")
    return both.sortWithinPartitions("radix", "chunk", "task", "run").mapInPandas(stream, SUMS)


def add_up(encoded: DataFrame, sums: DataFrame) -> DataFrame:
    """The documents' rows with the sums of their run."""
    plain = ["place", "no_id", "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "groups"]
    docs = encoded.where(F.col("radix").isNull()).select("task", "run", *plain, F.lit(None).cast("binary").alias("sums"))
    docs = docs.withColumn("place", F.coalesce("place", F.lit(-1)))
    blank = {"place": F.lit(-2), "no_id": F.lit(False), "groups_sha256": F.lit(""), "groups": F.lit("")}
    parts = sums.select("task", "run", *(blank.get(c, F.lit(0).cast("long")).alias(c) for c in plain), "sums")

    def attach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, np.zeros((2, 0), dtype=np.int64)
        for batch in batches:
            rows = []
            for task, run, place, no_id, doc_id, n_a, n_b, n_links, digest, groups, part in batch[
                ["task", "run", *plain, "sums"]
            ].itertuples(index=False, name=None):
                if key != (task, run):
                    key, total = (task, run), np.zeros((2, 0), dtype=np.int64)
                if place == -2:  # sums come first
                    more = np.stack([column.astype(np.int64) for column in unsqueeze(part)])
                    if more.shape[1] > total.shape[1]:
                        more, total = total, more
                    total[:, : more.shape[1]] += more
                    continue
                best, count = total[:, place].tolist() if place >= 0 else (0, 0)
                rows.append((None if no_id else doc_id, n_a, n_b, n_links, n_links, best, count, digest, groups))
            yield frame(rows, RESULT)

    # A run has a bounded number of links, so its documents and sums are a small group.
    both = docs.unionByName(parts).repartition("task", "run").sortWithinPartitions("task", "run", "place")
    return both.mapInPandas(attach, RESULT)


def align(
    docs: DataFrame, a_path: str, pattern: str, b_path: str, with_groups: bool = False, radixes: int | None = None
) -> DataFrame:
    """Per document: tokens of each side, groups, links, links with the highest count of their B id, sum of counts."""
    radixes = radixes or default_parallelism(docs.sparkSession)
    encoded = stage(encode_runs(docs, a_path, pattern, b_path, radixes, with_groups), "align-runs")
    totals = stage(count_pairs(encoded, vocabulary_size(a_path, pattern)), "align-totals")
    found = add_up(encoded, contributions(encoded, totals))
    return found if with_groups else found.drop("groups")
