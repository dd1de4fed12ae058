"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each partition.

Encoding. Text is cut by the vocabulary's pattern into pieces. Pieces that are tokens need no merge;
the others become token-position rows (piece, position, token) of a DuckDB table, one row per byte.
A recursive query joins adjacent rows with the merge table, finds each piece's pair of smallest rank
(leftmost on ties), contracts it, and goes on with the pieces that changed until none has a pair
left. In short pieces a step also contracts every other pair that nothing can come before: no merge of
smaller or equal rank takes its left token with a token that ends in the byte before, or its right token with
one that begins with the byte after. In long pieces, where no merge that contains the new token can
have a smaller rank, all non-overlapping occurrences of the pair are contracted in the same step. Both
give the same tokens in fewer steps. A query makes at most ``MAX_STEPS`` steps and is resumed from its
last state, so its memory is bounded for pieces of any length.

Decoding. The id stream is cut before every token that starts with a space (a property of the
vocabulary, not of the encoder); the distinct runs of a batch become (run, position, token) rows that
DuckDB joins with the vocabulary and puts together by an ordered aggregation.

Chunks of text and runs of ids repeat a lot: Arrow's dictionaries find the distinct ones of a batch, and each
worker keeps the results of recent pieces and runs in bounded caches. Texts, caches and results stay in Arrow's
arrays: as Python's objects they would take several times the memory, and a worker gets what the JVM's heap leaves.
Chunks are cut at single spaces between other characters, where the pattern always begins a new piece.

Defined results: null text is empty (no ids, digest of nothing); repeated rows each give a row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from roomledger.llm.common import id_text, release_memory, worker_cache

MAX_STEPS = 48
SHORT_BYTES = 64  # longer pieces go through LONG_SQL
BATCH_BYTES = 400_000  # bytes of pieces in one recursive query
BATCH_CHARS = 2_000_000  # characters of text handled at once
CACHE_ENTRIES = 250_000  # of each generation of each cache

#: The smallest pair of each piece and those that nothing can come before, for the short pieces that make up nearly all text.
SHORT_SQL = f"""
WITH RECURSIVE state(step, piece, pos, tok, before, here) AS (
    SELECT 0, piece, pos, tok, before, here FROM start_rows
    UNION ALL
    (WITH paired AS (
        SELECT piece, pos, tok, before, lead(tok) OVER w AS next_tok, lead(piece) OVER w AS next_piece, lead(pos) OVER w AS next_pos,
               CASE WHEN lead(piece, 2) OVER w = piece THEN lead(here, 2) OVER w ELSE -1 END AS after
        FROM state WHERE step < {MAX_STEPS} WINDOW w AS (ORDER BY pos)
    ), ranked AS (
        SELECT piece, pos, next_pos, merged, tok * 512 + before AS left_key, next_tok * 512 + after AS right_key
        FROM paired JOIN merges ON pair = tok * 65536::BIGINT + next_tok WHERE next_piece = piece
    ), best AS (
        SELECT piece, min((merged::BIGINT << 32) + pos) AS score FROM ranked GROUP BY piece
    ), chosen AS (
        SELECT pos, next_pos, merged FROM ranked JOIN best USING (piece)
        LEFT JOIN lefts USING (left_key) LEFT JOIN rights USING (right_key)
        WHERE (merged::BIGINT << 32) + pos = score
           OR (coalesce(left_least, {1 << 30}) > merged AND coalesce(right_least, {1 << 30}) > merged)
    ), changes AS (
        SELECT pos, merged FROM chosen UNION ALL SELECT next_pos, -1 FROM chosen
    )
    SELECT s.step + 1, s.piece, s.pos, coalesce(c.merged, s.tok), s.before, s.here
    FROM state s SEMI JOIN best ON s.piece = best.piece LEFT JOIN changes c ON s.pos = c.pos
    WHERE coalesce(c.merged, 0) >= 0)
), finished AS (
    SELECT piece, max(step) AS step FROM state GROUP BY piece
)
SELECT piece, pos, tok, step, before, here FROM state JOIN finished USING (piece, step) ORDER BY pos
"""

#: The smallest pair of each piece, in all its occurrences where that cannot change the result.
LONG_SQL = f"""
WITH RECURSIVE state(step, piece, pos, tok) AS (
    SELECT 0, piece, pos, tok FROM start_rows
    UNION ALL
    (WITH paired AS (
        SELECT step, piece, pos, tok * 65536::BIGINT + lead(tok) OVER w AS pair,
               lead(piece) OVER w AS next_piece, lead(pos) OVER w AS next_pos, row_number() OVER w AS idx
        FROM state WHERE step < {MAX_STEPS} WINDOW w AS (ORDER BY pos)
    ), ranked AS (
        SELECT piece, pos, next_pos, idx, merged, every FROM paired JOIN merges USING (pair) WHERE next_piece = piece
    ), best AS (
        SELECT piece, min((merged::BIGINT << 32) + pos) AS score FROM ranked GROUP BY piece
    ), chosen AS (
        SELECT pos, next_pos, idx, merged, idx - row_number() OVER (ORDER BY pos) AS run
        FROM ranked JOIN best USING (piece)
        WHERE merged = score >> 32 AND (every OR pos = score % 4294967296)
    ), contracted AS (
        SELECT pos, next_pos, merged FROM chosen QUALIFY (idx - min(idx) OVER (PARTITION BY run)) % 2 = 0
    ), changes AS (
        SELECT pos, merged FROM contracted UNION ALL SELECT next_pos, -1 FROM contracted
    )
    SELECT s.step + 1, s.piece, s.pos, coalesce(c.merged, s.tok)
    FROM state s SEMI JOIN best ON s.piece = best.piece LEFT JOIN changes c ON s.pos = c.pos
    WHERE coalesce(c.merged, 0) >= 0)
), finished AS (
    SELECT piece, max(step) AS step FROM state GROUP BY piece
)
SELECT piece, pos, tok, step FROM state JOIN finished USING (piece, step) ORDER BY pos
"""

DECODE_SQL = """
SELECT run, string_agg(chars, '' ORDER BY pos) AS chars
FROM run_rows JOIN vocabulary USING (tok) GROUP BY run ORDER BY run
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RecentBytes:
    """A bounded cache of two generations of Arrow arrays: before a batch that finds the young one full, the old one goes."""

    def __init__(self, entries: int):
        import pyarrow as pa

        none = pa.array([], pa.large_binary())
        self.entries, self.young, self.old = entries, (none, none), (none, none)

    def values_of(self, keys, make):
        """The value of each of the distinct ``keys``; ``make`` gives those of a list of keys that neither generation has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.young[0]) >= self.entries:
            none = self.young[0].slice(0, 0)
            self.old, self.young = self.young, (none, none)
        own = pc.index_in(keys, value_set=self.young[0])
        absent = keys.filter(own.is_null())
        again = pc.index_in(absent, value_set=self.old[0])
        new = absent.filter(again.is_null())
        kept, again = absent.filter(again.is_valid()), again.drop_null()
        values = [self.young[1], self.old[1].take(again), pa.array(make(new.to_pylist()), pa.large_binary())]
        self.young = pa.concat_arrays([self.young[0], kept, new]), pa.concat_arrays(values)
        return self.young[1].take(pc.index_in(keys, value_set=self.young[0]))


class Codec:
    """A vocabulary's merge and token tables in an in-memory DuckDB of the worker's own."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import pyarrow as pa
        import regex

        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_token = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        left, right, merged = [], [], []
        lefts: dict[int, int] = {}  # (a merge's right token, last byte of its left one) -> smallest rank
        rights: dict[int, int] = {}  # (a merge's left token, first byte of its right one) -> smallest rank
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if token[:cut] in self.ranks and token[cut:] in self.ranks:
                    left.append(self.ranks[token[:cut]])
                    right.append(self.ranks[token[cut:]])
                    merged.append(rank)
                    for least, key in ((lefts, right[-1] * 512 + token[cut - 1]), (rights, left[-1] * 512 + token[cut])):
                        least[key] = min(rank, least.get(key, rank))
        left, right, merged = (np.array(x, dtype=np.int64) for x in (left, right, merged))
        lowest = np.full(int(merged.max(initial=255)) + 1 + len(self.ranks), np.iinfo(np.int64).max)
        np.minimum.at(lowest, left, merged)  # the smallest rank of a merge that has the token as a part
        np.minimum.at(lowest, right, merged)
        self._register(
            "merge_rows",
            pa.table({"pair": left * 65536 + right, "merged": merged.astype(np.int32), "every": lowest[merged] > merged}),
        )
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        for side, least in (("left", lefts), ("right", rights)):
            rows = {f"{side}_key": pa.array(least.keys(), pa.int32()), f"{side}_least": pa.array(least.values(), pa.int32())}
            self._register(f"{side}_rows", pa.table(rows))
            self.db.execute(f"CREATE TABLE {side}s AS SELECT * FROM {side}_rows")
        # Bytes as characters 0 to 255: tokens need not be valid UTF-8 on their own.
        ids = np.fromiter(self.ranks.values(), dtype=np.int32)
        self._register("token_rows", pa.table({"tok": ids, "chars": [t.decode("latin-1") for t in self.ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM token_rows")
        self.starts_run = np.zeros(int(ids.max()) + 1, dtype=bool)
        self.starts_run[[rank for token, rank in self.ranks.items() if token[:1] == b" "]] = True
        self.pieces, self.runs = RecentBytes(CACHE_ENTRIES), RecentBytes(CACHE_ENTRIES)

    def _register(self, name: str, table) -> None:
        self.db.register(name, table)

    def merge_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece (as u32 bytes), by the recursive query."""
        import pyarrow as pa

        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        short = sizes.max(initial=0) <= SHORT_BYTES
        state = {"piece": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes), "pos": np.arange(len(data), dtype=np.int64)}
        state["tok"] = self.byte_token[data]
        if short:  # the byte before each byte, -1 where a piece begins, and the byte itself
            before = np.concatenate(([-1], data[:-1].astype(np.int32)))[: len(data)]
            before[(np.cumsum(sizes) - sizes)[sizes > 0]] = -1
            state |= {"before": before.astype(np.int32), "here": data.astype(np.int32)}
        found = [b""] * len(pieces)
        while len(state["tok"]):
            self._register("start_rows", pa.table(state))
            rows = self.db.sql(SHORT_SQL if short else LONG_SQL).fetchnumpy()
            unfinished = np.asarray(rows["step"]) == MAX_STEPS
            owner, ids = np.asarray(rows["piece"])[~unfinished], np.asarray(rows["tok"])[~unfinished].astype("<u4").tobytes()
            bounds = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
            for first, stop in zip(bounds, bounds[1:], strict=False):
                if stop > first:
                    found[owner[first]] = ids[4 * first : 4 * stop]
            state = {c: np.asarray(rows[c])[unfinished] for c in state}
        return found

    def piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each of the distinct ``pieces`` (as u32 bytes)."""
        found: list[bytes] = [b""] * len(pieces)
        short, long = [], []
        for at, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                found[at] = rank.to_bytes(4, "little")
            else:
                (short if len(piece) <= SHORT_BYTES else long).append(at)
        for waiting in (short, long):
            queue, size = [], 0
            for number, at in enumerate(waiting):
                queue.append(at)
                size += len(pieces[at])
                if size >= BATCH_BYTES or number == len(waiting) - 1:
                    for own, ids in zip(queue, self.merge_pieces([pieces[n] for n in queue]), strict=True):
                        found[own] = ids
                    queue, size = [], 0
        return found

    def chunk_ids(self, words: list[str], others: list[str]):
        """Ids (as u32 bytes) of each word with a space before it, and then of each other chunk, as an Arrow array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        # The pattern begins a new piece at each word's space, so the words are cut together.
        cut = pa.array(self.pattern.findall(" " + " ".join(words)) if words else [], pa.large_string())
        sizes = pc.binary_length(pa.array(words, pa.large_string())).to_numpy(zero_copy_only=False) + 1
        ends = np.cumsum(pc.binary_length(cut).to_numpy(zero_copy_only=False))
        first = np.searchsorted(np.append(0, ends), np.cumsum(sizes) - sizes)
        odd = [self.pattern.findall(chunk) for chunk in others]
        first = np.concatenate((first, len(cut) + np.cumsum([0, *map(len, odd)])))  # each chunk's first piece, and the end
        cut = pa.concat_arrays([cut, pa.array(chain.from_iterable(odd), pa.large_string())])
        coded = pc.dictionary_encode(cut.cast(pa.large_binary()))
        ids = self.pieces.values_of(coded.dictionary, self.piece_ids).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64, count=len(ids) + 1)[first]
        data = ids.buffers()[2] or pa.py_buffer(b"")
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(ends), data])

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text (of a list or Arrow array): looked up word by word, the distinct words of all texts being cut once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(texts):
            return []
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        split = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(split.flatten())
        words, word = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        after_space = np.array([not w or w[0].isspace() for w in words])
        before_space = np.array([not w or w[-1].isspace() for w in words])
        bounds = split.offsets.to_numpy()
        # A text is cut before each word that stands, like the word before it, without other white space at that place.
        cuts = np.concatenate(([True], ~before_space[word[:-1]] & ~after_space[word[1:]]))
        cuts[bounds[:-1]] = True  # a text has one word at least, perhaps an empty one
        first = np.flatnonzero(cuts)
        stop = np.append(first[1:], len(word))
        alone = stop - first == 1
        alone[np.searchsorted(first, bounds[:-1])] = False  # a text's first chunk has no space before it
        # The other chunks' numbers follow those of the words.
        place, others, numbers = word[first].astype(np.int64), [], {}
        begins = set(bounds[:-1].tolist())
        at = np.flatnonzero(~alone)
        for n, a, b in zip(at.tolist(), first[at].tolist(), stop[at].tolist(), strict=True):
            chunk = "" if a in begins else " "
            chunk += " ".join([words[w] for w in word[a:b].tolist()])
            place[n] = numbers.setdefault(chunk, len(words) + len(numbers))
        others = list(numbers)
        used = np.zeros(len(words) + len(others), dtype=bool)
        used[place] = True
        number = np.cumsum(used) - 1
        known = self.chunk_ids([w for w, own in zip(words, used, strict=False) if own], others)
        return [ids.view("<u4") for ids in pieces_of(known.take(pa.array(number[place])), np.searchsorted(first, bounds))]

    def run_bytes(self, runs: list[bytes]) -> list[bytes]:
        """The bytes of each of the distinct ``runs`` of ids, put together by DuckDB."""
        import pyarrow as pa

        found: list[bytes] = []
        for at in range(0, len(runs), 100_000):
            part = runs[at : at + 100_000]
            lengths = np.array([len(run) // 4 for run in part])
            tokens = np.frombuffer(b"".join(part), dtype="<u4").astype(np.int32)
            rows = {"run": np.repeat(np.arange(len(part), dtype=np.int32), lengths), "pos": np.arange(len(tokens)), "tok": tokens}
            self._register("run_rows", pa.table(rows))
            found.extend(chars.encode("latin-1") for chars in self.db.sql(DECODE_SQL).fetchnumpy()["chars"])  # each run has a row
        return found

    def decode(self, sequences: list[np.ndarray]) -> list[bytes]:
        import pyarrow as pa
        import pyarrow.compute as pc

        if not sequences:
            return []
        sizes = np.array([len(ids) for ids in sequences], dtype=np.int64)
        flat = np.concatenate(sequences).astype("<u4")
        starts = self.starts_run[flat]
        text_starts = np.cumsum(sizes) - sizes
        starts[text_starts[sizes > 0]] = True
        bounds = np.append(np.flatnonzero(starts), len(flat))
        offsets = pa.py_buffer((bounds * 4).astype(np.int64))
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(flat.tobytes())])
        coded = pc.dictionary_encode(cut)
        known = self.runs.values_of(coded.dictionary, self.run_bytes)
        edges = np.searchsorted(bounds, np.append(text_starts, len(flat)))
        return [part.tobytes() for part in pieces_of(known.take(coded.indices), edges)]


def pieces_of(joined, edges: np.ndarray) -> list[np.ndarray]:
    """The bytes of an Arrow binary array's values from each of ``edges`` up to the next."""
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64, count=len(joined) + 1)[edges].tolist()
    data = np.frombuffer(joined.buffers()[2] or b"", dtype=np.uint8)
    return [data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


def slices_of(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of at most ``limit`` in all (or one row)."""
    ends = sizes.cumsum()
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield slice(start, stop)
        start = stop


def batches_of(texts: pd.Series, limit: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of at most ``limit`` characters (or one text)."""
    return slices_of(texts.str.len().to_numpy(), limit)


def codec_udf(path: str, pattern: str, emit):
    """A mapInArrow function: ``emit(doc_ids, ids, codec)`` gives the rows for a slice of the batch."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow.compute as pc

        codec = worker_cache(("byte_bpe", path, pattern), lambda: Codec(path, pattern))
        for batch in batches:
            lengths = pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for part in slices_of(lengths, BATCH_CHARS):
                rows = batch.slice(part.start, part.stop - part.start)
                yield emit(rows.column("doc_id"), codec.encode(rows.column("text")), codec)
                release_memory()

    return run


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes decoded from them, and the ids if asked for."""

    def emit(doc_ids, ids: list[np.ndarray], codec: Codec):
        import pyarrow as pa

        sizes = [len(i) for i in ids]
        out = {
            "doc_id": doc_ids,
            "n_tokens": pa.array(sizes, pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in codec.decode(ids)], pa.string()),
        }
        if with_ids:
            ends = np.cumsum([0, *sizes]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
        return pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return id_text(docs).mapInArrow(codec_udf(path, pattern, emit), schema)
