"""Token ids as length-delimited binary records with a separate offset index.

Record layout, little-endian:

    u64 payload length | u32 masked checksum of the length | payload | u32 masked checksum of the payload | '\\n'

The payload is an i64 document id, a flag byte (1: the id is null) and the token ids, as u16 where
every id fits and u32 otherwise (the width is in the flag byte's second bit). Checksums are CRC-32,
masked by rotation and a constant as in the common record formats, so that a checksum stored inside
checksummed data is harmless. The trailing newline is the separator of Spark's text writer, through
which the files go: it runs on any store Spark can write to and commits each task's file once, also
when an executor is lost and the task runs again.

Files hold documents in ascending id order (nulls first): one range shuffle on (id, input position),
so a repeated id is split as well. Their number follows the measured bytes of text (``FILE_BYTES`` each at most),
so a file stays small enough to be read whole by a task, whatever the size of the corpus. The index (file,
offset, length, id, start, count) is made by scanning the files where they lie, verifying both checksums of each
record, and is what a shuffled reader joins its permuted document list with.

Texts are encoded as the tokenizers library does by default: a string of an added token inside a text becomes
that token's id.

Defined results: null text is empty (a record with only the end id); repeated rows are records of
their own; an empty table gives no record; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomledger.llm.common import frame as rows_frame
from roomledger.llm.common import id_text, worker_cache
from roomledger.llm.vocabularies import WordEnds
from roomledger.session import default_parallelism, stage, staging_path

HEAD, HEAD_SIZE = "<QI", 12
TAIL, TAIL_SIZE = "<I", 4
IDENT, IDENT_SIZE = "<qB", 9
NULL_ID, WIDE = 1, 2
MASK_DELTA = 0xA282EAD8  # fixed value of the masked-checksum formats
FILE_BYTES = 128 << 20  # bytes of text in one file
INDEX_SCHEMA = (
    "file string, record long, offset long, length long, doc_id long, in_file_start long, n_tokens long, ids_crc32 long"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    """One record without its final newline."""
    flags = (NULL_ID if doc_id is None else 0) | (WIDE if wide else 0)
    payload = struct.pack(IDENT, doc_id or 0, flags) + ids.astype("<u4" if wide else "<u2").tobytes()
    return struct.pack(HEAD, len(payload), masked(struct.pack("<Q", len(payload)))) + payload + struct.pack(TAIL, masked(payload))


def unframe(data: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, next offset) of the record at ``offset``; raises on a damaged record."""
    size, check = struct.unpack_from(HEAD, data, offset)
    if masked(bytes(data[offset : offset + 8])) != check:
        raise ValueError(f"damaged record length at offset {offset}")
    start = offset + HEAD_SIZE
    payload = bytes(data[start : start + size])
    if len(payload) != size or masked(payload) != struct.unpack_from(TAIL, data, start + size)[0]:
        raise ValueError(f"damaged record at offset {offset}")
    doc_id, flags = struct.unpack_from(IDENT, payload)
    ids = np.frombuffer(payload, dtype="<u4" if flags & WIDE else "<u2", offset=IDENT_SIZE)
    return (None if flags & NULL_ID else doc_id), ids, start + size + TAIL_SIZE + 1


def file_count(docs: DataFrame, text_col: str = "text") -> int:
    """As many files as the session has shuffle partitions, or as the text's bytes ask for."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(default_parallelism(docs.sparkSession), -(-size // FILE_BYTES))


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, files: int | None = None) -> None:
    """Encode whole texts, append ``end_id`` to each and write the record files under ``path``."""
    rows = id_text(docs, spread=False).withColumn("_position", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("_position")]
    ranged = rows.repartitionByRange(files or file_count(docs), *order)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_cache(("word_ends", tokenizer_path), lambda: WordEnds(tokenizer_path))
        wide = encoder.size > 1 << 16
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                yield pd.DataFrame(
                    {
                        "frame": [
                            frame(None if no_id else doc_id, np.append(encoder.encode(text), np.uint32(end_id)), wide)
                            for doc_id, no_id, text in zip(part["doc_id"].tolist(), part["no_id"].tolist(), part["text"], strict=True)
                        ]
                    }
                )

    # Pandas would read a column of longs with nulls as doubles, so null ids travel as a flag.
    flagged = ranged.sortWithinPartitions(*order).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text"
    )
    framed = flagged.mapInPandas(encode, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite").text(path)


def record_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the record files; a file is one task's to read, and none is shuffled."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Scan and verify the record files; one index row per record, staged as a table of its own."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data, offset, start, rows = memoryview(content), 0, 0, []
                while offset < len(data):
                    doc_id, ids, after = unframe(data, offset)
                    wide = ids.astype("<u4").tobytes()
                    rows.append((name, len(rows), offset, after - offset, doc_id, start, len(ids), zlib.crc32(wide)))
                    offset, start = after, start + len(ids)
                yield rows_frame(rows, INDEX_SCHEMA)

    found = stage(record_files(spark, path).mapInPandas(scan, INDEX_SCHEMA), "record-index")
    # One row per file: the running total over files is a window over a table bounded by their number.
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("_tokens"))
    before = F.sum("_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("file", F.coalesce(before, F.lit(0)).alias("_before"))
    return found.join(F.broadcast(bases), "file").withColumn("start", F.col("_before") + F.col("in_file_start"))


def read_records(spark: SparkSession, index: DataFrame, path: str, seed: int = 0) -> DataFrame:
    """(position, doc_id, ids): the indexed records cut out of their files, in an order shuffled by ``seed``.

    ``position`` hashes a record's place and the seed; a reader takes a range of positions. Each file is read
    once where it lies and only its records are shuffled, first to their index rows, then to their positions.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data, offset, rows = memoryview(content), 0, []
                while offset < len(data):
                    size = struct.unpack_from(HEAD, data, offset)[0]
                    after = offset + HEAD_SIZE + size + TAIL_SIZE + 1
                    rows.append((name, offset, bytes(data[offset:after])))
                    offset = after
                yield rows_frame(rows, "file string, offset long, record binary")

    records = record_files(spark, path).mapInPandas(cut, "file string, offset long, record binary")
    pieces = index.select("file", "offset").join(records, ["file", "offset"])
    position = F.xxhash64("file", "offset", F.lit(seed)).alias("position")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for place, record in zip(batch["position"].tolist(), batch["record"], strict=True):
                doc_id, ids, _ = unframe(memoryview(record), 0)
                rows.append((place, doc_id, ids.astype(np.int64)))
            yield rows_frame(rows, "position long, doc_id long, ids array<long>")

    return pieces.select(position, "record").orderBy("position").mapInPandas(parse, "position long, doc_id long, ids array<long>")


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the records below the shared folder and return per document what the files hold."""
    spark = docs.sparkSession
    path = staging_path(spark, "records")
    write_records(docs, path, tokenizer_path, end_id)
    return build_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
