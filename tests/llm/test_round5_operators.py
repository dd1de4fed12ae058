"""Memory of the byte-level BPE workers and their caches."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import public_tokenizers
import pyarrow as pa
import pytest

from roomledger.llm import byte_bpe, catalog

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WORKER = """
import random, re, sys
from roomledger.llm import byte_bpe

def megabytes(field):
    return int(re.search(field + r":\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

rng = random.Random(1)
codec = byte_bpe.Codec(*sys.argv[1:])
before = megabytes("VmRSS")
for _ in range(8):
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(120_000)]
    texts = [" ".join(words[at : at + 200]) for at in range(0, len(words), 200)]
    assert codec.decode(codec.encode(texts)) == [t.encode() for t in texts]
print(megabytes("VmHWM") - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_that_meets_ever_new_words_stays_small():
    """Two workers share what the heap leaves of an executor. Before: 472 MB here, as caches and batches were Python objects; 333 after."""
    command = [sys.executable, "-c", WORKER, catalog.BYTE_BPE, public_tokenizers.PATTERN]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300, check=True)
    assert float(done.stdout) < 400


def test_recent_bytes_gives_what_was_made_and_forgets_the_oldest():
    made = []

    def make(keys):
        made.extend(keys)
        return [key * 2 for key in keys]

    cache, rng = byte_bpe.RecentBytes(6), random.Random(3)
    for _ in range(200):
        keys = [bytes([k]) * (k % 4) + bytes([k]) for k in rng.sample(range(30), rng.randrange(8))]
        assert cache.values_of(pa.array(keys, pa.large_binary()), make).to_pylist() == [key * 2 for key in keys]
        assert len(cache.young[0]) <= 6 + 8 and len(cache.old[0]) <= 6 + 8
        assert len(set(cache.young[0].to_pylist())) == len(cache.young[0])
    known = cache.young[0].to_pylist()
    made.clear()
    assert cache.values_of(pa.array(known, pa.large_binary()), make).to_pylist() == [key * 2 for key in known]
    assert made == []


def test_ids_of_arrow_texts_are_those_of_a_list():
    codec = byte_bpe.Codec(catalog.BYTE_BPE, public_tokenizers.PATTERN)
    texts = ["", "one two", " x  y\n", "ü é日 two", ""]
    want = [i.tolist() for i in codec.encode(texts)]
    for kind in (pa.string(), pa.large_string()):
        assert [i.tolist() for i in codec.encode(pa.array(["cut", *texts], kind).slice(1))] == want


def test_rows_of_several_slices_keep_their_ids(spark):
    """Slices of a batch, nulls, repeated ids and an id beyond 2**53 beside a null one."""
    rows = [(n // 2, f"text {n} " * n) for n in range(60)] + [(2**53 + 1, None), (None, "x"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    emitted = byte_bpe.round_trip(docs, catalog.BYTE_BPE, public_tokenizers.PATTERN, with_ids=True).collect()
    codec = byte_bpe.Codec(catalog.BYTE_BPE, public_tokenizers.PATTERN)
    want = [(d, i.tolist()) for (d, _), i in zip(rows, codec.encode([t or "" for _, t in rows]), strict=True)]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(((r.doc_id, r.ids) for r in emitted), key=key) == sorted(want, key=key)
    assert [s for s in byte_bpe.slices_of(pa.array([3, 9, 1, 1, 0, 5]).to_numpy(), 5)] == [slice(0, 1), slice(1, 2), slice(2, 5), slice(5, 6)]
