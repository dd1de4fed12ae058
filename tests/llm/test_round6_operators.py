"""SimHash's search for shared variants in many parts, and where fingerprints are sent."""

from __future__ import annotations

import time

import numpy as np
import pytest

from roomledger.llm import simhash


def chained(count: int) -> np.ndarray:
    """Distinct fingerprints; a part of them in chains of a few bits' steps, some in one dense group."""
    rng = np.random.default_rng(count)
    found = list(rng.integers(0, 1 << 63, count // 2, dtype=np.uint64) * np.uint64(2))
    for at in range(count // 4):
        bits = rng.choice(64, rng.integers(1, 6), replace=False)
        found.append(found[rng.integers(at + 1)] ^ np.uint64(sum(1 << int(i) for i in bits)))
    found += list(found[0] ^ rng.integers(0, 1 << 10, count // 4, dtype=np.uint64))
    return np.unique(np.array(found, dtype=np.uint64))


def roots(fps: np.ndarray, bits: int) -> dict[int, int]:
    met = [simhash.meet(fps, bucket, bits, 2, 4) for bucket in range(1 << bits)]
    low, member = simhash.forest(*(np.concatenate([pair[i] for pair in met]) for i in (0, 1)))
    return dict(zip(member.tolist(), low.tolist(), strict=True))


@pytest.mark.parametrize("variants", [2_000_000, 500])
def test_components_are_those_of_all_pairs_in_one_part_and_in_many(monkeypatch, variants):
    fps = chained(400)
    near = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4).astype(int)
    while ((wider := (near @ near > 0).astype(int)) != near).any():
        near = wider
    want = {int(f): int(fps[row.argmax()]) for f, row in zip(fps, near, strict=True) if fps[row.argmax()] != f}
    monkeypatch.setattr(simhash, "VARIANTS", variants)
    assert 50 < len(want) < len(fps) and roots(fps, 6) == want


def test_many_parts_cost_little_more_than_one(monkeypatch):
    """The parts of a bucket grow with the table. Before: 9.9 CPU seconds here, 0.3 after."""
    rng = np.random.default_rng(8)
    fps = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    monkeypatch.setattr(simhash, "VARIANTS", 1000)
    began = time.thread_time()
    simhash.meet(fps, 7, 6, 2, 4)
    assert time.thread_time() - began < 4


@pytest.mark.parametrize("count", [1000, 3_000_000, 14_000_000, 100_000_000])
def test_a_fingerprint_is_sent_to_few_partitions(count):
    """Before, from 8 million on: to 1,670 of 4,096, 13 KB for each fingerprint, more than a document has."""
    bits = simhash.code_bits(count, 2)
    sent = len(np.unique(simhash.code(simhash.ball(2), bits)))
    assert sent * 8 < 1000 and count * sent / 2**bits <= simhash.FINGERPRINTS


def test_links_of_more_fingerprints_than_are_packed_at_once(spark, monkeypatch):
    """With partitions of few fingerprints, so that each is sent to 79 of 4,096 or fewer."""
    monkeypatch.setattr(simhash, "FINGERPRINTS", 20)
    monkeypatch.setattr(simhash, "PACKED", 64)
    fps = chained(600)
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(2)
    assert simhash.code_bits(len(fps), 2) > 8
    linked = simhash.links(frame, len(fps), 4).collect()
    ends = (np.array([r[i] for r in linked], dtype=np.int64).view(np.uint64) for i in (0, 1))
    low, member = simhash.forest(*ends)
    assert dict(zip(member.tolist(), low.tolist(), strict=True)) == roots(fps, 6)
