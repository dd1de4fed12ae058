"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints. A text's words (A-Z lower-cased, split at ASCII white space) give overlapping shingles,
each hashed with XXH64; bit i of the 64-bit fingerprint is 1 if bit i is set in over half the hashes.

Links. Two fingerprints within ``2 r`` bits have a common variant within ``r`` bits of both. Every
distinct fingerprint emits all its variants within ``r`` bits (2081 for r = 2), and variants are
shuffled to the partition that owns them; fingerprints that meet at a variant are a candidate pair.

The shuffle is packed. Variants are dealt out by a linear hash, the parity of the variant under a few
fixed masks (``code``), and code(x ^ e) = code(x) ^ code(e): a partition can tell from x alone which of
x's variants it owns. So a partition gets x once, in a packed block of fingerprints, and makes its
share of the variants there, instead of receiving each as a row of its own. The masks are disjoint, so
that few bits changed give few codes (22 of 64, 37 of 256 for r = 2) and x goes to few partitions. Their
number grows with the number of distinct fingerprints, so that one holds about ``FINGERPRINTS`` at most.

Inside a partition finer masks cut the variants into parts of about ``VARIANTS``. Fingerprints lie in
the order of their codes, so those whose variant by one flip falls into a part are one slice: the work
is in proportion to the variants, however many parts there are.

Colliding pairs are verified by their bit distance. Fingerprints that share a variant are linked to
the smallest one there, not pairwise, and each partition passes on only a spanning forest of its
links; components stay the same and a large group of copies gives a number of links in proportion to
its size. Component ids come from rounds of contraction joins on the forest edges.

Defined results: a null or empty text (or one of white space only) has fingerprint zero and is linked
like any other; repeated rows each give a row; a null doc_id gives a row and never names a component
unless all ids of the component are null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import id_text
from roomledger.session import stage

SEED = 42
BITS = 64
FINGERPRINTS = 2_000_000  # a partition's share of fingerprints; 8 bytes each
VARIANTS = 2_000_000  # variants compared at once
PACKED = 1 << 18  # fingerprints packed at once
LEAST_CODE_BITS = 6


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    last = max(1, len(words) - shingle + 1)
    stops = (starts[min(shingle, len(words)) :] - 1)[:last].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), stops, strict=True)], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, last, 1 << 16):  # long texts in blocks, each bit counted over all of them
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint as a signed long); staged."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    rows = id_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), of("text").alias("fp"))
    return stage(rows, "fingerprints")


def ball(radius: int) -> np.ndarray:
    """All 64-bit differences of at most ``radius`` bits."""
    single = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    shells = [np.zeros(1, dtype=np.uint64)]
    for _ in range(radius):
        grown = np.unique((shells[-1][:, None] | single[None, :]).ravel())
        shells.append(grown[np.bitwise_count(grown) == len(shells)])
    return np.concatenate(shells)


def code(values: np.ndarray, bits: int, finer: int = 0) -> np.ndarray:
    """A linear hash: parities of each value under ``bits`` disjoint masks, above them ``finer`` ones under random masks."""
    rng = np.random.default_rng(SEED)
    single = np.uint64(1) << rng.permutation(BITS).astype(np.uint64)
    masks = [np.bitwise_or.reduce(single[i::bits]) for i in range(bits)]
    masks += [*(rng.integers(0, 1 << 63, size=finer, dtype=np.uint64) * np.uint64(2) + np.uint64(1))]
    out = np.zeros(len(values), dtype=np.int64)
    for i, mask in enumerate(masks):
        out |= (np.bitwise_count(values & mask) & 1).astype(np.int64) << i
    return out


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest fingerprint of the component, other member) for the components of the given links."""
    nodes, ends = np.unique(np.concatenate((left, right)), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        different = label[a] != label[b]
        a, b = a[different], b[different]
    others = label != np.arange(len(nodes))
    return nodes[label[others]], nodes[others]


def repeated(values: np.ndarray) -> np.ndarray:
    """Where the values stand that occur more than once, equal ones side by side."""
    short = ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    ordered = np.sort(short)  # most variants are met once, so only what shares 32 bits of a hash is looked at
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    marked = np.zeros(1 << 16, dtype=bool)
    marked[twice >> np.uint32(16)] = True
    at = np.flatnonzero(np.take(marked, (short >> np.uint32(16)).astype(np.intp))) if len(twice) else np.zeros(0, dtype=np.intp)
    at = at[np.argsort(values[at], kind="stable")]
    same = values[at[1:]] == values[at[:-1]]
    return at[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(at) else at


def meet(fps: np.ndarray, bucket: int, bits: int, radius: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest links among ``fps`` (distinct) that share a variant owned by ``bucket``."""
    flips = ball(radius)
    owned = np.bincount(code(fps, bits), minlength=1 << bits)[code(flips, bits) ^ bucket].sum()
    finer = max(0, int(np.ceil(np.log2(max(1.0, owned / VARIANTS)))))
    codes, flip_codes = code(fps, bits, finer), code(flips, bits, finer)
    order = np.argsort(codes, kind="stable")
    fps, codes = fps[order], codes[order]
    links = []
    for part in range(1 << finer):
        wanted = flip_codes ^ (bucket | part << bits)
        low, high = np.searchsorted(codes, wanted, side="left"), np.searchsorted(codes, wanted, side="right")
        used = np.flatnonzero(high > low)
        low, high = low[used], high[used]
        stops = np.cumsum(high - low)
        variants = np.empty(stops[-1] if len(stops) else 0, dtype=np.uint64)
        for flip, a, b, stop in zip(flips[used], low.tolist(), high.tolist(), stops.tolist(), strict=True):
            np.bitwise_xor(fps[a:b], flip, out=variants[stop - (b - a) : stop])
        at = repeated(variants)
        if not len(at):
            continue
        flip = np.searchsorted(stops, at, side="right")
        variant, rows = variants[at], at - stops[flip] + high[flip]
        order = np.lexsort((fps[rows], variant))
        variant, rows = variant[order], rows[order]
        first = np.concatenate(([True], variant[1:] != variant[:-1]))
        smallest = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
        pair = np.unique(smallest[~first] * len(fps) + rows[~first])
        a, b = fps[pair // len(fps)], fps[pair % len(fps)]
        near = np.bitwise_count(a ^ b) <= distance
        links.append(forest(a[near], b[near]))
    if not links:
        return fps[:0], fps[:0]
    return forest(np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links]))


def code_bits(count: int, radius: int) -> int:
    """Enough parities that a partition's share of ``count`` fingerprints stays within bounds."""
    bits, flips = LEAST_CODE_BITS, ball(radius)
    while count * len(np.unique(code(flips, bits))) / 2**bits > FINGERPRINTS:
        bits += 1
    return bits


def links(distinct: DataFrame, count: int, distance: int) -> DataFrame:
    """a < b (as unsigned numbers): forest links between fingerprints at most ``distance`` bits apart.

    Two members of one variant are at most twice the radius apart, so all of them link to its smallest
    when that is the distance. An odd distance lies between two radii, where that does not hold: it is refused.
    """
    if distance < 0 or distance % 2:
        raise ValueError("the distance must be an even number of bits")
    radius = distance // 2
    bits = code_bits(count, radius)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flip_codes = np.unique(code(ball(radius), bits))

        def blocks(fps: np.ndarray) -> Iterator[pd.DataFrame]:
            codes = code(fps, bits)
            order = np.argsort(codes, kind="stable")
            fps, stops = fps[order], np.searchsorted(codes[order], np.arange(1 << bits), side="right").tolist()
            by_code = [fps[a:b] for a, b in zip([0, *stops], stops, strict=False)]
            for bucket in range(1 << bits):
                block = b"".join(by_code[c] for c in flip_codes ^ bucket)
                if block:
                    yield pd.DataFrame({"bucket": [bucket], "block": [block]})

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch["fp"].to_numpy().view(np.uint64))
            if sum(map(len, held)) >= PACKED:
                yield from blocks(np.concatenate(held))
                held = []
        if held:
            yield from blocks(np.concatenate(held))

    def join(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(np.frombuffer(b"".join(blocks["block"]), dtype=np.uint64))
        a, b = meet(fps, int(key[0]), bits, radius, distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    packed = distinct.mapInPandas(pack, "bucket long, block binary")
    return packed.groupBy("bucket").applyInPandas(join, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node (as signed numbers) of each node's component; only nodes with links.

    Alternates two local steps until nothing changes: every node's larger neighbours move to its
    smallest neighbour, then its smaller neighbours do. Each step is an aggregation and a join on
    the node, written to the shared folder; the number of rounds grows with the logarithm of the
    longest path.
    """

    def to_smallest(pairs: DataFrame, larger: bool) -> DataFrame:
        """pairs: (u, v), both directions; links from ``v`` to the smallest of u and its neighbours."""
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = pairs.join(least, "u")
        kept = joined.filter(F.col("v") > F.col("u")) if larger else joined.filter(F.col("v") <= F.col("u"))
        return kept.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")

    def signature(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    current = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while before != (now := signature(current)):
        before = now
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = to_smallest(both, True).distinct()
        down = large.unionByName(large.select("u", F.col("u").alias("v")))
        current = stage(to_smallest(down, False).distinct(), "links")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def rooted(marked: DataFrame, distance: int) -> DataFrame:
    """fp, root: the component of each distinct fingerprint."""
    distinct = stage(marked.select("fp").distinct(), "distinct")
    roots = components(links(distinct, distinct.count(), distance))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint, component_id (the smallest doc_id that chains of links reach)."""
    marked = fingerprints(docs, shingle)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    grouped = rooted(marked, distance).join(least, "fp")
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of each component, the one of the smallest id (then text hash), with all its columns.

    Whole texts are shuffled only for rows that share id and text with another row.
    """
    marked = fingerprints(docs, shingle)
    rows = marked.groupBy("fp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    ranked = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "copies")
    least = rows.groupBy("fp").agg(F.min(ranked).alias("least")).join(rooted(marked, distance), "fp")
    chosen = stage(least.groupBy("root").agg(F.min("least").alias("kept")).select("kept.*"), "kept")
    same = docs["doc_id"].cast("long").eqNullSafe(chosen["doc_id"])
    same &= F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == chosen["text_hash"]
    single = docs.join(chosen.filter("copies = 1"), same, "left_semi")
    repeated = docs.join(chosen.filter("copies > 1"), same, "left_semi")
    # The rows of one id may be of several components, so copies are told by the pair that chose them.
    pair = {"_kept_id": F.col("doc_id").cast("long"), "_kept_hash": F.xxhash64(F.coalesce("text", F.lit("")))}
    return single.unionByName(repeated.withColumns(pair).dropDuplicates([*pair]).drop(*pair))
