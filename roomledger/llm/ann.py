"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

Equal vectors are one node of the graph; a node keeps the ``k + 1`` smallest ids that share its vector,
which is all that a list of ``k`` nearest can show of them.

Start. Each of a few passes orders all nodes by (nearest of a fixed number of random pivots,
projection on a random direction), cuts the order into blocks of equal size and lists each node's
nearest within its block. A hot pivot is many blocks, and no block is larger than ``BLOCK``.

NN-descent. In a round every node gathers its neighbours and up to ``MEET`` of the nodes it is a neighbour of (the
new ones first, by distance), with their vectors; any two that meet there, one of them new, are neighbours
of a neighbour and become candidates of each other. Each member passes on its best few; lists are merged.
An entry stays new until it has met the others at its node. Rounds go on until fewer than ``LEAST_CHANGE``
of the list entries change, ``ROUNDS`` at most. The graph is written to the shared folder every round.

Search. All queries walk at once: the best entries of a query's list that have not been expanded are
joined with the graph, their neighbours not seen before with the vectors, distances are taken in double
precision, and the best ``BEAM`` are kept, until no query has an entry left to expand.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do vectors of another than the most frequent length; ids that repeat with different vectors are
separate rows; a query's own row is not among its candidates; fewer candidates than ``k`` are all
returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import stage

NEIGHBOURS = 32
PASSES = 6
PIVOTS = 64  # per pass; the only vectors that are sent to every task
BLOCK = 512
MEET = NEIGHBOURS  # all of a node's own list, and as many of the lists it is on, meet in a round
PASSED_ON = 10
ROUNDS = 10
LEAST_CHANGE = 0.02
BEAM = 256
EXPAND = 64
SEARCH_ROUNDS = 100
SEED = 42


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter((F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # negative zero is zero
    return rows.withColumn("size", F.size("v"))


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """node (smallest id), v, members (the k + 1 smallest ids): one row per distinct vector; staged."""
    rows = stage(usable(vectors), "vectors")
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    rows = rows.filter(F.col("size") == (sizes[0]["size"] if sizes else 0))
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("h2"))
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    kept = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    nodes = kept.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("node"), F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("members")
    )
    return stage(nodes.select("node", "v", "members"), "nodes")


def matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def packed(values: np.ndarray) -> pa.Array:
    """One binary per row of a 2-d array."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """The rows of a binary column whose values have one length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of ``a`` and ``b`` (with leading axes, per batch)."""
    cross = a @ np.swapaxes(b, -1, -2)
    return np.maximum((a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * cross, 0)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches' rows in tables of ``rows`` rows (the last may have fewer), in order."""
    waiting: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            batch = batch.slice(part.num_rows)
            waiting.append(part)
            count += part.num_rows
            if count == rows:
                yield pa.Table.from_batches(waiting)
                waiting, count = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


LISTS = "node long, ids binary, far binary"


def block_lists(nodes: DataFrame, number: int, k: int) -> DataFrame:
    """One pass of the start: lists of at most k nearest within blocks."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(SEED + number))).limit(PIVOTS).select("v").collect()
    pivots = np.array([row.v for row in sample], dtype=np.float32)
    direction = np.random.default_rng(SEED + number).normal(size=pivots.shape[1]).astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), batch.num_rows).astype(np.float32)
            leaf = squared(v, pivots).argmin(axis=1).astype(np.int32)
            yield pa.record_batch(
                [batch.column("node"), packed(v), pa.array(leaf), pa.array((v @ direction).astype(np.float64))],
                names=["node", "v", "leaf", "along"],
            )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, BLOCK):
            ids, v = block["node"].to_numpy(), unpacked(block["v"].combine_chunks(), "<f4")
            far = squared(v, v)
            np.fill_diagonal(far, np.inf)
            some = min(k, len(ids) - 1)
            best = np.argpartition(far, some - 1, axis=1)[:, :some] if some > 0 else np.zeros((len(ids), 0), dtype=np.int64)
            yield pa.record_batch(
                [block["node"].combine_chunks(), packed(ids[best]), packed(np.take_along_axis(far, best, axis=1).astype("<f4"))],
                names=["node", "ids", "far"],
            )

    placed = nodes.select("node", "v").mapInArrow(place, "node long, v binary, leaf int, along double")
    ordered = placed.repartitionByRange("leaf", "along", "node").sortWithinPartitions("leaf", "along", "node")
    return ordered.select("node", "v").mapInArrow(nearest, LISTS)


def merged(lists: DataFrame, k: int) -> DataFrame:
    """node, ids, far, fresh: the k nearest of each node's lists; ``fresh`` marks ids no old list had.

    ``lists`` has the column ``old``: whether a row is the node's list of the round before.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def combine(table: pa.Table) -> pa.RecordBatch:
            sizes = np.array([len(x) // 8 for x in table["ids"].to_pylist()])
            node = np.repeat(table["node"].to_numpy(), sizes)
            old = np.repeat(table["old"].to_numpy(zero_copy_only=False), sizes)
            ids = np.frombuffer(b"".join(table["ids"].to_pylist()), dtype="<i8")
            far = np.frombuffer(b"".join(table["far"].to_pylist()), dtype="<f4")
            order = np.lexsort((~old, ids, node))  # an id's old entry comes first
            node, ids, far, old = node[order], ids[order], far[order], old[order]
            first = np.ones(len(node), dtype=bool)
            first[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1])
            node, ids, far, old = node[first], ids[first], far[first], old[first]
            order = np.lexsort((ids, far, node))
            node, ids, far, old = node[order], ids[order], far[order], old[order]
            owners, starts, counts = np.unique(node, return_index=True, return_counts=True)
            starts, stops = starts.tolist(), (starts + np.minimum(counts, k)).tolist()
            cut = lambda values: [values[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]
            return pa.record_batch(
                [pa.array(owners), pa.array(cut(ids), pa.binary()), pa.array(cut(far), pa.binary()), pa.array(cut(~old), pa.binary())],
                names=["node", "ids", "far", "fresh"],
            )

        held: pa.Table | None = None
        for batch in batches:  # rows of a node are adjacent; the last node of a batch may go on in the next
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            ends = table["node"].to_numpy() != table["node"][-1].as_py()
            whole = int(ends.sum())
            if whole:
                yield combine(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None and held.num_rows:
            yield combine(held)

    grouped = lists.select("node", "ids", "far", "old").repartition("node").sortWithinPartitions("node")
    return grouped.mapInArrow(merge, "node long, ids binary, far binary, fresh binary")


def meetings(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate lists (node, ids, far) from one local join: members of a node's neighbourhood meet there."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) // 8 for x in batch.column("ids").to_pylist()])
            join = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=kind)
            yield pa.record_batch(
                [
                    pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                    pa.array(join("ids", "<i8")),
                    pa.array(join("far", "<f4")),
                    pa.array(join("fresh", "?")),
                ],
                names=["a", "b", "far", "fresh"],
            )

    pairs = graph.mapInArrow(edges, "a long, b long, far float, fresh boolean")
    both = pairs.select(F.col("a").alias("at"), F.col("b").alias("member"), "far", "fresh", F.lit(0).alias("way")).unionByName(
        pairs.select(F.col("b").alias("at"), F.col("a").alias("member"), "far", "fresh", F.lit(1).alias("way"))
    )
    order = Window.partitionBy("at", "way").orderBy(F.desc("fresh"), "far", "member")
    chosen = both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= MEET)
    members = chosen.groupBy("at", "member").agg(F.max("fresh").alias("fresh"))
    small = F.transform("v", lambda x: x.cast("float")).alias("v")
    with_vectors = members.join(nodes.select(F.col("node").alias("member"), small), "member")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def local(table: pa.Table) -> pa.RecordBatch:
            at, member = table["at"].to_numpy(), table["member"].to_numpy()
            fresh, v = table["fresh"].to_numpy(zero_copy_only=False), matrix(table["v"], table.num_rows).astype(np.float32)
            starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(at)])))
            width, owner, ids_out, far_out = 2 * MEET, [], [], []
            for first in range(0, len(starts), 512):
                own, size = starts[first : first + 512], sizes[first : first + 512]
                index = own[:, None] + np.minimum(np.arange(width), size[:, None] - 1)
                real = np.arange(width) < size[:, None]
                far = squared(v[index], v[index])
                useful = real[:, :, None] & real[:, None, :] & (fresh[index][:, :, None] | fresh[index][:, None, :])
                useful &= ~np.eye(width, dtype=bool)
                far = np.where(useful, far, np.inf)
                best = np.argpartition(far, PASSED_ON - 1, axis=2)[:, :, :PASSED_ON]
                near = np.take_along_axis(far, best, axis=2)
                ids = np.take_along_axis(np.broadcast_to(member[index][:, None, :], far.shape), best, axis=2)
                keep = real & np.isfinite(near).any(axis=2)
                # Places without a candidate repeat the best one, which the merge takes once.
                ids = np.where(np.isfinite(near), ids, np.take_along_axis(ids, near.argmin(axis=2)[:, :, None], axis=2))
                near = np.where(np.isfinite(near), near, near.min(axis=2, keepdims=True))
                owner.append(member[index][keep])
                ids_out.append(ids[keep])
                far_out.append(near[keep].astype("<f4"))
            return pa.record_batch(
                [pa.array(np.concatenate(owner)), packed(np.concatenate(ids_out)), packed(np.concatenate(far_out))],
                names=["node", "ids", "far"],
            )

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            whole = int((table["at"].to_numpy() != table["at"][-1].as_py()).sum())
            if whole:
                yield local(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None and held.num_rows:
            yield local(held)

    met = with_vectors.select("at", "member", "fresh", "v").repartition("at").sortWithinPartitions("at")
    return met.mapInArrow(meet, LISTS)


def build(nodes: DataFrame, count: int, k: int = NEIGHBOURS) -> DataFrame:
    """node, ids, far, fresh: the neighbour graph over ``count`` nodes."""
    start = block_lists(nodes, 0, k)
    for number in range(1, PASSES):
        start = start.unionByName(block_lists(nodes, number, k))
    graph = stage(merged(start.withColumn("old", F.lit(False)), k), "graph")
    for _ in range(ROUNDS):
        own = graph.select("node", "ids", "far", F.lit(True).alias("old"))
        found = meetings(graph, nodes).withColumn("old", F.lit(False))
        graph = stage(merged(own.unionByName(found), k), "graph")
        changed = graph.agg(F.sum(F.length(F.replace(F.hex("fresh"), F.lit("00"), F.lit(""))) / 2)).first()[0] or 0
        if changed < LEAST_CHANGE * count * k:
            break
    return graph


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """query (a node), node, score: the best entries that the greedy walks find, the query's own first."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) // 8 for x in batch.column("ids").to_pylist()])
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype="<i8")
            yield pa.record_batch(
                [pa.array(np.repeat(batch.column("node").to_numpy(), sizes)), pa.array(ids)], names=["node", "next"]
            )

    links = stage(graph.select("node", "ids").mapInArrow(spread, "node long, next long"), "links")
    vectors = nodes.select("node", "v")
    asked = stage(queries.join(vectors, "node").select(F.col("node").alias("query"), F.col("v").alias("q")), "queries")
    state = asked.select("query", F.col("query").alias("node"), F.lit(0.0).alias("score"), F.lit(False).alias("done"))
    # A few nodes chosen by hash are further entries, for parts of the graph the own node does not reach.
    entries = vectors.orderBy(F.xxhash64("node")).limit(EXPAND)
    reached = asked.join(F.broadcast(entries)).select("query", "node", distance(F.col("q"), F.col("v")).alias("score"))
    state = state.unionByName(reached.withColumn("done", F.lit(False)))
    best = Window.partitionBy("query").orderBy("score", "node")
    for _ in range(SEARCH_ROUNDS):
        state = state.groupBy("query", "node").agg(F.min("score").alias("score"), F.max("done").alias("done"))
        state = state.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= BEAM)
        open_place = F.row_number().over(Window.partitionBy("query", "done").orderBy("place"))
        state = state.withColumn("expand", ~F.col("done") & (open_place <= EXPAND))
        state = stage(state, "search")
        frontier = state.filter("expand").select("query", "node")
        if frontier.isEmpty():
            break
        seen = state.select("query", "node")
        fresh = frontier.join(links, "node").select("query", F.col("next").alias("node")).distinct().join(seen, ["query", "node"], "left_anti")
        scored = fresh.join(vectors, "node").join(asked, "query")
        scored = scored.select("query", "node", distance(F.col("q"), F.col("v")).alias("score"), F.lit(False).alias("done"))
        walked = state.select("query", "node", "score", (F.col("done") | F.col("expand")).alias("done"))
        state = walked.unionByName(scored)
    return state.select("query", "node", "score")


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    nodes = nodes_of(vectors, k)
    count = nodes.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = build(nodes, count)
    asking = usable(vectors).filter(F.col("vec_id") % every == 0)
    own = asking.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("h2"))
    keyed = nodes.select("node", "members", F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("h2"))
    queries = stage(own.distinct().join(keyed, ["h1", "h2"]).select("query_id", "node"), "asked")
    found = search(graph, nodes, queries.select("node").distinct())
    members = nodes.select("node", F.explode("members").alias("vec_id"))
    place = Window.partitionBy("query").orderBy("score", "vec_id")
    # k + 1, as one of them may be the query's own row.
    rows = found.join(members, "node").withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
    answers = queries.select("query_id", F.col("node").alias("query")).join(rows, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
