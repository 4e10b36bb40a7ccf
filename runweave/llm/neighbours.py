"""Approximate nearest neighbours by cosine: an NN-descent graph, and greedy search on it.

Vectors whose directions are equal in float32 are one node. The graph starts from random hyperplane blocks and is refined by
joins of neighbours of neighbours, until a round changes next to nothing: around each node, the vectors of its
neighbours in both directions are brought together and compared with each other. A query walks the graph from its own
node, a beam of the best nodes at a time, until all of the beam are expanded.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runweave.llm import words
from runweave.llm.store import Workspace

#: Neighbours kept for a node, hyperplane divisions, and the size of a block in which all vectors are compared.
DEGREE, DIVISIONS, BLOCK = 20, 6, 1500
#: Rounds of neighbours of neighbours end when one changes no more than this share of the graph's edges.
CHANGED = 0.01
#: Nodes that a query keeps, all of which it expands.
BEAM = 192
#: Different vector lengths in a table, each of which has a graph of its own; more is an error.
LENGTHS = 100
#: Nodes and queries whose vectors a task of the search holds at once.
NODES_AT_ONCE, QUERIES_AT_ONCE = 16_384, 2_048


def _hash(data: bytes) -> int:
    buf = np.frombuffer(data, np.uint8)
    return int(words.signed(words.span_hashes(buf, np.array([0]), np.array([len(buf)])))[0])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes of float32 under the hash of their direction in float32 (node) and in float64 (exact).

    Vectors are scaled by their largest component first, so no finite one over- or underflows. Rows without a direction
    are left out.
    """
    for batch in batches:
        ids, hashes, exact, units = [], [], [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if vec_id is None or not vector or None in vector:
                continue
            x = np.array(vector, np.float64)
            if not np.isfinite(x).all() or not x.any():
                continue
            x = _scaled(x)
            # + 0.0: no negative zeros, which are equal but hash apart
            unit = (x / math.sqrt(float(x @ x))).astype("<f4") + np.float32(0)
            ids.append(vec_id)
            units.append(unit.tobytes())
            hashes.append(_hash(units[-1]))
            exact.append(_hash((x / np.abs(x).max() + 0.0).astype("<f8").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(exact, pa.int64()), pa.array(units, pa.binary())],
            ["vec_id", "node", "exact", "unit"])


def _scaled(x: np.ndarray) -> np.ndarray:
    """The vector times a power of two, which changes no digit, so that its largest component is near 1."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f4").reshape(len(rows), -1) if rows else np.zeros((0, 1), np.float32)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each key, from batches sorted by it; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if held and keys[low] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield current, pa.Table.from_batches(held)


EDGE = "a long, b long, sim float"


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float32())],
                                      ["a", "b", "sim"])


def _compare_block(degree: int):
    """The best neighbours of each vector in its block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _groups(batches, "block"):
            nodes, x = block.column("node").to_numpy(), _matrix(block.column("unit"))
            best = min(degree, len(nodes) - 1)
            if best < 1:
                continue
            sims = x @ x.T
            np.fill_diagonal(sims, -9)
            top = np.argpartition(-sims, best - 1, axis=1)[:, :best]
            yield _edges(np.repeat(nodes, best), nodes[top].ravel(), np.take_along_axis(sims, top, 1).ravel())
    return run


def _compare_around():
    """All better partners that the vectors around a node find among each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = [], 0
        for _, group in _groups(batches, "centre"):
            nodes, x = group.column("member").to_numpy(), _matrix(group.column("unit"))
            sims = x @ x.T
            np.fill_diagonal(sims, -9)
            i, j = np.nonzero(sims > group.column("worst").to_numpy()[:, None])
            out.append((nodes[i], nodes[j], sims[i, j]))
            rows += len(i)
            if rows > 50_000:
                yield _edges(*(np.concatenate(c) for c in zip(*out)))
                out, rows = [], 0
        if rows:
            yield _edges(*(np.concatenate(c) for c in zip(*out)))
    return run


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The `degree` most similar partners of each node."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("rank", rank).where(F.col("rank") <= degree)


def _projected(dimensions: int, bits: int, more: int):
    """For each division, the side of `bits` planes as a first block, and the places along `more` other directions."""
    planes = [np.random.default_rng(100 + d).normal(size=(dimensions, bits + more)).astype(np.float32) for d in range(DIVISIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("unit"))
            for division, own in enumerate(planes):
                at = x @ own
                codes = (at[:, :bits] > 0) @ (1 << np.arange(bits))
                places = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * more),
                                                  pa.array(np.ascontiguousarray(at[:, bits:]).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), division, np.int32)), batch.column("node"), pa.array(codes, pa.int64()), places],
                    ["division", "node", "block", "places"])
    return run


def _blocks(work: Workspace, nodes: DataFrame, dimensions: int, bits: int) -> DataFrame:
    """(node, block) of DIVISIONS divisions into blocks of at most about 2 * BLOCK nodes that lie close together.

    A crowded block is halved at the median along a further direction, so nodes of a hot direction are told apart too.
    """
    more = 2 * bits + 8
    blocks = work.keep(nodes.mapInArrow(_projected(dimensions, bits, more),
                                        "division int, node long, block long, places array<float>"), "blocks-0")
    for level in range(more):
        place = F.get("places", F.lit(level))
        crowded = blocks.groupBy("division", "block").agg(
            F.count("*").alias("k"), F.percentile_approx(place, 0.5, 1000).alias("middle")).where(F.col("k") > 2 * BLOCK)
        crowded = work.keep(crowded.select("division", "block", "middle"), f"crowded-{level}")
        if not crowded.take(1):
            break
        half = F.when(F.col("middle").isNull(), F.col("block")).otherwise(F.xxhash64("block", place > F.col("middle")))
        blocks = work.keep(blocks.join(crowded, ["division", "block"], "left").select(
            "division", "node", half.alias("block"), "places"), f"blocks-{level + 1}")
        work.drop(f"blocks-{level}")
    # what no direction divides (places that are equal in float32) is dealt by the nodes' hashes
    full = blocks.groupBy("division", "block").agg(F.count("*").alias("k"))
    return blocks.join(full, ["division", "block"]).select("node", F.xxhash64("division", "block", F.pmod(
        F.xxhash64("node", "division"), F.ceil(F.col("k") / (2 * BLOCK)))).alias("block"))


def build_graph(work: Workspace, nodes: DataFrame, dimensions: int, count: int) -> DataFrame:
    """(a, b, sim): the approximate DEGREE nearest neighbours of every node."""
    bits = max(0, math.ceil(math.log2(max(1, count) / BLOCK)))
    if bits:
        blocks = _blocks(work, nodes, dimensions, bits).join(nodes, "node")
    else:
        blocks = nodes.withColumn("block", F.lit(0).cast("long"))
    first = blocks.select("node", "unit", "block").repartition("block").sortWithinPartitions("block").mapInArrow(
        _compare_block(DEGREE), EDGE)
    graph = work.keep(_best(first, DEGREE), "graph-0")
    for k in itertools.count(1) if bits else ():
        worst = graph.groupBy("a").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
        worst = worst.select(F.col("a").alias("member"), F.when(F.col("n") < DEGREE, F.lit(-2.0)).otherwise(F.col("worst")).cast("float").alias("worst"))
        around = graph.select(F.col("a").alias("centre"), F.col("b").alias("member"))
        # of a node that very many others point to, DEGREE drawn anew in each round; the others keep it as neighbour
        draw = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", "b", F.lit(k))))
        back = graph.withColumn("draw", draw).where(F.col("draw") <= DEGREE)
        around = around.union(back.select(F.col("b").alias("centre"), F.col("a").alias("member"))).distinct()
        carried = nodes.select(F.col("node").alias("member"), "unit").join(worst, "member")
        around = around.join(carried, "member").repartition("centre").sortWithinPartitions("centre")
        found = around.mapInArrow(_compare_around(), EDGE)
        before, graph = graph, work.keep(_best(graph.select("a", "b", "sim").union(found), DEGREE), f"graph-{k}")
        # edges are only replaced by better ones, so the rounds come to an end
        new = graph.join(before.select("a", "b"), ["a", "b"], "left_anti").count()
        work.drop(f"graph-{k - 1}")
        if new <= CHANGED * graph.count():
            break
    return graph.select("a", "b", "sim")


_PART = "query long, node long, unit binary, kind int, part long"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, node, sim) of the pairs of each part, from its nodes' vectors (kind 0), queries' (1) and pairs (2)."""
    part, vectors = None, [{}, {}]
    for batch in batches:
        kinds, parts = batch.column("kind").to_numpy(), batch.column("part").to_numpy()
        cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (parts[1:] != parts[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)]):
            if low == high:
                continue
            if parts[low] != part:
                part, vectors = parts[low], [{}, {}]
            some, kind = batch.slice(low, high - low), int(kinds[low])
            if kind < 2:
                names = some.column("node" if kind == 0 else "query").to_pylist()
                vectors[kind].update(zip(names, _matrix(some.column("unit"))))
                continue
            queries, nodes = some.column("query").to_pylist(), some.column("node").to_pylist()
            for at in range(0, len(nodes), 20_000):
                q, n = queries[at:at + 20_000], nodes[at:at + 20_000]
                left = np.stack([vectors[1][x] for x in q])
                right = np.stack([vectors[0][x] for x in n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(n, pa.int64()), pa.array(np.einsum("ij,ij->i", left, right))],
                    ["query", "node", "sim"])


def _measured(pairs: DataFrame, nodes: DataFrame, queries: DataFrame, node_parts: int, query_parts: int) -> DataFrame:
    """Similarities of (query, node) pairs, part by part of the queries and the nodes; only ids travel with the pairs."""
    seat = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    none = lambda kind: F.lit(None).cast(kind)
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    a = nodes.select(none("long").alias("query"), "node", "unit", F.lit(0).alias("kind"), spread(query_parts).alias("o"))
    b = queries.select(F.col("node").alias("query"), none("long").alias("node"), "unit", F.lit(1).alias("kind"),
                       spread(node_parts).alias("o"))
    a = a.withColumn("part", F.col("o") * node_parts + seat("node", node_parts)).drop("o")
    b = b.withColumn("part", seat("query", query_parts) * node_parts + F.col("o")).drop("o")
    c = pairs.select("query", "node", none("binary").alias("unit"), F.lit(2).alias("kind"),
                     (seat("query", query_parts) * node_parts + seat("node", node_parts)).alias("part"))
    rows = a.union(b).union(c).repartition("part").sortWithinPartitions("part", "kind")
    return rows.mapInArrow(_measure, "query long, node long, sim float")


def search_graph(work: Workspace, graph: DataFrame, nodes: DataFrame, queries: DataFrame, count: int,
                 beam: int = BEAM, keep: int = 24) -> DataFrame:
    """(query, node): the best `keep` nodes of each query's beam; queries are nodes themselves and start where they are.

    A step expands all nodes of the beams that are not expanded yet; the search ends when no query has one left.
    """
    links = work.keep(graph.select("a", "b").union(graph.select("b", "a")).distinct(), "links")
    node_parts = max(1, math.ceil(count / NODES_AT_ONCE))
    query_parts = max(1, math.ceil(queries.count() / QUERIES_AT_ONCE))
    seen = work.keep(queries.select(F.col("node").alias("query"), "node", F.lit(9.0).cast("float").alias("sim"),
                                    F.lit(False).alias("done")), "seen-0")
    for k in itertools.count(1):
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "node"))
        ranked = seen.withColumn("open", (rank <= beam + 1) & ~F.col("done"))
        opened = work.keep(ranked.where("open").select("query", "node"), f"opened-{k}")
        if not opened.take(1):
            break
        reached = opened.select("query", F.col("node").alias("a")).join(links, "a").select(
            "query", F.col("b").alias("node")).distinct().join(seen, ["query", "node"], "left_anti")
        found = _measured(reached, nodes, queries, node_parts, query_parts)
        seen = work.keep(ranked.select("query", "node", "sim", (F.col("done") | F.col("open")).alias("done")).union(
            found.select("query", "node", "sim", F.lit(False))), f"seen-{k}")
        work.drop(f"seen-{k - 1}")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "node"))
    return seen.withColumn("rank", rank).where(F.col("rank") <= keep).select("query", "node")


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = (v if 1e-100 < max(map(abs, v)) < 1e100 else _scaled(np.array(v)).tolist() for v in (x, y))
            dot = math.fsum(a * b for a, b in zip(x, y))
            scores.append(dot / (math.sqrt(math.fsum(a * a for a in x)) * math.sqrt(math.fsum(b * b for b in y))))
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(scores, pa.float64())],
                                         ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest other rows found for each row whose vec_id `every` divides.

    Cosine in double precision on the vectors as given; ties go to the smaller vec_id. Every row is in the graph.

    - Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null vec_ids. All
      other sizes do, also those whose squares are no doubles.
    - Directions that are equal in float32 are one node. Of rows whose directions are equal in float64 too, the k + 1
      smallest vec_ids stand for all, as their scores tie; the others of a node are all scored. Rows of a repeated
      vec_id are one row: that of the least vector.
    - Vectors of different lengths have no cosine: each length has its own graph.
    - With fewer than `k` others all are returned. Empty tables give an empty result.
    """
    work = Workspace(vectors.sparkSession, "neighbours")
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    own = own.where("vec_id is not null and embedding is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    own = work.keep(own, "vectors")
    rows = work.keep(own.mapInArrow(_nodes, "vec_id long, node long, exact long, unit binary"), "rows")
    length = (F.octet_length("unit") / 4).cast("int").alias("d")
    lengths = sorted(row.d for row in rows.select(length).distinct().limit(LENGTHS + 1).collect())
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} different lengths")
    found = None
    for d in lengths:
        at = Workspace(vectors.sparkSession, f"neighbours-{d}")
        some = rows.where(F.octet_length("unit") == 4 * d)
        nodes = at.keep(some.groupBy("node").agg(F.first("unit").alias("unit")), "nodes")
        count = nodes.count()
        graph = build_graph(at, nodes, d, count)
        queries = at.keep(some.where(F.col("vec_id") % every == 0).select("node").distinct().join(nodes, "node"), "queries")
        part = work.keep(search_graph(at, graph, nodes, queries, count, beam, 4 * (k + 1)), f"found-{d}")
        at.clear()
        found = part if found is None else found.union(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # the search compares in float32; all rows of the best nodes, copies aside, are scored anew in double precision
    place = F.row_number().over(Window.partitionBy("node", "exact").orderBy("vec_id"))
    members = rows.select("node", "exact", "vec_id").withColumn("place", place).where(F.col("place") <= k + 1)
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    pairs = asked.join(found.withColumnRenamed("node", "near"), "query").select("query_id", F.col("near").alias("node"))
    pairs = pairs.join(members.select("node", "vec_id"), "node").where("vec_id <> query_id")
    pairs = work.keep(pairs.select("query_id", "vec_id"), "pairs")
    scored = pairs.join(own.select("vec_id", F.col("embedding").alias("y")), "vec_id").join(
        own.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("x")), "query_id")
    scored = scored.select("query_id", "vec_id", "x", "y").mapInArrow(_exact, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
