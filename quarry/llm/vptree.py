"""Nearest neighbours with one vantage-point tree per shard.

Vectors are dealt into shards of about ``shard_rows`` by a hash of id and vector; each shard is
one row of the index: its vectors and a tree whose nodes keep the range of distances from their
vantage point on either side of the median. It is built once, and read by every block. Queries come in blocks of about ``block_rows``
and every block meets every shard. A subtree is left out if its least possible
distance by the triangle inequality, times ``factor``, exceeds the query's k-th distance
so far: factor 1 is exact, larger factors leave out more. The best k of each shard
are ranked per query in the end. Memory is bounded by a shard and a block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors of different lengths are
not compared; distances beyond the largest double are infinite, and then tie; a query is every distinct (id, vector), and its own id is no candidate
of it; repeated candidate rows are ranked as rows (an index keeps at most k of a row, as no more can be
among k nearest); ties go to the smaller id; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import pieces

K = 10
SHARD_ROWS = 4096
BLOCK_ROWS = 2048
LEAF = 192


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    rows = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)) \
        .withColumn("dims", F.size("v"))


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances, each summed over the components in order."""
    total = np.zeros((len(queries), len(points)))
    for q, p in zip(queries.T, points.T):
        d = q[:, None] - p[None, :]
        d *= d
        total += d
    return np.sqrt(total)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of a to that of b, summed in the same order as ``distances``."""
    total = np.zeros(len(a))
    for d in (a - b).T:
        total += d * d
    return np.sqrt(total)


def exponent(*arrays: np.ndarray) -> int:
    """The power of two by which these are divided, so that no square overflows: 0 unless a component exceeds 2^480."""
    top = max((float(np.abs(x).max()) for x in arrays if x.size), default=0.0)
    return max(0, int(np.frexp(top)[1]) - 480)


class Tree:
    """Nodes in arrays: vantage point, children, range of points, and distance ranges of both children."""

    def __init__(self, points: np.ndarray, order: np.ndarray | None = None, nodes: np.ndarray | None = None):
        """Grown from ``points``, or as it was written: its order and its nodes (rows of 8 numbers)."""
        self.points = points
        if nodes is not None:
            self.order, self.nodes = order, [(*map(int, x[:4]), *x[4:]) for x in nodes.tolist()]
            return
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        self._grow(0, len(points))

    def _grow(self, lo: int, hi: int) -> int:
        number = len(self.nodes)
        self.nodes.append((lo, hi, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if hi - lo <= LEAF:
            return number
        own = self.order[lo:hi]
        # vantage point: the one farthest from the first, so that distances spread
        vantage = int(np.argmax(distances(self.points[own[:1]], self.points[own])[0]))
        own[[0, vantage]] = own[[vantage, 0]]
        d = distances(self.points[own[:1]], self.points[own[1:]])[0]
        middle = len(d) // 2
        split = np.argpartition(d, middle)
        own[1:], d = own[1:][split], d[split]
        inner = self._grow(lo + 1, lo + 1 + middle)
        outer = self._grow(lo + 1 + middle, hi)
        self.nodes[number] = (lo, hi, inner, outer, d[:middle].min(), d[:middle].max(), d[middle:].min(), d[middle:].max())
        return number


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float):
    """(distances, ids) of the k best points of the tree for each query; infinite distance where there are fewer."""
    best = np.full((len(queries), k), np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)

    square_q, square_p = (queries ** 2).sum(axis=1), (tree.points ** 2).sum(axis=1)

    def meet_leaf(q: np.ndarray, rows: np.ndarray) -> None:
        """Only pairs that can be among the best, by squared distances with a margin for rounding, are measured."""
        scale = square_q[q][:, None] + square_p[rows][None, :]
        open_ = scale * (1 - 1e-9) - 2 * (queries[q] @ tree.points[rows].T) <= best[q, -1][:, None] ** 2 * (1 + 1e-9)
        some = np.flatnonzero(open_.any(axis=1))
        if len(some):
            a, b = np.nonzero(open_[some])
            d = np.full((len(some), len(rows)), np.inf)
            d[a, b] = _pairs(queries[q[some[a]]], tree.points[rows[b]])
            meet(q[some], rows, d)

    def meet(q: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        them = np.broadcast_to(ids[rows], d.shape)
        d = np.where(them == query_ids[q][:, None], np.inf, d)
        all_d, all_id = np.concatenate([best[q], d], axis=1), np.concatenate([best_id[q], them], axis=1)
        all_id = np.where(np.isinf(all_d), np.iinfo(np.int64).max, all_id)
        pick = np.lexsort((all_id, all_d), axis=1)[:, :k]
        best[q], best_id[q] = np.take_along_axis(all_d, pick, 1), np.take_along_axis(all_id, pick, 1)

    def visit(number: int, q: np.ndarray, least: np.ndarray) -> None:
        open_ = least * factor <= best[q, -1] * (1 + 1e-12)
        q = q[open_]
        if not len(q):
            return
        lo, hi, inner, outer, in_lo, in_hi, out_lo, out_hi = tree.nodes[number]
        if inner < 0:
            meet_leaf(q, tree.order[lo:hi])
            return
        d = distances(queries[q], tree.points[tree.order[lo:lo + 1]])
        meet(q, tree.order[lo:lo + 1], d)
        d = d[:, 0]
        near = np.maximum(0, np.maximum(in_lo - d, d - in_hi))
        far = np.maximum(0, np.maximum(out_lo - d, d - out_hi))
        inside = near <= far
        visit(inner, q[inside], near[inside])
        visit(outer, q[~inside], far[~inside])
        visit(outer, q[inside], far[inside])
        visit(inner, q[~inside], near[~inside])

    if len(ids) and len(queries):
        visit(0, np.arange(len(queries)), np.zeros(len(queries)))
    return best, best_id


def _pack(table: pa.Table) -> pa.Table:
    """One row of a group's ids and vectors."""
    table = table.sort_by([("vec_id", "ascending")])
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    return pa.table({"dims": table.column(0).slice(0, 1).cast(pa.int32()), "part": table.column(1).slice(0, 1).cast(pa.int32()),
                     "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([flat.tobytes()], pa.binary())})


def _pack_tree(table: pa.Table) -> pa.Table:
    """The same, and the tree over them."""
    packed = _pack(table)
    points = np.frombuffer(packed.column("vectors")[0].as_py()).reshape(-1, packed.column("dims")[0].as_py())
    tree = Tree(np.ldexp(points, -exponent(points)))
    return packed.append_column("tree_order", pa.array([tree.order.tobytes()], pa.binary())) \
        .append_column("nodes", pa.array([np.array(tree.nodes, dtype=np.float64).tobytes()], pa.binary()))


PACKED = "dims int, part int, ids binary, vectors binary"


def _searcher(k: int, factor: float):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                dims = one.column("dims")[0].as_py()
                ids, query_ids = (np.frombuffer(one.column(c)[0].as_py(), dtype=np.int64) for c in ("ids", "query_ids"))
                points, queries = (np.frombuffer(one.column(c)[0].as_py()).reshape(-1, dims) for c in ("vectors", "queries"))
                order, nodes = np.frombuffer(one.column("tree_order")[0].as_py(), dtype=np.int64), np.frombuffer(one.column("nodes")[0].as_py())
                nodes, down = nodes.reshape(-1, 8).copy(), exponent(points, queries)
                nodes[:, 4:] = np.ldexp(nodes[:, 4:], exponent(points) - down)
                d, found = search(Tree(np.ldexp(points, -down), order, nodes), ids, np.ldexp(queries, -down), query_ids, k, factor)
                real = np.isfinite(d)
                d = np.ldexp(d, down)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, real.sum(axis=1))), pa.array(found[real]), pa.array(d[real])],
                                                 names=["query_id", "vec_id", "score"])
    return run


def _dealt(rows: DataFrame, bound: int) -> DataFrame:
    """dims, part, vec_id, v, parts of about ``bound`` rows."""
    parts = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).select("dims", pieces(F.col("n"), bound).alias("parts"))
    dealt = rows.join(F.broadcast(parts), "dims")  # one row for each vector length
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int")
    return dealt.select("dims", part.alias("part"), "vec_id", "v").repartition("dims", "part")


def index(candidates: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard of ``candidates`` (as from ``usable``): ids, vectors and tree; of equal rows at most ``k``."""
    equal = Window.partitionBy("dims", "part", "vec_id", "v").orderBy(F.lit(0))
    rows = _dealt(candidates, shard_rows).withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k).drop("copy")
    return rows.groupBy("dims", "part").applyInArrow(_pack_tree, PACKED + ", tree_order binary, nodes binary")


def nearest(candidates: DataFrame, queries: DataFrame, k: int = K, factor: float = 1.0,
            shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest ``candidates`` of each of ``queries`` (both as from ``usable``)."""
    packed = _dealt(queries.dropDuplicates(["vec_id", "v"]), block_rows).groupBy("dims", "part").applyInArrow(_pack, PACKED)
    shards = candidates.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).select("dims", pieces(F.col("n"), shard_rows).alias("shards"))
    blocks = packed.join(F.broadcast(shards), "dims").select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("part"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))
    met = index(candidates, k, shard_rows).join(blocks, ["dims", "part"]).mapInArrow(
        _searcher(k, factor), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def neighbours(vectors: DataFrame, every: int = 100, k: int = K, factor: float = 1.0) -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``every``."""
    rows = usable(vectors)
    return nearest(rows, rows.where(F.col("vec_id") % every == 0), k, factor)


ORACLE_SQL = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(q.e, c.e)])) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
