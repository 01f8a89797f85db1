"""Hard negatives by inner product, found with multiway hyperplane trees (GNAT style), one per shard.

Vectors become integers, ``floor(256 * entry)``; a score is the exact inner product. With one
coordinate more, ``sqrt(M^2 - |x|^2)`` (0 for an anchor; M the shard's largest norm), all points
of a shard lie on a sphere, and the distance of an anchor a to a point x tells their score:
``d^2 = |a|^2 + M^2 - 2 <a, x>``. So a window of scores is an annulus around the anchor.

A tree node has up to ``WAYS`` split points; a point belongs to the nearest one. Each split point
keeps the range of its distances to every sibling's subtree. A subtree is left out if, for any
split point, this range and the anchor's annulus cannot meet by the triangle inequality, or if its labels cannot qualify. The outer
radius shrinks with the k-th score found. What is left is scored exactly in the leaves.

Vectors are dealt into shards of about ``SHARD_ROWS`` by a hash of the row; shards are written once and
read by both searches: the positives (highest scores of the same label), then, per positive, the
highest scores of other labels in its window. Anchors come in blocks; a task reads a shard once, then one block after the
other, so it holds one shard and one block. Only k rows an anchor and shard leave it, and they are ranked in Spark.

Defined cases: rows without id or label, whose vector is null or empty, or holds a null or non-finite entry take no part, nor do
those whose squared norm, in integers, exceeds 2^62 (all other scores fit 64 bits); zero vectors do; vectors of
different lengths are not compared. An anchor is every distinct (id, label, vector) whose id qualifies, and rows of its id are no
candidates of it; other repeated rows are ranked as rows (of equal ones at most the k that can be returned are kept). Ties go
to the smaller id. A negative positive score has an empty window. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import pieces, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
WAYS, LEAF, DEEPEST = 8, 256, 40
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, v (integers), dims: the rows that take part."""
    rows = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[label_col].cast("bigint").alias("label"),
                          vectors[vector_col].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = F.aggregate("v", F.lit(0.0), lambda s, x: s + (F.abs(x) * SCALE + 1) * (F.abs(x) * SCALE + 1))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    return rows.where(known & finite & (size < 2.0 ** 62)).select(
        "vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"), F.size("v").alias("dims"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``: in doubles while they hold them, else in 64-bit integers
    (where sums may pass 64 bits on the way, but not in the end)."""
    peak = [max(int(x.max()), -int(x.min())) if x.size else 0 for x in (a, b)]
    if peak[0] * peak[1] * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Tree:
    """Nodes in arrays. A node's children are ``child .. child + ways``; ``split`` is the node's own
    split point among its siblings, ``near`` and ``far`` its distance range to each of theirs."""

    FIELDS = ("vectors", "ids", "labels", "nodes", "near", "far")

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, nodes=None, near=None, far=None):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.square = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.reach = self.square.max(initial=0.0)       # M^2
        if nodes is not None:
            self.nodes, self.near, self.far = nodes, near, far
            return
        self.height = np.sqrt(np.maximum(self.reach - self.square, 0))
        self._grow()

    def _distances(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        square = self.square[rows][:, None] + self.square[others][None, :] - 2.0 * products(self.vectors[rows], self.vectors[others])
        return np.sqrt(np.maximum(square, 0) + (self.height[rows][:, None] - self.height[others][None, :]) ** 2)

    def _grow(self) -> None:
        order = np.arange(len(self.ids))
        pick = np.random.default_rng(len(order))    # the same tree from the same rows
        nodes, near, far = [[0, len(order), 0, 0, -1]], [[0.0] * WAYS], [[np.inf] * WAYS]
        open_ = [(0, 0)]
        while open_:
            number, depth = open_.pop()
            lo, hi = nodes[number][:2]
            own = order[lo:hi]
            split = self._split_points(own, pick) if hi - lo > LEAF and depth < DEEPEST else own[:0]
            if len(split) < 2:
                order[lo:hi] = own[np.lexsort((self.labels[own], self.ids[own]))]   # leaf: by id, so that the first best is the smallest
                continue
            d = self._distances(own, split)
            part = d.argmin(axis=1)
            by_part = np.argsort(part, kind="stable")
            order[lo:hi], d, part = own[by_part], d[by_part], part[by_part]
            nodes[number][2:4] = [len(nodes), len(split)]
            edges = np.searchsorted(part, np.arange(len(split) + 1))
            for j, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                pad = WAYS - len(split)
                near.append([*d[a:b].min(axis=0), *[0.0] * pad])
                far.append([*d[a:b].max(axis=0), *[np.inf] * pad])
                open_.append((len(nodes), depth + 1))
                nodes.append([lo + int(a), lo + int(b), 0, 0, int(split[j])])
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.vectors, self.ids, self.labels, self.square = self.vectors[order], self.ids[order], self.labels[order], self.square[order]
        self.nodes, self.near, self.far = np.array(nodes, dtype=np.int64), np.array(near), np.array(far)
        inner = self.nodes[:, 4] >= 0
        self.nodes[inner, 4] = place[self.nodes[inner, 4]]

    def _split_points(self, own: np.ndarray, pick) -> np.ndarray:
        """Of a few random points, one after the other the farthest from those chosen; each at least apart from the others."""
        some = own[np.sort(pick.choice(len(own), min(len(own), 3 * WAYS), replace=False))]
        between = self._distances(some, some)
        between[between < 1e-6 * (1 + np.sqrt(self.reach))] = 0
        chosen, least = [0], between[0].copy()
        while len(chosen) < WAYS and least.max() > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, between[chosen[-1]])
        return some[chosen]


class Search:
    """The best ``k`` scores of each item in one tree. An item is an anchor (a row of ``vectors``) with a window of scores."""

    def __init__(self, tree: Tree, vectors, ids, labels, anchor, lowest, highest, k: int, same: bool):
        self.tree, self.k, self.same = tree, k, same
        self.vectors, self.anchor, self.lowest, self.highest = vectors, anchor, lowest, highest
        self.ids, self.labels = ids[anchor], labels[anchor]
        self.best = np.full((len(anchor), k), LEAST)
        self.best_id = np.full((len(anchor), k), MOST)
        self.scored = 0         # pairs of an anchor and a point that a leaf compared
        about = (vectors.astype(np.float64) ** 2).sum(axis=1)[anchor] + tree.reach
        self.about, self.slack = about, 1e-9 * (1 + np.sqrt(about))
        self.inner = np.sqrt(np.maximum(about - 2.0 * highest, 0))
        if len(tree.ids) and len(anchor):
            self._visit(0, np.flatnonzero(lowest <= highest))

    def _outer(self, items: np.ndarray) -> np.ndarray:
        """The radius within which a point must lie; infinite while any score would do."""
        low = np.maximum(self.lowest[items], self.best[items, -1])
        radius = np.sqrt(np.maximum(self.about[items] - 2.0 * low, 0))
        return np.where(low == LEAST, np.inf, radius)

    def _scores(self, items: np.ndarray, rows) -> np.ndarray:
        anchors, which = np.unique(self.anchor[items], return_inverse=True)
        return products(self.vectors[anchors], self.tree.vectors[rows])[which]

    def _visit(self, number: int, items: np.ndarray) -> None:
        tree = self.tree
        lo, hi, child, ways, _ = tree.nodes[number].tolist()
        labels = tree.labels[lo:hi]
        low, high = labels.min(), labels.max()
        own = self.labels[items]
        items = items[(low <= own) & (own <= high) if self.same else (low != high) | (own != low)]
        if not len(items):
            return
        if not ways:
            self._meet(items, slice(lo, hi))
            return
        children = range(child, child + ways)
        d = np.sqrt(np.maximum(self.about[items][:, None] - 2.0 * self._scores(items, tree.nodes[child:child + ways, 4]), 0))
        nearest = d.argmin(axis=1)
        for first in (True, False):     # each item's nearest child first, so that its outer radius shrinks soon
            for j, kid in enumerate(children):
                turn = np.flatnonzero((nearest == j) == first)
                if len(turn):
                    at, outer, slack = d[turn], self._outer(items[turn])[:, None], self.slack[items[turn]][:, None]
                    near, far = tree.near[kid, :ways], tree.far[kid, :ways]
                    meets = (near <= at + outer + slack) & (far >= at - outer - slack) & (far + at >= self.inner[items[turn]][:, None] - slack)
                    self._visit(kid, items[turn[meets.all(axis=1)]])

    def _meet(self, items: np.ndarray, rows: slice) -> None:
        tree = self.tree
        scores = self._scores(items, rows)
        self.scored += scores.size
        same = tree.labels[rows][None, :] == self.labels[items][:, None]
        fits = (same == self.same) & (tree.ids[rows][None, :] != self.ids[items][:, None])
        fits &= (scores >= self.lowest[items][:, None]) & (scores <= self.highest[items][:, None])
        scores = np.where(fits, scores, LEAST)
        open_ = scores.max(axis=1) >= np.maximum(self.best[items, -1], LEAST + 1)
        items, scores = items[open_], scores[open_]
        if not len(items):
            return
        each, found, found_id = np.arange(len(items)), [self.best[items]], [self.best_id[items]]
        for _ in range(min(self.k, scores.shape[1])):
            top = scores.argmax(axis=1)         # the first of equal ones: the smallest id
            value = scores[each, top]
            found.append(value[:, None])
            found_id.append(np.where(value > LEAST, tree.ids[rows][top], MOST)[:, None])
            scores[each, top] = LEAST
        score, number = np.concatenate(found, axis=1), np.concatenate(found_id, axis=1)
        pick = np.lexsort((number, ~score), axis=1)[:, :self.k]     # ~score falls as the score rises, without overflow
        self.best[items], self.best_id[items] = np.take_along_axis(score, pick, 1), np.take_along_axis(number, pick, 1)


def _small(a: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type."""
    for kind in (np.int8, np.int16, np.int32):
        if not a.size or (a.min() >= np.iinfo(kind).min and a.max() <= np.iinfo(kind).max):
            return a.astype(kind)
    return a


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as file:
        return {name: file[name] for name in file.files}


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)


def _pack_shard(table: pa.Table) -> pa.Table:
    """One row of a shard: its tree, which holds the vectors in the order of the leaves."""
    dims = table.column("dims")[0].as_py()
    ids, labels, vectors = table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(table, dims)
    order = np.lexsort((*vectors.T[::-1], labels, ids))     # the same tree however the rows arrive
    tree = Tree(vectors[order], ids[order], labels[order])
    fields = {name: getattr(tree, name) for name in Tree.FIELDS}
    fields["vectors"] = _small(fields["vectors"])
    return pa.table({"dims": pa.array([dims], pa.int32()), "part": table.column("part").slice(0, 1), "parts": table.column("parts").slice(0, 1),
                     "payload": pa.array([_packed(**fields)], pa.binary())})


def _pack_block(table: pa.Table) -> pa.Table:
    """One row of a block: anchors, and items: anchor, place of the positive, its id and score, window."""
    dims = table.column("dims")[0].as_py()
    wanted = table.column("wanted").combine_chunks()
    count = np.asarray(wanted.value_lengths())
    place, positive, score = (wanted.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
    whole = place == 0      # no positive yet: any score will do
    lowest = np.where(whole, LEAST, -(-score // 2))             # 50 * positive <= 100 * negative
    highest = np.where(whole, MOST, score + -score // 20)       # 100 * negative <= 95 * positive
    payload = _packed(ids=table.column("vec_id").to_numpy(), keys=table.column("key").to_numpy(), labels=table.column("label").to_numpy(),
                      vectors=_small(_matrix(table, dims)), anchor=np.repeat(np.arange(len(count)), count),
                      place=place, positive=positive, score=score, lowest=lowest, highest=highest)
    return pa.table({"dims": pa.array([dims], pa.int32()), "part": table.column("part").slice(0, 1), "parts": table.column("parts").slice(0, 1),
                     "payload": pa.array([payload], pa.binary())})


PACKED = "dims int, part int, parts int, payload binary"
FOUND = "anchor_id bigint, key bigint, place int, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"


def _searcher(k: int, same: bool):
    def run(batches):
        tree = shard = None
        for batch in batches:
            dims, part, kind, payload = (batch.column(c) for c in ("dims", "part", "kind", "payload"))
            for i in range(batch.num_rows):
                here = dims[i].as_py(), part[i].as_py()
                if kind[i].as_py() == 0:
                    tree, shard = Tree(**_unpacked(payload[i].as_py())), here
                    continue
                if shard != here:       # no row was dealt to this shard
                    continue
                own = _unpacked(payload[i].as_py())
                found = Search(tree, own["vectors"], own["ids"], own["labels"], own["anchor"], own["lowest"], own["highest"], k, same)
                real = found.best > LEAST
                item = np.repeat(np.arange(len(real)), real.sum(axis=1))
                at = own["anchor"][item]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (own["ids"][at], own["keys"][at], own["place"][item].astype(np.int32), own["positive"][item],
                                           own["score"][item], found.best_id[real], found.best[real])],
                    names=["anchor_id", "key", "place", "positive_id", "positive_score", "vec_id", "score"])
    return run


def _dealt(rows: DataFrame, bound: int) -> DataFrame:
    """The rows with ``part``: parts of about ``bound`` rows for each vector length."""
    parts = rows.groupBy("dims").agg(pieces(F.count(F.lit(1)), bound).alias("parts"))
    return rows.join(F.broadcast(parts), "dims").withColumn("part", F.pmod(F.xxhash64("vec_id", "label", "v"), F.col("parts")).cast("int"))


def index(rows: DataFrame, k: int = POSITIVES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard of ``rows`` (as from ``usable``): its tree; of equal rows at most ``k``."""
    equal = Window.partitionBy("vec_id", "label", "v").orderBy(F.lit(0))
    kept = rows.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k).drop("copy")
    return _dealt(kept, shard_rows).groupBy("dims", "part").applyInArrow(_pack_shard, PACKED)


def search(shards: DataFrame, anchors: DataFrame, k: int, same: bool, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` best of ``shards`` for each entry of the anchors' ``wanted``, with their rank.

    ``anchors`` has vec_id, label, v, dims, key and ``wanted``: the whole range (place 0), or positives with their scores."""
    blocks = _dealt(anchors, block_rows).groupBy("dims", "part").applyInArrow(_pack_block, PACKED)
    count = F.broadcast(shards.groupBy("dims").agg(F.max("parts").alias("shards")))     # one row for each vector length
    sent = blocks.withColumnRenamed("part", "number").join(count, "dims").select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("part"), F.lit(1).alias("kind"), "number", "payload")
    trees = shards.select("dims", "part", F.lit(0).alias("kind"), F.lit(0).alias("number"), "payload")
    met = trees.unionByName(sent).repartition("dims", "part").sortWithinPartitions("dims", "part", "kind", "number") \
        .mapInArrow(_searcher(k, same), FOUND)
    order = Window.partitionBy("anchor_id", "key", "place").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for anchors whose id is divisible by ``every``.

    ``vectors``: vec_id, embedding, label."""
    rows = usable(vectors)
    shards = stored(index(rows, max(positives, negatives), shard_rows), "hard_negatives")
    one = F.struct(F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("positive_id"), F.lit(0).cast("bigint").alias("positive_score"))
    anchors = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "label", "v"]) \
        .withColumns({"key": F.xxhash64("label", "v"), "wanted": F.array(one)})
    best = search(shards, anchors, positives, True, block_rows)
    pairs = best.groupBy(F.col("anchor_id").alias("vec_id"), "key").agg(        # at most ``positives`` entries
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("wanted"))
    found = search(shards, anchors.drop("wanted").join(stored(pairs, "positives"), ["vec_id", "key"]), negatives, False, block_rows)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(vectors: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings``, where each seventh id's label is first moved on by one."""
    moved = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10).otherwise(vectors["label"])
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))


ORACLE_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum([x[1] * x[2] FOR x IN list_zip(a.e, c.e)])::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
