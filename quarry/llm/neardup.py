"""MinHash near-duplicates: an inverted join on signature coordinates.

1. Each text becomes its set of word shingles; equal sets become one class.
2. A class has a signature of ``coordinates`` minimum values. It is posted under
   every (coordinate, value); values of one class only meet nobody.
3. Classes at or above the similarity agree on at least ``matches`` coordinates
   (all but a fraction below 1e-5 of such pairs at 32 and 12). So two of them meet
   in the rarest ``coordinates - matches + 1`` of either one's values (prefix); the
   longer lists are skipped, and read from the signatures only to count collisions.
4. Inside a list, classes with enough collisions are joined into trees, not into
   all pairs; long lists are cut into blocks and every pair of blocks is a group
   of its own. The trees' connected components are candidate groups.
5. Inside a candidate group the full shingle sets decide. Trees grow over rows that share
   a rare shingle, and a row in a tree is not met again, so a group of near copies costs about as many
   set comparisons as it has members, and texts that share a template alone cost none; a component of the
   confirmed links is a component of all links.

Defined cases: a null text, an empty text or one without words has no shingles and
links with nothing; a text shorter than a shingle is one shingle. Rows that repeat a
doc_id are one node (it links whatever any of its texts links). A row without a doc_id
never is a component's smallest id; it gets the id of its class, or null. Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kernels import BLANK_SPLIT, U64, RangeHash, Words, binary_column, column_slices, mix, unpack
from .tables import id_and_text, pieces, stored

SHINGLE = 5
SIMILARITY = (75, 100)
COORDINATES = 32
MATCHES = 12
LIST_BLOCK = 1024            # classes of a list compared in one group
GROUP_BLOCK = 1 << 20        # shingles of a candidate group compared in one group


def shingle_sets(offsets: np.ndarray, data: np.ndarray, shingle: int):
    """Sorted distinct shingle hashes of all rows, one after the other, and their number in each row."""
    words = Words(offsets, data, BLANK_SPLIT)
    ranges = RangeHash(words.hashes(lower=True))
    first = np.arange(len(words))
    row = words.row()
    end = np.minimum(first + shingle, words.first[row + 1])
    whole = (end - first == shingle) | (first == words.first[row])  # a short text is one shingle
    h, row = ranges(first[whole], end[whole]), row[whole]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.bincount(row[new], minlength=len(offsets) - 1)


def _prints(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    at = np.cumsum(counts) - counts
    some = counts > 0
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        value = np.zeros(len(counts), dtype=U64)
        if some.any():
            value[some] = np.add.reduceat(mix(h ^ U64(salt)), at[some])
        out.append(value.view(np.int64))
    return out[0], out[1]


def _signer(shingle: int, coordinates: int):
    """doc_id, n_shingles, fingerprints and posting keys (coordinate and 32-bit minimum) of each row."""
    factors = (mix(np.arange(1, coordinates + 1, dtype=U64)) | U64(1))

    def sign(batches):
        for batch in batches:
            for row, offsets, data in column_slices(batch, "text"):
                h, counts = shingle_sets(offsets, data, shingle)
                n = len(counts)
                a, b = _prints(h, counts)
                some = counts > 0
                at = (np.cumsum(counts) - counts)[some]
                keys = np.zeros((int(some.sum()), coordinates), dtype=np.int64)
                for j in range(coordinates if len(at) else 0):
                    low = np.minimum.reduceat((h * factors[j]) >> U64(32), at)
                    keys[:, j] = (low | U64(j << 32)).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(np.where(some, coordinates, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(counts), pa.array(a), pa.array(b),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))],
                    names=["doc_id", "n_shingles", "print_a", "print_b", "keys"])
    return sign


def _complete_groups(batches, columns: int):
    """Tables of whole runs of equal values in the first ``columns`` columns of sorted batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = held.slice(held.num_rows - 1)
        same = np.ones(held.num_rows, dtype=bool)
        for c in range(columns):
            same &= held.column(c).to_numpy() == last.column(c)[0].as_py()
        cut = int(np.argmax(same))
        if cut:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _trees(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels of linked rows, in place, keeping the smallest row of each tree."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label[:] = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    while True:
        deeper = label[label]
        if (deeper == label).all():
            return
        label[:] = deeper


def _connected(table: pa.Table, group: np.ndarray, numerator: int, denominator: int, matches: int):
    """Tree of each row in its group, by collisions of signatures. Rows are compared at growing distance in the sorted group."""
    n = table.num_rows
    size = table.column("n_shingles").to_numpy()
    keys = _whole(table, "keys").flatten().to_numpy().reshape(n, -1)
    label = np.arange(n)
    longest = int(np.bincount(group).max())
    for step in range(1, longest):
        a = np.flatnonzero(group[step:] == group[:-step])
        b = a + step
        close = (label[a] != label[b]) & (np.minimum(size[a], size[b]) * denominator >= np.maximum(size[a], size[b]) * numerator)
        a, b = a[close], b[close]
        for cut in range(0, len(a), 1 << 16):
            x, y = a[cut:cut + (1 << 16)], b[cut:cut + (1 << 16)]
            met = (keys[x] == keys[y]).sum(axis=1) >= matches
            _trees(label, x[met], y[met])
    return label


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def _runs(group: np.ndarray, where: np.ndarray):
    """Row ranges of whole groups, each of at most about GROUP_BLOCK shingles or one group."""
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)).tolist()
    begin = last = 0
    for end in ends:
        if last > begin and where[end] - where[begin] > GROUP_BLOCK:
            yield begin, last
            begin = last
        last = end
    yield begin, last


class _Postings:
    """Rows by token, and how many of them are still open; closed ones are dropped when they are half."""

    def __init__(self, token: np.ndarray, row: np.ndarray, tokens: int):
        self.rows, self.live = row[np.argsort(token, kind="stable")], len(row)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=tokens))])

    def of(self, token: np.ndarray) -> np.ndarray:
        return self.rows[_ranges(self.start[token], self.start[token + 1] - self.start[token])]

    def close(self, n: int, open_: np.ndarray) -> None:
        self.live -= n
        if 2 * self.live < len(self.rows):
            keep = open_[self.rows]
            self.start = np.concatenate([[0], np.cumsum(keep)])[self.start]
            self.rows = self.rows[keep]


def _confirmed(group: np.ndarray, flat: np.ndarray, where: np.ndarray, numerator: int, denominator: int):
    """Tree of each row in its group, by full sets (row i has flat[where[i]:where[i + 1]]).

    A tree grows from its first row: each row reached meets the rows not yet in a tree that share one of
    its rarest shingles (as many as a set at the similarity cannot lack), and their whole sets are counted.
    So a group of near copies is compared once with its first row, and sets that only share a template do not meet.
    """
    n, size = len(group), np.diff(where)
    row = np.repeat(np.arange(n), size)
    _, token, times = np.unique(flat ^ mix(group)[row], return_inverse=True, return_counts=True)
    rare = token[np.lexsort((token, times[token], row))]
    place = np.arange(len(flat)) - where[:-1][row]
    prefix = (place < (size + 1 + -numerator * size // denominator)[row]) & (times[rare] > 1)
    rare, holder = rare[prefix], row[prefix]
    first = np.searchsorted(holder, np.arange(n + 1))
    postings = _Postings(rare, holder, len(times))
    label, open_, mark = np.arange(n), np.ones(n, dtype=bool), np.zeros(len(times), dtype=bool)
    for root in np.unique(holder).tolist():
        if not open_[root]:
            continue
        open_[root] = False
        postings.close(first[root + 1] - first[root], open_)
        reached = [root]
        while reached and postings.live:
            p = reached.pop()
            met = postings.of(rare[first[p]:first[p + 1]])
            met = np.unique(met[open_[met]])
            met = met[(group[met] == group[p]) & (np.minimum(size[met], size[p]) * denominator >= np.maximum(size[met], size[p]) * numerator)]
            if not len(met):
                continue
            own = token[where[p]:where[p + 1]]
            mark[own] = True
            both = np.add.reduceat(mark[token[_ranges(where[met], size[met])]], np.cumsum(size[met]) - size[met], dtype=np.int64)
            mark[own] = False
            new = met[denominator * both >= numerator * (size[met] + size[p] - both)]
            label[new], open_[new] = root, False
            postings.close(int((first[new + 1] - first[new]).sum()), open_)
            reached.extend(new.tolist())
    return label


def _edges(columns: int, sets: bool, numerator: int, denominator: int, matches: int):
    """(node, root) of each row that is not its tree's root; rows come as whole sorted groups."""
    def link(batches):
        for table in _complete_groups(batches, columns):
            node = table.column("node").to_numpy()
            head = np.zeros(table.num_rows, dtype=bool)
            for c in range(columns):
                x = table.column(c).to_numpy()
                head[1:] |= x[1:] != x[:-1]
            group = np.cumsum(head)
            if sets:
                flat, where = unpack(_whole(table, "shingles"), U64)
                label = np.concatenate([a + _confirmed(group[a:b], flat[where[a]:where[b]], where[a:b + 1] - where[a], numerator, denominator)
                                        for a, b in _runs(group, where)])
            else:
                label = _connected(table, group, numerator, denominator, matches)
            other = node[label] != node
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[label][other])], names=["a", "b"])
    return link


def _setter(shingle: int):
    """Shingle sets of the candidates' texts; only texts whose set is the class's."""
    def build(batches):
        for batch in batches:
            for row, offsets, data in column_slices(batch, "text"):
                h, counts = shingle_sets(offsets, data, shingle)
                a, b = _prints(h, counts)
                part = batch.slice(row, len(counts))
                keep = (a == part.column("print_a").to_numpy()) & (b == part.column("print_b").to_numpy())
                packed = binary_column(h.view(np.int64), counts)
                names = [x for x in part.schema.names if x != "text"]
                out = pa.RecordBatch.from_arrays([*(part.column(x) for x in names), packed], names=[*names, "shingles"])
                yield out.filter(pa.array(keep))
    return build


def _in_blocks(df: DataFrame, group: str, blocks: str) -> DataFrame:
    """Give each row to all pairs of blocks of its group that hold its own; a small group is one block."""
    mine = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    out = df.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    out = out.select(F.col(group).alias("g"), F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j"), *
                     [c for c in df.columns if c not in (group, blocks)])
    return out.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "n_shingles", "node")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
                    coordinates: int = COORDINATES, matches: int = MATCHES, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    numerator, denominator = similarity
    texts = id_and_text(docs, id_col, text_col)
    signed = stored(texts.mapInArrow(_signer(shingle, coordinates),
                                     "doc_id bigint, n_shingles bigint, print_a bigint, print_b bigint, keys array<bigint>"), "signed")
    sets = ["n_shingles", "print_a", "print_b"]
    # the smallest id stands for a class; signatures of equal sets are equal
    classes = stored(signed.where("n_shingles > 0").groupBy(*sets).agg(
        F.min("doc_id").alias("node"), F.first("keys").alias("keys")), "classes")
    nodes = classes.where("node is not null")

    postings = nodes.select("node", F.explode("keys").alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    met = postings.join(shared, "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("times", "key"))).alias("met")).where(F.size("met") >= matches)
    prefix = met.select("node", F.explode(F.slice("met", F.lit(1), F.size("met") - matches + 1)).alias("p"))
    lists = prefix.select("node", F.col("p.key").alias("key"), F.col("p.times").alias("times")).join(
        nodes.select("node", "n_shingles", "keys"), "node")
    lists = lists.withColumn("blocks", pieces(F.col("times"), LIST_BLOCK)).drop("times")
    link = _edges(3, False, numerator, denominator, matches)
    candidates = components(_in_blocks(lists, "key", "blocks").mapInArrow(link, "a bigint, b bigint").distinct())

    members = candidates.join(nodes, "node")
    weight = members.groupBy("component").agg(F.sum("n_shingles").alias("weight"))
    members = members.join(weight, "component").withColumn("blocks", pieces(F.col("weight"), GROUP_BLOCK)).drop("weight")
    with_text = members.join(texts.withColumnRenamed("doc_id", "node"), "node")
    types = "component bigint, node bigint, n_shingles bigint, print_a bigint, print_b bigint, keys array<bigint>, blocks int, shingles binary"
    filled = with_text.select("component", "node", *sets, "keys", "blocks", "text").mapInArrow(_setter(shingle), types)
    confirm = _edges(3, True, numerator, denominator, matches)
    linked = components(_in_blocks(filled, "component", "blocks").mapInArrow(confirm, "a bigint, b bigint").distinct())

    found = classes.drop("keys").join(linked, "node", "left").select(
        *[F.col(c).alias(f"_{c}") for c in sets], F.coalesce("component", "node").alias("component_id"))
    same = [signed[c] == F.col(f"_{c}") for c in sets]
    out = signed.drop("keys").join(found, same, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull()))
