"""Benchmark decontamination: a prefix-filtered set join of texts with benchmark items.

Every window of ``window`` consecutive item words (a shorter item is one window)
must occur whole, so all its words are necessary and a prefix of one word, the
rarest, is enough to find it. Words are ordered by their count in the corpus (one
counting pass over all documents, kept to the items' words). A document
word that is some window's prefix word proposes that window; the position of
the word in the window and the document's ends bound where it can start, and
the window's words are then compared one by one.

The windows are held by every task. Their size is checked: items are taken in
blocks of at most ``block_words`` words, one matching pass a block, so any
benchmark fits (a 64 MB block holds every benchmark used here at once).

Defined cases: null or empty texts have no words and are clean; items without
words have no windows; repeated items count once, by their id; a null item id
is left out; empty tables give clean documents or no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import ALNUM_SPLIT, RangeHash, U64, Words, binary_column, column_slices, spans_to_mask, unpack
from .tables import id_and_text, stored

WINDOW = 10
BLOCK_WORDS = 1 << 18


def _item_words(batches):
    for batch in batches:
        for row, offsets, data in column_slices(batch, "text"):
            words = Words(offsets, data, ALNUM_SPLIT)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(words.counts)), binary_column(words.hashes(True), words.counts),
                 pa.array(words.counts)], names=["item_id", "words", "n"])


def _word_counter(vocabulary):
    """(word's place in the vocabulary, its count) for each task."""
    def count(batches):
        known = vocabulary.value
        total = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for _, offsets, data in column_slices(batch, "text"):
                h = Words(offsets, data, ALNUM_SPLIT).hashes(True)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                total += np.bincount(at[known[at] == h], minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known))), pa.array(total)], names=["word", "n"])
    return count


class Windows:
    """Item windows by prefix word: sorted ``prefix``, the ``shift`` of that word, the window's words and item."""

    def __init__(self, items: list[np.ndarray], rarity, window: int):
        rows = []
        for number, words in enumerate(items):
            size = min(window, len(words))
            rank = rarity(words)
            for start in range(len(words) - size + 1 if size else 0):
                shift = int(np.argmin(rank[start:start + size]))
                rows.append((words[start + shift], shift, size, number, words[start:start + size]))
        rows.sort(key=lambda r: r[:4])
        self.prefix = np.array([r[0] for r in rows], dtype=U64)
        self.shift = np.array([r[1] for r in rows], dtype=np.int64)
        self.size = np.array([r[2] for r in rows], dtype=np.int64)
        self.item = np.array([r[3] for r in rows], dtype=np.int64)
        self.words = np.zeros((len(rows), window), dtype=U64)
        for r, row in zip(self.words, rows):
            r[:len(row[4])] = row[4]
        self.seen = np.zeros(1 << 16, dtype=bool)  # by the prefix word's high bits
        self.seen[(self.prefix >> U64(48)).astype(np.int64)] = True

    def occurrences(self, h: np.ndarray, first: np.ndarray):
        """(start, end, item) of all windows in the rows whose words are h[first[i]:first[i + 1]]."""
        none = np.zeros(0, np.int64)
        if not len(self.prefix) or not len(h):
            return none, none, none
        at = np.flatnonzero(self.seen[(h >> U64(48)).astype(np.int64)])
        lo, hi = np.searchsorted(self.prefix, h[at], "left"), np.searchsorted(self.prefix, h[at], "right")
        count = hi - lo
        at, lo, count = at[count > 0], lo[count > 0], count[count > 0]
        found = [(none, none, none)]
        step = max(1, (1 << 20) // self.words.shape[1])
        cuts = np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + step, step))
        for a, b in zip(cuts, np.append(cuts[1:], len(at))):  # candidates in bounded portions
            n = count[a:b]
            which = np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            start = np.repeat(at[a:b], n) - self.shift[which]
            end = start + self.size[which]
            row = np.searchsorted(first, np.repeat(at[a:b], n), "right") - 1
            fits = (start >= first[row]) & (end <= first[row + 1])
            start, end, which = start[fits], end[fits], which[fits]
            for j in range(self.words.shape[1]):
                inside = j < self.size[which]
                same = ~inside | (h[np.minimum(start + j, len(h) - 1)] == self.words[which, j])
                start, end, which = start[same], end[same], which[same]
            found.append((start, end, self.item[which]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _lists(flat: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def _matcher(shared):
    """Append to each row its word count, the places of its hit words and the items found."""
    def match(batches):
        fields, ids = shared.value
        windows = Windows.__new__(Windows)
        vars(windows).update(fields)
        for batch in batches:
            for row, offsets, data in column_slices(batch, "text"):
                n = len(offsets) - 1
                words = Words(offsets, data, ALNUM_SPLIT)
                h = words.hashes(True)
                start, end, item = windows.occurrences(h, words.first)
                hit = np.flatnonzero(spans_to_mask(start, end, len(h)))
                owner = np.searchsorted(words.first, hit, "right") - 1
                pair = np.unique(np.stack([np.searchsorted(words.first, start, "right") - 1, item]), axis=1)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(words.counts),
                     _lists(pa.array(hit - words.first[owner], pa.int64()), np.bincount(owner, minlength=n)),
                     _lists(pa.array(ids, pa.string()).take(pa.array(pair[1])), np.bincount(pair[0], minlength=n))],
                    names=[*part.schema.names, "n_words", "hit_words", "items"])
    return match


ADDED = ("n_words", "hit_words", "items")


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (with ``text``) and, added, n_words, hit_words (places of hit words) and items (ids found, as strings)."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].alias("text"))
    items = stored(items.where("item_id is not null").mapInArrow(_item_words, "item_id string, words binary, n bigint"), "items")
    blocks = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // block_words))
    out = docs.drop(*ADDED)
    schema = T.StructType([*out.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("hit_words", T.ArrayType(T.LongType())),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    found = None
    for block in range(blocks):
        windows, ids = _windows(docs, items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block), window)
        # as plain values, so that executors need no copy of this package
        shared = docs.sparkSession.sparkContext.broadcast((vars(windows), ids))  # at most about 100 bytes for each of block_words words
        if found is None:
            found = out.mapInArrow(_matcher(shared), schema)
            continue
        earlier = stored(found.withColumnsRenamed({"hit_words": "_hit_words", "items": "_items"}).drop("n_words"), "hits")
        more = T.StructType([*earlier.schema.fields, *schema.fields[-3:]])
        found = earlier.mapInArrow(_matcher(shared), more).withColumns({
            "hit_words": F.array_union("_hit_words", "hit_words"),
            "items": F.array_union("_items", "items")}).select(*schema.names)
    return found


def _windows(docs: DataFrame, items: DataFrame, window: int) -> tuple[Windows, list[str]]:
    """The windows of a block of items, with their rarest words by count over all of ``docs``."""
    got = items.toArrow().sort_by([("item_id", "ascending"), ("words", "ascending")])
    ids = got.column("item_id").to_pylist()
    flat, where = np.zeros(0, U64), np.zeros(1, np.int64)
    if got.num_rows:
        flat, where = unpack(got.column("words").combine_chunks(), U64)
    vocabulary = np.unique(flat)
    counts = np.zeros(len(vocabulary), dtype=np.int64)
    if len(vocabulary):
        shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
        counted = docs.select("text").mapInArrow(_word_counter(shared), "word bigint, n bigint")
        for row in counted.groupBy("word").agg(F.sum("n").alias("n")).toArrow().to_pylist():
            counts[row["word"]] = row["n"]
    words = [flat[a:b] for a, b in zip(where[:-1], where[1:])]
    windows = Windows(words, lambda w: counts[np.searchsorted(vocabulary, w)], window)
    names = sorted(set(ids))
    place = {x: i for i, x in enumerate(names)}  # repeated items count once
    windows.item = np.array([place[ids[i]] for i in windows.item], dtype=np.int64)
    return windows, names


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (ids, comma-joined) of every document."""
    found = find_items(id_and_text(docs), benchmark)
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"), F.concat_ws(",", F.sort_array("items")).alias("items"))


ORACLE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT item_id, unnest([array_to_string(words[i:i + 9], ' ') FOR i IN range(1, greatest(len(words) - 9, 1) + 1)]) AS gram,
         least(len(words), 10) AS size FROM items WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM windows
), grams AS (
  SELECT doc_id, size, i AS start, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM doc_words, sizes WHERE len(words) >= size)
), hits AS (
  SELECT DISTINCT doc_id, start, g.size, item_id FROM grams g JOIN windows w ON g.gram = w.gram AND g.size = w.size
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(array_to_string(items, ','), '') AS items
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
""".replace("\\\\x", "\\x")
