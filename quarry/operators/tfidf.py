"""Hashed term frequency, document frequency, idf and TF-IDF.

Long form throughout: a document's hashed term-frequency vector is the set of
rows ``(doc_id, bucket, tf)`` instead of a 2^20-wide sparse vector.

* ``term_frequency`` counts a document's buckets where its text is read, in
  the Arrow step that hashes them, and explodes the counts: no shuffle. A row is a
  document, whatever its id.
* ``bucket_counts`` counts document frequency and the tokens of each class in one pass, without a row a token:
  a task adds the sparse count vectors of small slices of its rows, sends one vector for each class and range of buckets, and
  the ranges are merged where they are dealt. What moves is at most (classes + 1) x 2^20 counts a task with up to three
  classes, whatever the number of tokens; with more, a task sends its counts whenever it holds ``MOST_HELD``.
* the idf table has at most 2^20 rows (one per bucket), a bound fixed by the
  hashing, so joins against it may broadcast it (``broadcast_if_bounded``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NUM_FEATURES, list_slices, with_buckets
from ..session import materialize
from .sizing import broadcast_if_bounded, row_bytes

BUCKET = "bucket"


def token_buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = (), num_features: int = NUM_FEATURES) -> DataFrame:
    """One row per token occurrence: ``(id, *keep, bucket)``."""
    return (with_buckets(docs, text_col, [id_col, *keep], "_b", num_features)
            .select(id_col, *keep, F.explode("_b").alias(BUCKET)))


def term_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   num_features: int = NUM_FEATURES) -> DataFrame:
    """``(id, bucket, tf)``: hashed term counts per document."""
    counted = with_buckets(docs, text_col, [id_col], "_b", num_features, counts_col="_n")
    return _long_form(counted, id_col)


def _long_form(counted: DataFrame, id_col: str) -> DataFrame:
    pairs = counted.select(id_col, F.explode(F.arrays_zip("_b", "_n")).alias("_p"))
    return pairs.select(id_col, F.col("_p._b").alias(BUCKET), F.col("_p._n").alias("tf"))


RANGES = 64             # ranges of buckets that counts are merged by
SQUEEZE = 1 << 18       # counts that a task gathers before it adds up equal ones
MOST_HELD = 1 << 22     # different counts that a task holds before it sends them on: three classes' at most


class _Tally:
    """Sorted keys and their counts. New ones wait until there are ``SQUEEZE``, so that little is held beside the sums."""

    def __init__(self):
        self.keys, self.counts, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys, counts) -> None:
        self.waiting.append((keys, counts))
        if sum(len(k) for k, _ in self.waiting) > SQUEEZE:
            self.settle()

    def settle(self) -> None:
        """Add what waits."""
        if not self.waiting:
            return
        keys, where = np.unique(np.concatenate([k for k, _ in self.waiting]), return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate([c for _, c in self.waiting]), minlength=len(keys)).astype(np.int64)
        self.waiting.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        self.counts[at[known]] += counts[known]
        if not known.all():
            self.keys = np.insert(self.keys, at[~known], keys[~known])
            self.counts = np.insert(self.counts, at[~known], counts[~known])

    def taken(self) -> tuple:
        """All keys and counts; none are left."""
        self.settle()
        out = self.keys, self.counts
        self.__init__()
        return out


def bucket_counts(rows: DataFrame, lists_col: str, label_col: str | None = None, num_features: int = NUM_FEATURES) -> DataFrame:
    """``(label, bucket, n)``: with a null label, the number of rows whose list holds the bucket; with a label (an int of at least
    0), how often the bucket occurs in the lists of its rows. One pass over ``rows``, no row for a token."""
    own = rows.select(F.col(lists_col).alias("lists"), *([F.col(label_col).cast("int").alias("label")] if label_col else []))
    bits = max(0, (num_features // RANGES).bit_length() - 1)
    sent = "part int, keys array<bigint>, counts array<bigint>"

    def count(batches):
        tally = _Tally()    # keys: (label + 1) * num_features + bucket, 0 for document frequency

        def out():      # one label after the other: its keys are sorted by bucket, so by range
            (all_keys, all_counts), start = tally.taken(), 0
            while start < len(all_keys):
                label = int(all_keys[start]) // num_features
                end = int(np.searchsorted(all_keys, (label + 1) * num_features))
                keys, counts = all_keys[start:end], all_counts[start:end]
                part = (keys % num_features) >> bits
                edges = np.flatnonzero(np.append(True, np.diff(part) > 0))
                ends = pa.array(np.append(edges, len(part)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(part[edges].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(keys)),
                                                  pa.ListArray.from_arrays(ends, pa.array(counts))], names=["part", "keys", "counts"])
                start = end

        for batch in batches:
            for rows_ in list_slices(batch, "lists"):
                lists = rows_.column(0)
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                tally.add(*np.unique(np.unique(row * num_features + values) % num_features, return_counts=True))
                if label_col:
                    label = rows_.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                    tally.add(*np.unique((label[row] + 1) * num_features + values, return_counts=True))
                if len(tally.keys) > MOST_HELD:
                    yield from out()
        yield from out()

    def merge(batches):     # a range's vectors come one after the other
        tally, now = _Tally(), None

        def out():
            keys, counts = tally.taken()
            label = keys // num_features - 1
            yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32), mask=label < 0), pa.array((keys % num_features).astype(np.int32)),
                                              pa.array(counts)], names=["label", BUCKET, "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column(0)[i].as_py()
                if part != now:
                    yield from out()
                    now = part
                tally.add(*(batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (1, 2)))
        yield from out()

    dealt = own.mapInArrow(count, sent).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(merge, f"label int, {BUCKET} int, n bigint")


def frequencies(rows: DataFrame, lists_col: str, num_features: int = NUM_FEATURES) -> DataFrame:
    """``(bucket, df)`` of lists of buckets."""
    return bucket_counts(rows, lists_col, None, num_features).select(BUCKET, F.col("n").alias("df"))


def document_frequency(docs: DataFrame, text_col: str = "text",
                       num_features: int = NUM_FEATURES) -> DataFrame:
    """``(bucket, df)``: number of documents holding each bucket."""
    return frequencies(with_buckets(docs, text_col, [], "_b", num_features), "_b", num_features)


def idf_table(docs: DataFrame, text_col: str = "text",
              num_features: int = NUM_FEATURES) -> DataFrame:
    """``(bucket, df, idf)`` with ``idf = ln((N + 1) / (df + 1))``; N is a scalar subquery."""
    n_docs = docs.select(F.count("*")).scalar()
    return document_frequency(docs, text_col, num_features).select(
        BUCKET, "df", F.ln((n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          num_features: int = NUM_FEATURES, idf: DataFrame | None = None,
          unseen_idf=None) -> DataFrame:
    """``(id, bucket, tfidf)``; idf fitted on ``docs`` unless a table is given.

    The documents are tokenised once into a materialized bucket table, from
    which both the term counts and (when fitted here) the idf are computed.
    With a table fitted elsewhere, a bucket it lacks had df = 0 there, so its
    idf is ``ln(N_fit + 1)``: pass that as ``unseen_idf`` (value or Column).
    """
    bucketed = materialize(with_buckets(docs, text_col, [id_col], "_b", num_features, counts_col="_n"))
    if idf is None:
        n_docs = bucketed.select(F.count("*")).scalar()
        idf = (frequencies(bucketed, "_b", num_features)
               .select(BUCKET, F.ln((n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf")))
    idf = broadcast_if_bounded(idf.select(BUCKET, "idf"), num_features, row_bytes(2))
    tf = _long_form(bucketed, id_col)
    weight = F.col("idf") if unseen_idf is None else F.coalesce(F.col("idf"), F.lit(unseen_idf))
    return (tf.join(idf, BUCKET, "left")
            .select(id_col, BUCKET, (F.col("tf") * weight).alias("tfidf")))
