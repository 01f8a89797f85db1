"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is a logistic function of its words and of their
first 4, 5 and 6 bytes (hashed into buckets); a document is toxic if any of its sentences is, so the sentence
probabilities are combined by noisy-or, in which a sentence without any weighted feature adds nothing (so
a text's length alone never makes it toxic), and the weights are fitted from the
document labels alone. Scoring gives the document's probability and the
sentence that offends most.

The weights are fitted on the driver from a documented bounded sample of
labelled rows (``sample_rows`` a class); scoring covers every word of every row.

Defined cases: a null or empty text has no sentence and score 0; labels that
are null are ignored, and a document labelled twice counts as toxic if either
label says so; of rows that repeat an id the least text is learned from; with no toxic or no clean example every score is 0; an empty
table gives no rows; a null doc_id is scored and never learned from.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import ALNUM_SPLIT, RangeHash, U64, Words, binary_column, byte_symbols, column_slices
from .tables import id_and_text

SAMPLE_ROWS = 2500   # labelled rows of each class that the fit reads at most
BUCKET_BITS = 20
PREFIXES = (4, 5, 6)  # bytes
THRESHOLD = 0.7

_STOP = np.zeros(256, dtype=bool)
_STOP[[0x0A, 0x2E, 0x3F]] = True  # line feed . ? (in shouted text, ! follows every word)


@dataclass
class NoisyOr:
    weights: np.ndarray
    bias: float


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def sentences(offsets: np.ndarray, data: np.ndarray):
    """Buckets of the words' features and of each sentence: its first feature, number in its row, and row."""
    words = Words(offsets, data, ALNUM_SPLIT)
    if not len(words):
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.int32), empty, empty, empty
    row = words.row()
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])[words.start]
    opens = np.concatenate([[True], (np.diff(row) > 0) | (np.diff(stops) > 0)])
    ranges = RangeHash(byte_symbols(lower=True)[data])
    features = [ranges(words.start, words.end)] + [ranges(words.start, np.minimum(words.start + k, words.end)) for k in PREFIXES]
    used = [np.ones(len(words), bool)] + [words.end - words.start > k for k in PREFIXES]
    used = np.stack(used, axis=1)
    bucket = (np.stack(features, axis=1)[used] >> U64(64 - BUCKET_BITS)).astype(np.int32)
    count = used.sum(axis=1)
    first = (np.cumsum(count) - count)[opens]
    owner = row[opens]
    number = np.arange(len(first)) - np.searchsorted(owner, owner, "left")
    return bucket, first, number, owner


def _features(batches):
    """doc_id, toxic, buckets (int32s) and sentence lengths (int32s) of each sampled row."""
    for batch in batches:
        for row, offsets, data in column_slices(batch, "text"):
            n = len(offsets) - 1
            bucket, first, _, owner = sentences(offsets, data)
            lengths = np.diff(np.append(first, len(bucket))).astype(np.int32)
            per_row = np.bincount(owner, minlength=n)
            words = np.bincount(owner, weights=lengths, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), batch.column(1).slice(row, n),
                 binary_column(bucket, words), binary_column(lengths, per_row)],
                names=["doc_id", "toxic", "buckets", "lengths"])


def _odds(held: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log odds of being in a toxic document, of features in at least three of them; else 0.

    ``held`` has the number of clean and of toxic documents with each feature, ``texts`` their totals.
    """
    clean, bad = np.log((held + 0.5) / (texts[:, None] + 1.0))
    return np.where(held[1] >= 3, np.clip(bad - clean, 0, 6), 0.0)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample_rows: int = SAMPLE_ROWS,
        rounds: int = 60, rate: float = 0.5, evidence: float = 0.3) -> NoisyOr:
    """Fit from ``labels`` (doc_id, toxic); ``train`` is a condition on the labels' doc_id.

    Only features of at least three toxic documents and with clear odds can get a
    weight; the fit starts from these odds, which tells the sentences of a document
    apart from the first round on. ``evidence`` is the L1 penalty in documents.
    """
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if train is not None:
        known = known.where(train)
    order = F.xxhash64("doc_id")
    # at most sample_rows rows of each class: the bound of this broadcast
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(sample_rows).union(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(sample_rows))
    # one text for each id, however often the id is repeated
    rows = id_and_text(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    got = rows.mapInArrow(_features, "doc_id bigint, toxic int, buckets binary, lengths binary").toArrow()
    model = NoisyOr(np.zeros(1 << BUCKET_BITS, np.float32), -20.0)
    doc, label = got.column("doc_id").to_pylist(), got.column("toxic").to_numpy()
    packed, spans = got.column("buckets"), got.column("lengths")
    # copies of a text say nothing new: the one with the smallest id stays
    once: dict[bytes, int] = {}
    for i in sorted(range(len(doc)), key=lambda i: (doc[i], label[i])):
        if len(features := packed[i].as_buffer()):
            once.setdefault(hashlib.sha256(features).digest(), i)
    rows_ = sorted(once.values(), key=lambda i: (doc[i], label[i]))
    toxic = label[rows_]
    if not (0 < toxic.sum() < len(toxic)):
        return model
    held = np.zeros((2, 1 << BUCKET_BITS))
    for i in rows_:
        held[int(label[i] == 1), np.unique(np.frombuffer(packed[i].as_buffer(), dtype=np.int32))] += 1
    weights, bias = _odds(held, np.array([(toxic != 1).sum(), (toxic == 1).sum()])), -7.0
    open_ = weights > 1.0
    # only features that can get a weight are held from here on, a row at a time
    some, per_sentence, owner_counts = [], [], []
    for i in rows_:
        bucket = np.frombuffer(packed[i].as_buffer(), dtype=np.int32)
        lengths = np.frombuffer(spans[i].as_buffer(), dtype=np.int32)
        use = open_[bucket]
        some.append(bucket[use])
        per_sentence.append(np.add.reduceat(use, np.cumsum(lengths) - lengths, dtype=np.int64))
        owner_counts.append(len(lengths))
    bucket, per_sentence, owner_counts = np.concatenate(some), np.concatenate(per_sentence), np.array(owner_counts)
    sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)
    doc_first = np.cumsum(owner_counts) - owner_counts
    telling = per_sentence > 0      # a sentence without a feature that can get a weight says nothing, here as in the score
    seen, seen_bias = np.full(1 << BUCKET_BITS, 1e-12), 1e-12
    floor = evidence / len(toxic)
    for _ in range(rounds):  # proximal full-batch AdaGrad on the noisy-or likelihood
        z = bias + np.bincount(sentence, weights=weights[bucket], minlength=len(per_sentence))
        total = np.add.reduceat(np.logaddexp(0, z) * telling, doc_first)
        miss = np.exp(-total)
        slope = np.where(toxic == 1, -miss / np.maximum(1 - miss, 1e-9), 1.0) / len(toxic)
        dz = np.repeat(slope, owner_counts) * _sigmoid(z) * telling
        grad = np.bincount(bucket, weights=dz[sentence], minlength=len(weights))
        seen += grad * grad
        step = rate / np.sqrt(seen)
        weights -= step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * floor, 0) * open_
        seen_bias += dz.sum() ** 2
        bias -= rate * dz.sum() / np.sqrt(seen_bias)
    return NoisyOr(weights.astype(np.float32), float(bias))


def _scorer(model):
    """Append score, worst sentence and its probability to each row of a batch with ``text``."""
    def score(batches):
        weights, bias = model.value
        for batch in batches:
            for row, offsets, data in column_slices(batch, "text"):
                n = len(offsets) - 1
                bucket, first, number, owner = sentences(offsets, data)
                total, worst, worst_p = np.zeros(n), np.full(n, -1, np.int64), np.zeros(n)
                if len(first):
                    own = weights[bucket].astype(np.float64)
                    z = bias + np.add.reduceat(own, first)
                    telling = np.add.reduceat((own != 0).astype(np.int64), first) > 0
                    total = np.bincount(owner, weights=np.logaddexp(0, z) * telling, minlength=n)
                    by = np.lexsort((-number, z, owner))  # the last of each row is its worst sentence
                    last = by[np.flatnonzero(np.append(np.diff(owner[by]) > 0, True))]
                    worst[owner[last]] = number[last]
                    worst_p[owner[last]] = _sigmoid(z[last])
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(-np.expm1(-total)), pa.array(worst, mask=worst < 0), pa.array(worst_p)],
                    names=[*part.schema.names, *OUTPUTS])
    return score


OUTPUTS = ("toxicity", "worst_sentence", "worst_score")


def score(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """``docs`` (with ``text``) and, added, its toxicity (0 to 1), worst sentence (from 0; null if none) and that sentence's probability."""
    taken = docs.drop(*OUTPUTS)
    schema = T.StructType([*taken.schema.fields, T.StructField("toxicity", T.DoubleType()),
                           T.StructField("worst_sentence", T.LongType()), T.StructField("worst_score", T.DoubleType())])
    # 2^20 four-byte weights: 4 MB; sent as plain values, so that executors need no copy of this package
    return taken.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_sentence, worst_score of every document."""
    model = fit(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scored = score(id_and_text(docs), model)
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
        "worst_sentence", "worst_score")
