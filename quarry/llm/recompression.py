"""Substring dedup by recompression: words that lie in a repeated passage are removed.

Rounds of recompression rewrite each text: runs of a symbol become one symbol, then
pairs of a left and a right symbol do, sides being given by the symbols' names. Names
are hashes of what a symbol stands for, so they agree over the whole corpus
without a dictionary, and equal passages get equal symbols but for a few at their ends. After ``r``
rounds a symbol depends on at most 2^r - 1 words before and 2^(r+1) - 1 words from its
start on (symbols that need more, at long runs or at a text's ends, are not used).
As many rounds are made as let every window of ``width`` words hold whole symbols: 2 at 20.

A window's anchor is the start of the interior symbol with the least name. Anchors
that share a name reveal repeats, which are verified on whole windows (see ``repeats``).

Defined cases: a null or empty text has no words; a text shorter than a window keeps
all; of equal texts the one with the smallest id stays whole; rows that repeat a doc_id are one document (a window of
one is not removed for the same start of the other); each row without a doc_id is a document of its own,
after those with one (see ``tables.placed``); empty
tables give no rows; other columns are ignored, or kept by ``cut``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeats
from .kernels import BLANK_SPLIT, U64, Words, mix
from .tables import id_and_text, placed, stored

WIDTH = 20
_FAR = 1 << 40


def rounds_for(width: int) -> int:
    """The most rounds whose symbols, with what they depend on, fit any window of ``width``."""
    r = 0
    while (1 << (r + 3)) - 2 <= width:
        r += 1
    return r


def recompress(elements: np.ndarray, first: np.ndarray, rounds: int):
    """Start, name, and first and last-but-one position depended on, of each symbol after ``rounds``."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.arange(len(elements))
    name, lo, hi = elements, start, start + 1
    for r in range(rounds):
        if not len(name):
            break
        # runs
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(name)))
        tail = head + length - 1
        before = (head > 0) & (owner[head] == owner[np.maximum(head - 1, 0)])
        after = (tail + 1 < len(name)) & (owner[tail] == owner[np.minimum(tail + 1, len(name) - 1)])
        run_lo = np.where(before, lo[np.maximum(head - 1, 0)], -_FAR)
        run_hi = np.where(after, hi[np.minimum(tail + 1, len(name) - 1)], _FAR)
        letter, run_owner = name[head], owner[head]
        full = mix(letter * U64(0xC2B2AE3D27D4EB4F) + length.astype(U64))
        # pairs: a left symbol followed by a right one
        right = (mix(letter ^ U64(r + 1)) & U64(1)).astype(bool)
        pair = np.zeros(len(head), dtype=bool)
        pair[:-1] = ~right[:-1] & right[1:] & (run_owner[1:] == run_owner[:-1])
        opens = np.ones(len(head), dtype=bool)
        opens[1:] = ~pair[:-1]
        at = np.flatnonzero(opens)
        end = at + pair[at]
        name = np.where(pair[at], mix(full[at] * U64(0x165667B19E3779F9) + full[end]), full[at])
        start, owner, lo, hi = start[head[at]], run_owner[at], run_lo[at], run_hi[end]
    return start, name, lo, hi


def anchors(width: int = WIDTH) -> repeats.Anchors:
    rounds = rounds_for(width)
    before, after = (1 << rounds) - 1, min(width, (1 << (rounds + 1)) - 1)

    def priority(seq, ranges):
        start, name, lo, hi = recompress(seq.elements, seq.first, rounds)
        use = (lo >= start - before) & (hi <= start + after)
        out, eligible = np.zeros(len(seq.elements), U64), np.zeros(len(seq.elements), bool)
        out[start[use]] = mix(name[use])
        eligible[start[use]] = True
        return out, eligible
    return repeats.Anchors(width, before, after, priority)


def words_of(offsets: np.ndarray, data: np.ndarray):
    words = Words(offsets, data, BLANK_SPLIT)
    return words, repeats.Sequence(words.hashes(lower=False), words.first)


def joined_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of all rows, each followed by a space, and where each row begins."""
    length = (words.end - words.start)
    room = np.where(keep, length + 1, 0)
    place = np.concatenate([[0], np.cumsum(room)])
    out = np.full(place[-1], 0x20, dtype=np.uint8)
    inside = np.flatnonzero(BLANK_SPLIT[words.data])  # the bytes of all words, in order
    kept = np.repeat(keep, length)
    target = np.repeat(place[:-1] - words.start, length)[kept] + inside[kept]
    out[target] = words.data[inside[kept]]
    return out, place[words.first]


def _remover(width: int, with_text: bool):
    """Per row n_words, n_removed, digest of the kept words, and with_text the kept words."""
    def run(batches):
        for batch, told in (repeats.told_texts if with_text else repeats.packed_told_texts)(batches):
            for at, words, seq, _, doc, row in repeats.slice_rows(batch, words_of):
                gone = repeats.covered(seq, told, doc, row, width)
                text, begin = joined_words(words, ~gone)
                end = np.maximum(begin[1:] - 1, begin[:-1])
                n = len(doc)
                removed = np.bincount(words.row(), weights=gone, minlength=n).astype(np.int64)
                view = memoryview(text)
                part = batch.slice(at, n)
                names = [c for c in part.schema.names if c != "_place"]
                columns = [part.column(c) for c in names]
                if with_text:
                    columns.append(pa.array([bytes(view[a:b]).decode() for a, b in zip(begin, end)], pa.string()))
                    names.append("_kept")
                else:
                    columns, names = [part.column(0)], ["doc_id"]
                    columns.append(pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(begin, end)], pa.string()))
                    names.append("kept_sha256")
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words.counts), pa.array(removed)], names=[*names, "_n_words", "_n_removed"])
    return run


def _repeats(texts: DataFrame, width: int) -> DataFrame:
    told = stored(repeats.settle(repeats.post(texts, words_of, anchors(width)), anchors(width).middle), "told")
    return repeats.repeated(told, texts, words_of, width)


def remove(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    texts = placed(id_and_text(docs))
    met = repeats.meet_packed(_repeats(texts, width), texts)
    rows = met.mapInArrow(_remover(width, False), "doc_id bigint, kept_sha256 string, _n_words bigint, _n_removed bigint")
    return rows.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), "kept_sha256")


def cut(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without their repeated words: changed texts are the kept words joined by one space, and
    n_chars is set anew; texts that lose nothing stay as they are, those that lose all are dropped."""
    plain = docs.withColumn("doc_id", docs["doc_id"].cast("bigint"))
    apart = placed(plain)
    met = repeats.meet(_repeats(apart.select("doc_id", "text", "_place"), width), apart)
    schema = T.StructType([*plain.schema.fields, T.StructField("_kept", T.StringType()),
                           T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())])
    rows = met.mapInArrow(_remover(width, True), schema)
    rows = rows.where((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_words")))
    changed = F.col("_n_removed") > 0
    rows = rows.withColumn("text", F.when(changed, F.col("_kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(changed, F.length("_kept").cast("bigint")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
