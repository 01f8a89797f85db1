"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of a sample of labelled text. A text is
parsed greedily into the longest phrases that occur in a language's sample; the
fewer phrases, normalised by the sample's length (a phrase costs log2 of the places
it can point to), the closer the language.

The sample is bounded by labelled rows alone: ``sample_rows`` documents a language, of different texts that have a
letter. Their texts are learned from whole, whatever their length and however many languages there are. A text to be
labelled is parsed whole too, in pieces of ``piece`` symbols side by side, each starting a new phrase in every language alike.

Letters are the bytes a-z (A-Z lower-cased) and those from 0x80 on; what lies between
them counts as one space.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is
every text if nothing can be learned; equal costs go to the first language by code
point; labels that are null are ignored; of rows that repeat an id in a language the text of least hash is learned from; a null doc_id is scored and never learned from;
empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import column_slices

SAMPLE_ROWS = 60
PIECE = 256
SALTS = 64


def _letter_table() -> np.ndarray:
    table = np.full(256, 0x20, dtype=np.uint8)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


LETTERS = _letter_table()


def normalise(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters with single spaces between, and the new places of ``edges``. Nothing is joined across an edge:
    a row's letters are the same whatever stands before it."""
    out = LETTERS[data]
    latin = np.zeros(len(out), dtype=bool)  # capitals of Latin-1 follow 0xC3
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    out[latin] |= 0x20
    space = out == 0x20
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[edges[edges < len(out)]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], places[edges]


def suffix_automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Transitions [state, symbol] of the suffix automaton; state 0 is the start and stands for "no such substring"."""
    moves: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols.tolist():
        now = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = now
            at = link[at]
        if at != -1:
            to = moves[at][symbol]
            if length[at] + 1 == length[to]:
                link[now] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at != -1 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = link[now] = copy
        last = now
    table = np.zeros((len(moves), alphabet), dtype=np.int32)
    state = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
    table[state, np.fromiter((s for m in moves for s in m), np.int64)] = np.fromiter((t for m in moves for t in m.values()), np.int64)
    return table


@dataclass
class Languages:
    names: list[str]
    symbol: np.ndarray          # byte -> symbol of the tables
    tables: list[np.ndarray]
    sizes: np.ndarray           # symbols in each sample

    def __getstate__(self):
        """Only the moves there are: a few for each state."""
        moves = [(t.shape, np.diff(np.flatnonzero(t), prepend=0).astype(np.uint32), t[t != 0]) for t in self.tables]
        return self.names, self.symbol, moves, self.sizes

    def __setstate__(self, state):
        self.names, self.symbol, moves, self.sizes = state
        self.tables = []
        for shape, steps, to in moves:
            table = np.zeros(shape, dtype=np.int32)
            table.ravel()[np.cumsum(steps, dtype=np.int64)] = to
            self.tables.append(table)


def learn(docs: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> Languages:
    """Suffix automata of a sample of ``docs`` (doc_id, text, lang) that meet ``train``, bounded by rows."""
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # one text for each id and language, however often they are repeated, told by its hash; then copies once
    rows = rows.select("doc_id", "lang", F.xxhash64("text").alias("h"))
    rows = rows.groupBy("lang", "doc_id").agg(F.min("h").alias("h")).groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"))
    order = F.xxhash64("doc_id")
    # first within salts, so that no task ranks all documents of a language
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)))
    salted = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(order, "doc_id"))).where(F.col("r") <= sample_rows)
    best = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))).where(F.col("r") <= sample_rows)
    picked = best.select(F.col("doc_id").alias("picked"), F.col("lang").alias("_lang"), "h")
    found = docs.join(F.broadcast(picked), (F.col("doc_id") == F.col("picked")) & (F.col("lang") == F.col("_lang")) & (F.xxhash64("text") == F.col("h")))
    got = found.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).toArrow()
    texts: dict[str, list[bytes]] = {}
    for row in got.sort_by([("lang", "ascending"), ("doc_id", "ascending"), ("text", "ascending")]).to_pylist():
        texts.setdefault(row["lang"], []).append(row["text"].encode())
    names, samples = sorted(texts), []
    for name in names:
        data = np.frombuffer(b" ".join(texts[name]), dtype=np.uint8)
        samples.append(normalise(data, np.array([0]))[0])
    symbol = np.zeros(256, dtype=np.uint8)  # 0: in no sample
    if samples:
        used = np.unique(np.concatenate(samples))
        symbol[used] = np.arange(1, len(used) + 1)
    alphabet = int(symbol.max()) + 1
    return Languages(names, symbol, [suffix_automaton(symbol[s], alphabet) for s in samples], np.array([len(s) for s in samples]))


def phrases(pieces: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Greedy phrases of each piece: columns of ``pieces``, the longest piece first."""
    alphabet = table.shape[1]
    flat, start = table.ravel(), table[0]
    state = np.zeros(pieces.shape[1], dtype=np.int32)
    count = np.zeros(pieces.shape[1], dtype=np.int32)
    running = np.searchsorted(-lengths, -np.arange(pieces.shape[0]), "left")  # pieces longer than t
    for t in range(pieces.shape[0]):
        n = running[t]
        symbol = pieces[t, :n]
        to = flat[state[:n] * np.int32(alphabet) + symbol]
        stuck = np.flatnonzero(to == 0)
        begin = start[symbol[stuck]]
        count[stuck] += (state[stuck] != 0).astype(np.int32) + (begin == 0)  # a symbol in no sample is a phrase
        to[stuck] = begin
        state[:n] = to
    return count + (state != 0)


def _predictor(shared):
    def predict(batches):
        model = Languages.__new__(Languages)
        model.__setstate__(shared.value)
        names = pa.array([*model.names, "und"], pa.string())
        for batch in batches:
            for row, offsets, data in column_slices(batch, "text"):
                n = len(offsets) - 1
                symbols, edges = normalise(data, offsets)
                symbols = model.symbol[symbols]
                length = np.diff(edges)
                count = -(-length // PIECE)
                doc = np.repeat(np.arange(n), count)
                begin = edges[doc] + PIECE * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
                size = np.minimum(PIECE, edges[doc + 1] - begin)
                by = np.argsort(-size, kind="stable")
                at = begin[by][None, :] + np.arange(PIECE)[:, None]
                grid = symbols[np.minimum(at, max(0, len(symbols) - 1))] if len(symbols) else np.zeros((PIECE, 0), np.uint8)
                cost = np.zeros((n, max(1, len(model.names))))
                for i, table in enumerate(model.tables):
                    found = np.bincount(doc[by], weights=phrases(grid, size[by], table), minlength=n)
                    cost[:, i] = found * np.log2(model.sizes[i] + 1)
                best = cost.argmin(axis=1)
                # cost in bits, a quarter of it: phrases overlap in what they tell
                score = 1 / np.exp2(-(cost - cost.min(axis=1, keepdims=True)) / 4).sum(axis=1)
                letters = batch.column(batch.schema.get_field_index("has_letter")).slice(row, n).to_numpy(zero_copy_only=False).astype(bool)
                known = letters & (len(model.names) > 0)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, names.take(pa.array(np.where(known, best, len(model.names)))), pa.array(np.where(known, score, 0.0))],
                    names=[*part.schema.names, "lang_pred", "score"])
    return predict


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, lang_pred, score of each row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # at most 3 moves of 8 bytes for each sampled byte, spread to tables in the tasks; grows with the length of the sampled texts
    # and sent as plain values, so that executors need no copy of this package
    shared = docs.sparkSession.sparkContext.broadcast(model.__getstate__())
    return rows.mapInArrow(_predictor(shared), schema).select("doc_id", "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document (doc_id, text, lang)."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"), docs["lang"].alias("lang"))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = learn(rows, remainder != 2)
    return predict(rows, model).select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
