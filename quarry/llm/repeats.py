"""Windows that also start earlier in the corpus: shared core of the two substring operators.

A document is a sequence of 64-bit elements (words or bytes). Every window of ``width``
elements chooses one anchor from its interior by content alone, so equal windows choose
the same anchor at the same place; consecutive windows mostly share theirs. What is
dealt out over the cluster is an occurrence of an anchor, not a window:

1. An occurrence has a key (the anchor's surroundings that lie in all its windows) and a
   name (all that its windows cover). It goes to the part of its key. Occurrences with
   equal key and name are equal in all their windows: all but the earliest are repeats.
   Those that meet within a map task are settled there, so a hot passage
   reaches its part about once per task.
2. If a key has several names, their earliest occurrences may still share some windows.
   Two that do agree on half a window before the anchor or after it, of which each
   has a 16-bit mark. Those that share a mark are asked for details: the hash of each of
   their windows on that side, dealt out alike.
3. What repeats is sent to the parts of the documents, where the texts meet it.

A window is found by 128 bits of hash. Parts hold bounded arrays: there are a few for
each shuffle partition.

Rows that repeat a doc_id are one document: its windows are compared by start, and equal
starts are not earlier. Each row is told apart by a hash of its elements as well. Each row without a doc_id
is a document of its own (see ``tables.placed``).
"""

from __future__ import annotations

from typing import Callable, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import SLICE_BYTES, U64, RangeHash, binary_column, column_slices, mix
from .tables import deal_count

LAST = np.iinfo(np.int64).max
POSTED, REPEATS, DETAILS, TEXT = 0, 1, 2, 9
FIELDS = (("key", U64), ("name", U64), ("doc", np.int64), ("row", np.int32), ("begin", np.int32), ("count", np.int16),
          ("offset", np.int16), ("left", np.uint16), ("right", np.uint16))
POSTED_ONLY = ("key", "name", "offset", "left", "right")
ROWS = "part int, kind int, " + ", ".join(f"{f} binary" for f, _ in FIELDS)
SEND_BYTES = 64 << 20           # ids of documents that may be sent to every task
SLICE = 1 << 20                 # bytes of text handled at once
HELD = 1 << 20                  # occurrences that a task gathers before it sends them


class Sequence(NamedTuple):
    """Elements of a slice of rows: row i has elements[first[i]:first[i + 1]]."""
    elements: np.ndarray
    first: np.ndarray


class Anchors(NamedTuple):
    """How windows choose: ``before`` and ``after`` bound what an anchor's key covers; priorities are per position."""
    width: int
    before: int
    after: int
    priority: Callable[[Sequence, RangeHash], tuple[np.ndarray, np.ndarray]]  # (priority, eligible) of each position

    @property
    def middle(self) -> int:
        """Windows that begin at least so far before their anchor are its left ones."""
        return (self.before + self.width - self.after) // 2


def sliding_min(x: np.ndarray, m: int) -> np.ndarray:
    """Minimum of each m consecutive values."""
    have, out = 1, x
    while have * 2 <= m:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (m - have)], out[m - have:]) if have < m else out


def occurrences(seq: Sequence, how: Anchors, ranges: RangeHash):
    """Occurrences of a slice, in order: first window, windows, key, name, anchor's offset, left and right marks."""
    n, width = len(seq.elements), how.width
    ends = np.repeat(seq.first[1:], np.diff(seq.first))
    windows = np.flatnonzero(np.arange(n) + width <= ends)
    none = np.zeros(0, np.int64)
    if not len(windows):
        return none, none, none.astype(U64), none.astype(U64), none, none, none
    priority, eligible = how.priority(seq, ranges)
    bits = U64(max(1, int(n).bit_length()))
    place = (U64(1) << bits) - U64(1)
    ranked = np.where(eligible, (priority & ~place) | np.arange(n, dtype=U64), ~U64(0))
    least = sliding_min(ranked, width - how.after - how.before + 1)
    chosen = least[windows + how.before]
    lonely = chosen == ~U64(0)  # no anchor inside: the window stands for itself
    at = np.where(lonely, n + windows, (chosen & place).astype(np.int64))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(at)))
    begin, at, lonely = windows[start], at[start], lonely[start]
    key = np.zeros(len(begin), dtype=U64)
    key[~lonely] = ranges(at[~lonely] - how.before, at[~lonely] + how.after)
    key[lonely] = mix(ranges(begin[lonely], begin[lonely] + width) ^ U64(0xA5A5A5A5))
    offset = np.where(lonely, 0, at - begin)
    name = mix(ranges(begin, begin + count - 1 + width) + offset.astype(U64) * U64(0x9E3779B97F4A7C15) + count.astype(U64))
    owner = np.searchsorted(seq.first, begin, "right") - 1
    left, right = np.zeros(len(begin), np.uint16), np.zeros(len(begin), np.uint16)
    # left windows reach at least ``middle`` before the anchor, right ones at least the rest of a window after
    for mark, lo, hi in ((left, at - how.middle, at + how.after), (right, at - how.before, at + width - how.middle + 1)):
        inside = ~lonely & (lo >= seq.first[owner]) & (hi <= seq.first[owner + 1])
        mark[inside] = np.maximum(1, ranges(lo[inside], hi[inside]) & U64(0xFFFF))
    return begin, count, key, name, offset, left, right


def doc_part(doc: np.ndarray, parts: int) -> np.ndarray:
    x = doc.astype(U64)
    return ((x ^ (x >> U64(17)) ^ (x >> U64(33))) & U64(LAST)).astype(np.int64) % parts


def doc_part_column(x, parts: int):
    """The same as ``doc_part``, as a column."""
    mixed = x.bitwiseXOR(F.shiftrightunsigned(x, 17)).bitwiseXOR(F.shiftrightunsigned(x, 33))
    return (mixed.bitwiseAND(F.lit(LAST)) % parts).cast("int")


class Table(NamedTuple):
    """Columns of occurrences, named as FIELDS."""
    key: np.ndarray
    name: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def pick(self, which) -> Table:
        return Table(*(x[which] for x in self))


def joined(tables: list[Table]) -> Table:
    return Table(*(np.concatenate(x) for x in zip(*tables))) if tables else Table(*(np.zeros(0, t) for _, t in FIELDS))


def packed(kind: int, part: np.ndarray, table: Table) -> pa.RecordBatch | None:
    """One row for each part, its occurrences by document (which compresses well)."""
    if not len(part):
        return None
    order = np.lexsort((table.begin, table.doc, part))
    part, table = part[order], table.pick(order)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    size = np.diff(np.append(first, len(part)))
    bare = kind != POSTED
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int32)),
         *(binary_column(np.zeros(0, t), 0 * size) if bare and f in POSTED_ONLY else binary_column(x.astype(t), size)
           for (f, t), x in zip(FIELDS, table))],
        names=["part", "kind", *(f for f, _ in FIELDS)])


def unpacked(batch: pa.RecordBatch, i: int, bare: bool) -> Table:
    out = {f: np.frombuffer(batch.column(f)[i].as_py(), dtype=t) for f, t in FIELDS}
    if bare:
        out |= {f: np.zeros(len(out["doc"]), t) for f, t in FIELDS if f in POSTED_ONLY}
    return Table(**out)


def by_name(table: Table) -> tuple[Table, np.ndarray, np.ndarray]:
    """Sorted by key, name, document, start; and where each (key, name) and each key begins."""
    table = table.pick(np.lexsort((table.begin, table.doc, table.name, table.key)))
    key_new = np.ones(len(table.key), dtype=bool)
    key_new[1:] = table.key[1:] != table.key[:-1]
    name_new = key_new.copy()
    name_new[1:] |= table.name[1:] != table.name[:-1]
    return table, name_new, key_new


def later(table: Table, name_new: np.ndarray) -> np.ndarray:
    """Whether an earlier occurrence has the same key and name; ``table`` as from ``by_name``."""
    if not len(name_new):
        return name_new
    lead = np.maximum.accumulate(np.where(name_new, np.arange(len(name_new)), 0))
    return (table.doc != table.doc[lead]) | (table.begin != table.begin[lead])


def _met(key: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Whether another occurrence has the same key and mark (0: no mark)."""
    both = mix(key ^ (mark.astype(U64) * U64(0xD1B54A32D192ED03)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out & (mark != 0)


def ask(table: Table, middle: int) -> Table:
    """Of the earliest occurrences of different names, the windows that may be shared."""
    if not len(table.key):
        return table
    left, right = _met(table.key, table.left), _met(table.key, table.right)
    lefts = np.clip(table.offset.astype(np.int64) - middle + 1, 0, table.count)
    begin = table.begin + np.where(left, 0, lefts)
    count = np.where(left, lefts, 0) + np.where(right, table.count - lefts, 0)
    return table._replace(begin=begin, count=count).pick(count > 0)


class Outbox:
    """What a task sends: gathered over slices and parts, so that each receiver gets few rows of it."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size = parts, {}, 0

    def add(self, kind: int, table: Table) -> None:
        if len(table.doc):
            self.held.setdefault(kind, []).append(table)
            self.size += len(table.doc)

    def rows(self, at_least: int = 0):
        """Rows of all that is held, if it is ``at_least`` so much.

        Occurrences that repeat others held here go to their documents, the rest to their keys.
        """
        if self.size < max(1, at_least):
            return
        held, self.held, self.size = self.held, {}, 0
        if POSTED in held:
            table, name_new, _ = by_name(joined(held[POSTED]))
            repeat = later(table, name_new)
            held[POSTED] = [table.pick(~repeat)]
            held.setdefault(REPEATS, []).append(table.pick(repeat))
        for kind, tables in held.items():
            table = joined(tables)
            part = (table.key % U64(self.parts)).astype(np.int64) if kind == POSTED else doc_part(table.doc, self.parts)
            if (rows := packed(kind, part, table)) is not None:
                yield rows


def slice_rows(batch: pa.RecordBatch, sequence) :
    """(first row, slice's byte view, Sequence, its RangeHash, place and row hash of each row) of a batch with _place and text."""
    doc = batch.column(batch.schema.get_field_index("_place")).to_numpy()
    for row, offsets, data in column_slices(batch, "text", SLICE):
        view, seq = sequence(offsets, data)
        ranges = RangeHash(seq.elements)
        yield row, view, seq, ranges, doc[row:row + len(offsets) - 1], ranges(seq.first[:-1], seq.first[1:]).astype(np.int32)


def _poster(sequence, how: Anchors, parts: int):
    def post(batches):
        out = Outbox(parts)
        for batch in batches:
            for _, _, seq, ranges, doc, row in slice_rows(batch, sequence):
                begin, count, key, name, *rest = occurrences(seq, how, ranges)
                owner = np.searchsorted(seq.first, begin, "right") - 1
                out.add(POSTED, Table(key, name, doc[owner], row[owner], begin - seq.first[owner], count, *rest))
                yield from out.rows(HELD)
        yield from out.rows()
    return post


def post(texts: DataFrame, sequence, how: Anchors) -> DataFrame:
    """Occurrences of ``texts`` (as from ``tables.placed``), packed by part."""
    return texts.select("_place", "text").mapInArrow(_poster(sequence, how, deal_count(texts.sparkSession)), ROWS)


def parts_of(batches):
    """(part, {kind: tables}) of rows sorted by part."""
    now, held = None, {}
    for batch in batches:
        part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        for i in range(batch.num_rows):
            if now is not None and part[i] != now:
                yield now, held
                held = {}
            now = part[i]
            held.setdefault(int(kind[i]), []).append(unpacked(batch, i, kind[i] not in (POSTED, -1)))
    if now is not None:
        yield now, held


def _settler(parts: int, middle: int):
    """Per part of keys: occurrences that repeat an earlier one, and those asked for details."""
    def settle(batches):
        out = Outbox(parts)
        for _, held in parts_of(batches):
            table, name_new, key_new = by_name(joined(held.get(POSTED, [])))
            repeat = later(table, name_new)
            names = np.add.reduceat(name_new, np.flatnonzero(key_new)) if len(key_new) else key_new
            several = np.repeat(names > 1, np.diff(np.append(np.flatnonzero(key_new), len(key_new))))
            out.add(REPEATS, table.pick(repeat))
            out.add(DETAILS, ask(table.pick(~repeat & several), middle))
            out.add(REPEATS, joined(held.get(REPEATS, [])))
            yield from out.rows(HELD)
        yield from out.rows()
    return settle


def settle(posted: DataFrame, middle: int = 0) -> DataFrame:
    """Rows for the documents' parts: repeats and details."""
    dealt = posted.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(_settler(deal_count(posted.sparkSession), middle), ROWS)


def _packer(parts: int):
    """Texts by document part: places, lengths, whether the id is null, and one compressed run of bytes for each slice and part."""
    def pack(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            doc, unnamed = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for row, offsets, data in column_slices(batch, "text", 4 * SLICE_BYTES):
                ids = doc[row:row + len(offsets) - 1]
                part = doc_part(ids, parts)
                order = np.argsort(part, kind="stable")
                size = np.diff(offsets)
                view = memoryview(np.ascontiguousarray(data))
                cut = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) > 0, [True]]))
                blobs = [press.compress(b"".join(view[offsets[i]:offsets[i + 1]] for i in order[a:b])) for a, b in zip(cut[:-1], cut[1:])]
                many = np.diff(cut)
                none = binary_column(np.zeros(0, np.int64), 0 * many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[order][cut[:-1]].astype(np.int32)), pa.array(np.full(len(many), TEXT, np.int32)),
                     binary_column(size[order], many), pa.array(blobs, pa.binary()), binary_column(ids[order], many),
                     binary_column(unnamed[row:row + len(ids)][order].astype(np.int32), many), *[none] * (len(FIELDS) - 4)],
                    names=["part", "kind", *(f for f, _ in FIELDS)])
    return pack


def _unpacked_texts(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
    import zstandard

    size, doc = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int64) for c in ("key", "doc"))
    data = zstandard.ZstdDecompressor().decompress(batch.column("name")[i].as_py(), max_output_size=int(size.sum()) + 1)
    unnamed = np.frombuffer(batch.column("row")[i].as_py(), dtype=np.int32) != 0
    return pa.RecordBatch.from_arrays([pa.array(doc, mask=unnamed), pa.array(doc), binary_column(np.frombuffer(data, dtype=np.uint8), size)],
                                      names=["doc_id", "_place", "text"])


def meet_packed(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` and ``texts`` (as from ``tables.placed``), dealt by document part, rows first in each part; texts travel compressed."""
    packed_texts = texts.select("_place", "text", texts["doc_id"].isNull().alias("unnamed")).mapInArrow(_packer(deal_count(texts.sparkSession)), ROWS)
    return rows.union(packed_texts).repartition("part").sortWithinPartitions("part", "kind")


def packed_told_texts(batches):
    """The same as ``told_texts``, from ``meet_packed``."""
    now, held, sorted_ = None, {}, None
    for batch in batches:
        part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        for i in range(batch.num_rows):
            if part[i] != now:
                now, held, sorted_ = part[i], {}, None
            if kind[i] != TEXT:
                held.setdefault(int(kind[i]), []).append(unpacked(batch, i, True))
                continue
            if sorted_ is None:
                sorted_, held = _by_document(held), {}
            yield _unpacked_texts(batch, i), sorted_


def _by_document(held: dict[int, list[Table]]) -> dict[int, Table]:
    tables = {k: joined(x) for k, x in held.items()}
    return {k: x.pick(np.lexsort((x.begin, x.doc))) for k, x in tables.items()}


def meet(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` and ``docs`` (as from ``tables.placed``, and other columns), dealt by document part, rows first in each part."""
    parts = deal_count(docs.sparkSession)
    names = rows.columns
    told = rows.select(*[F.col(c).alias(f"_r_{c}") for c in names])
    texts = docs.withColumns({"_r_part": doc_part_column(docs["_place"], parts), "_r_kind": F.lit(TEXT)})
    both = told.unionByName(texts, allowMissingColumns=True)
    return both.repartition("_r_part").sortWithinPartitions("_r_part", "_r_kind")


def told_texts(batches):
    """(batch of texts of one part, {kind: table of what their part was told, sorted by document}) from ``meet``."""
    now, held, sorted_ = None, {}, None
    for batch in batches:
        part, kind = batch.column("_r_part").to_numpy(), batch.column("_r_kind").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | ((kind[1:] == TEXT) != (kind[:-1] == TEXT)), [True]])) if len(part) else []
        told = None
        for a, b in zip(cut[:-1], cut[1:]):
            if part[a] != now:
                now, held, sorted_ = part[a], {}, None
            some = batch.slice(a, b - a)
            if kind[a] != TEXT:
                told = pa.RecordBatch.from_arrays([some.column(f"_r_{c}") for c in ("part", "kind", *(f for f, _ in FIELDS))],
                                                  names=["part", "kind", *(f for f, _ in FIELDS)])
                for i in range(told.num_rows):
                    held.setdefault(int(kind[a + i]), []).append(unpacked(told, i, True))
                continue
            if sorted_ is None:
                sorted_, held = _by_document(held), {}
            keep = [i for i, c in enumerate(some.schema.names) if not c.startswith("_r_")]
            yield pa.RecordBatch.from_arrays([some.column(i) for i in keep], names=[some.schema.names[i] for i in keep]), sorted_


def told_of(table: Table | None, doc: np.ndarray, row: np.ndarray):
    """(index of the text, first window, windows) that ``table`` has of the texts."""
    none = np.zeros(0, np.int64)
    if table is None or not len(doc):
        return none, none, none
    lo, hi = np.searchsorted(table.doc, doc, "left"), np.searchsorted(table.doc, doc, "right")
    size = hi - lo
    which = np.repeat(np.arange(len(doc)), size)
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    own = table.row[at] == row[which]
    return which[own], table.begin[at[own]].astype(np.int64), table.count[at[own]].astype(np.int64)


def _detailer(sequence, width: int, parts: int):
    def run(batches):
        out = Outbox(parts)
        for batch, told in packed_told_texts(batches):
            for _, _, seq, ranges, doc, row in slice_rows(batch, sequence):
                which, begin, count = told_of(told.get(DETAILS), doc, row)
                if not len(which):
                    continue
                owner = np.repeat(which, count)
                start = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
                pair = np.unique(np.stack([owner, start]), axis=1)
                owner, start = pair
                at = seq.first[owner] + start
                second = RangeHash(mix(seq.elements ^ U64(0x5851F42D4C957F2D)))
                none = np.zeros(len(at), np.int64)
                out.add(POSTED, Table(ranges(at, at + width), second(at, at + width), doc[owner], row[owner], start,
                                      none + 1, none, none, none))
                yield from out.rows(HELD)
        yield from out.rows()
    return run


def details(told: DataFrame, texts: DataFrame, sequence, width: int) -> DataFrame:
    """Windows of the occurrences that were asked for details, packed by part.

    Only texts that were asked are dealt out: their ids are sent to every task if they
    take at most SEND_BYTES, else they are joined.
    """
    asked = told.where(F.col("kind") == DETAILS)
    ids = asked.select("doc").mapInArrow(_ids, "asked bigint").distinct()
    few = ids.count() * 8 <= SEND_BYTES
    some = texts.join(F.broadcast(ids) if few else ids, texts["_place"] == ids["asked"], "left_semi")
    return meet_packed(asked, some).mapInArrow(_detailer(sequence, width, deal_count(texts.sparkSession)), ROWS)


def _ids(batches):
    for batch in batches:
        for packed_ids in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(packed_ids.as_py(), dtype=np.int64)))], names=["asked"])


def repeated(told: DataFrame, texts: DataFrame, sequence, width: int) -> DataFrame:
    """All repeats: those ``told`` already, and those that the details show."""
    more = settle(details(told, texts, sequence, width))
    return told.where(F.col("kind") == REPEATS).union(more.where(F.col("kind") == REPEATS))


def covered(seq: Sequence, told: dict[int, Table], doc: np.ndarray, row: np.ndarray, width: int) -> np.ndarray:
    """Which elements of a slice lie in a repeated window."""
    which, begin, count = told_of(told.get(REPEATS), doc, row)
    at = seq.first[which] + begin
    n = len(seq.elements)
    turns = np.bincount(at, minlength=n + 1) - np.bincount(at + count - 1 + width, minlength=n + 1)
    return np.cumsum(turns[:n]) > 0
