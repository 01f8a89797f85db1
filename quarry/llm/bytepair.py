"""Byte-level BPE encoding and decoding with transducers.

**Encoding.** A split pattern cuts a text into pieces, and each piece's bytes go through a
finite-state transducer made from the ranks (token bytes -> id, the lower the earlier merged).
Two facts make merging a matter of neighbours only: a merge never crosses a boundary of the
result, so the tokens of a beginning of the result are the result of that beginning; and a row of
tokens is the result of its bytes if each two neighbours are the result of theirs. So a
nondeterministic machine needs as state only the last token and the place in the trie of the
token begun; it may end a token where its left neighbour stands it. ``Transducer`` determinises
this machine lazily: a state is the set of open threads, each with the tokens that it has not
emitted yet; what all threads agree on is emitted, at the latest when the longest token that could
still be open has been read. States are kept up to ``MAX_STATES``, then forgotten and made again.
A piece that is itself in the ranks is that token, as in the tiktoken library.

**Decoding.** Ids become their bytes; ``Utf8Stream`` follows the UTF-8 state machine through the stream
of tokens, gives out whole characters and holds back an unfinished one, also between chunks.

Both work through a text in windows of ``WINDOW`` characters or ids, so besides the text and its ids (one Arrow
value each, which Arrow limits to 2 GB) a task holds a window and the bounded caches. A window longer than that is
taken only for a single piece that does not fit. No shuffle; one task a split.

Defined cases: a null text counts as empty, and null ids decode to an empty text; ids are written as little-endian unsigned
32-bit integers; an id without bytes fails the decoding; bytes that are no UTF-8 stay as they are in ``decoded`` and become
U+FFFD in the text; repeated rows are encoded each; other columns pass through, except those that
bear the names of the new ones (the caller may choose others), which are replaced; empty tables give no rows.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WINDOW = 1 << 18        # characters or ids handled at once
MARGIN = 4              # characters at the end of a window that may still change the match before them
MAX_STATES = 200_000    # states kept by a transducer (about 600 bytes each)
MAX_PIECES = 150_000    # pieces whose ids are kept, in each of two generations (about 300 bytes each)
MAX_KEPT = 32           # characters of the longest piece whose ids are kept
MAX_PAIRS = 250_000     # neighbours whose answer is kept
OUT_BYTES = 8 << 20     # size of a result batch


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """(token bytes, id) of a rank file: lines of base64 and a number. A vocabulary, so small whatever the tables' size."""
    lines = (line.split() for line in open(path, "rb"))
    return [(base64.b64decode(token), int(number)) for token, number in lines]


class Merges:
    """Merging by rank, and which tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the ranks lack the single bytes {missing[:5]}")
        self.ranks, self._edges = ranks, {}

    def steps(self, token: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """What is left of ``token`` after merging, and per merge its rank and the then first and last part."""
        parts = [token[i:i + 1] for i in range(len(token))]
        done = []
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 62:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            done.append((best[0], parts[0], parts[-1]))
        return parts, done

    def edges(self, token: bytes):
        """The ranks of the token's merges with its first and last part before each; None if merging does not give the token."""
        found = self._edges.get(token, 0)
        if found == 0:
            parts, done = self.steps(token)
            if len(parts) > 1:
                found = None
            else:
                found = ([r for r, _, _ in done] + [1 << 62], [token[:1]] + [a for _, a, _ in done], [token[-1:]] + [b for _, _, b in done])
            self._edges[token] = found
        return found

    def neighbours(self, left: bytes, right: bytes) -> bool:
        """Whether ``left`` and ``right`` stay apart when their joined bytes are merged.

        Both merge on their own, always the lower rank next (the left one first if equal), until
        a merge across the boundary comes before the next merge of either side, or never does."""
        left_ranks, _, ends = self.edges(left)
        right_ranks, begins, _ = self.edges(right) or ([], [], [])
        i = j = 0
        while begins:       # without, merging does not give ``right`` at all
            across = self.ranks.get(ends[i] + begins[j], 1 << 62)
            if across < left_ranks[i] and across <= right_ranks[j]:
                return False
            if left_ranks[i] == right_ranks[j] == 1 << 62:
                return True
            if left_ranks[i] <= right_ranks[j]:
                i += 1
            else:
                j += 1
        return False


class Transducer:
    """Bytes of a piece to ids.

    A state is a tuple of threads: the id of each one's last token (-1 at the start), its node in the trie
    and the ids that it has yet to emit. ``moves`` has, by state * 256 + byte, twice the next state, plus 1 if ids are emitted."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges, self.bytes_of = Merges(ranks), {number: token for token, number in ranks.items()}
        self.children: dict[int, int] = {}      # trie: node * 256 + byte -> node
        self.token: dict[int, int] = {}         # node -> id of the token that ends there
        for token, number in ranks.items():
            node = 0
            for b in token:
                node = self.children.setdefault(node << 8 | b, len(self.children) + 1)
            self.token[node] = number
        self.follows: dict[int, bool] = {}      # left id * 2^32 + right id -> whether it may follow
        self.inner = {key >> 8 for key in self.children}    # nodes that something follows
        self._forget()

    def _forget(self) -> None:
        self.known: dict[tuple, int] = {}
        self.threads: list[tuple] = []
        self.moves: dict[int, int] = {}
        self.emitted: dict[int, tuple[int, ...]] = {}
        self._state(((-1, 0, ()),))

    def _state(self, threads: tuple) -> int:
        found = self.known.setdefault(threads, len(self.threads))
        if found == len(self.threads):
            self.threads.append(threads)
        return found

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the token ``right`` may come after ``left`` (-1: at the begin)."""
        token = self.bytes_of[right]
        found = self.merges.neighbours(self.bytes_of[left], token) if left >= 0 else self.merges.edges(token) is not None
        if len(self.follows) >= MAX_PAIRS:
            self.follows.clear()
        self.follows[left << 32 | right] = found
        return found

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state if more bytes follow, and what is emitted on the way there; kept, unless all had to be forgotten."""
        children, token_at, inner, follows = self.children, self.token, self.inner, self.follows
        open_, ended = [], None
        for left, node, owed in self.threads[state]:    # in the order of their begin: the longest token is tried first
            node = children.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                open_.append((left, node, owed))
            if ended is None:
                token = token_at.get(node)
                if token is not None:
                    fits = follows.get(left << 32 | token)
                    if self._may_follow(left, token) if fits is None else fits:
                        ended = (token, 0, owed + (token,))     # there is always exactly one
        open_.append(ended)
        out = first = open_[0][2]
        if first:       # what all threads agree on is settled
            shared = 0
            while all(len(owed) > shared and owed[shared] == first[shared] for _, _, owed in open_):
                shared += 1
            out = first[:shared]
            if shared:
                open_ = [(left, node, owed[shared:]) for left, node, owed in open_]
        if len(self.threads) >= MAX_STATES:
            self._forget()
            return self._state(tuple(open_)), out
        found = self._state(tuple(open_))
        self.moves[state << 8 | byte] = found << 1 | bool(out)
        if out:
            self.emitted[state << 8 | byte] = out
        return found, out

    def _end(self, state: int, byte: int) -> tuple[int, ...]:
        """What is emitted if ``byte`` is the last one."""
        children, token_at, follows = self.children, self.token, self.follows
        for left, node, owed in self.threads[state]:
            token = token_at.get(children.get(node << 8 | byte))
            if token is not None:
                if left < 0:        # the piece is a token itself
                    return (token,)
                fits = follows.get(left << 32 | token)
                if self._may_follow(left, token) if fits is None else fits:
                    return owed + (token,)
        raise AssertionError("no token ends the piece")

    def __call__(self, piece: bytes) -> list[int]:
        state, out, moves = 0, [], self.moves
        for byte in piece[:-1]:
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                state, emitted = self._move(state, byte)
                moves = self.moves
                out += emitted
            else:
                state = move >> 1
                if move & 1:
                    out += self.emitted[key]
        if piece:
            out += self._end(state, piece[-1])
        return out


class Encoder:
    """Texts to ids: the pieces of the pattern, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.pattern, self.transducer = regex.compile(pattern), Transducer(ranks)
        # ids of pieces: when the new ones are full they become the old ones, and those not asked for again go
        self.kept: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str, window: int = WINDOW):
        """Lists of pieces. A match counts once ``MARGIN`` characters beyond it are in the window, or the text ends."""
        at, size = 0, window
        while at < len(text):
            part = text[at:at + size]
            if at + size >= len(text):
                yield self.pattern.findall(part)
                return
            found, end = [], 0
            for match in self.pattern.finditer(part):
                if match.end() > len(part) - MARGIN:
                    break
                found.append(match.group())
                end = match.end()
            if end:
                yield found
                at, size = at + end, window
            else:
                size *= 2   # one piece is longer than the window

    def __call__(self, text: str, window: int = WINDOW):
        """Arrays of ids, one for each window."""
        kept, old, run = self.kept, self.old, self.transducer
        for pieces in self.pieces(text, window):
            ids: list[int] = []
            for piece in pieces:
                found = kept.get(piece)
                if found is None:
                    found = old.get(piece)
                    if found is None:
                        found = tuple(run(piece.encode("utf-8", "surrogatepass")))
                    if len(piece) <= MAX_KEPT:
                        if len(kept) >= MAX_PIECES:
                            old = self.old = kept
                            kept = self.kept = {}
                        kept[piece] = found
                ids += found
            yield np.array(ids, dtype="<u4")


def worker_kept(key, make):
    """What ``make`` returns, kept as long as the Python worker runs: its later tasks find it again.

    Functions come to the workers by value, so variables of this module do not last."""
    home = sys.modules.setdefault("_quarry_worker", types.ModuleType("_quarry_worker")).__dict__
    if home.get("key") != key:      # one at a time: the memory stays bounded
        home["key"], home["made"] = key, make()
    return home["made"]


# The UTF-8 state machine (fixed values of the encoding): a state is the range of the next byte, and the state after it.
# 0 is "between characters"; 1, 2, 3 take one, two, three more bytes; 4 to 7 restrict the byte after E0, ED, F0, F4.
_NEXT = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2),
         4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
BROKEN = -1


def _first(byte: int) -> int:
    if byte < 0x80:
        return 0
    if 0xC2 <= byte <= 0xDF:
        return 1
    if 0xE0 <= byte <= 0xEF:
        return {0xE0: 4, 0xED: 5}.get(byte, 2)
    if 0xF0 <= byte <= 0xF4:
        return {0xF0: 6, 0xF4: 7}.get(byte, 3)
    return BROKEN


def utf8_step(state: int, byte: int) -> int:
    """The state after ``byte``; BROKEN if it cannot follow."""
    if state == 0:
        return _first(byte)
    low, high, after = _NEXT[state]
    return after if low <= byte <= high else BROKEN


class Utf8Stream:
    """Chunks of tokens to text: whole characters come out, an unfinished one waits for the next chunk.

    Tokens that hold whole characters only are passed over at once; the machine runs through the
    others byte by byte. What cannot be UTF-8 becomes U+FFFD, one for each run of bytes that
    begins a character and does not end it, and one for each other byte."""

    def __init__(self, table: "TokenBytes"):
        self.table, self.state, self.waiting, self.broken = table, 0, b"", False

    def feed(self, ids: np.ndarray) -> tuple[bytes, str]:
        """The bytes of the chunk, and the characters that are whole by its end."""
        raw, where = self.table(ids)
        special = np.flatnonzero(~self.table.whole[ids])
        data, where = self.waiting + raw.tobytes(), where + len(self.waiting)
        text, state = [], self.state
        done = begin = token = 0    # bytes handed out; begin of the open character; token to run through
        while True:
            if state == 0:
                k = int(np.searchsorted(special, token))
                if k == len(special):
                    break
                token = int(special[k])
            elif token == len(ids):
                break
            for p in range(int(where[token]), int(where[token + 1])):
                after = utf8_step(state, data[p])
                if after == BROKEN and state:   # the open character ends unfinished, and this byte stands anew
                    text += [data[done:begin].decode(), "\ufffd"]
                    done, state, self.broken = p, 0, True
                    after = utf8_step(0, data[p])
                if after == BROKEN:
                    text += [data[done:p].decode(), "\ufffd"]
                    done, after, self.broken = p + 1, 0, True
                elif state == 0:
                    begin = p
                state = after
            token += 1
        end = begin if state else len(data)
        text.append(data[done:end].decode())
        self.state, self.waiting = state, data[end:]
        return raw.tobytes(), "".join(text)

    def finish(self) -> str:
        """The end of the stream: an unfinished character is broken."""
        if not self.state:
            return ""
        self.broken, self.state, self.waiting = True, 0, b""
        return "\ufffd"


class TokenBytes:
    """Bytes of ids, and which tokens hold whole characters only."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        by_id = [b""] * size
        for token, number in ranks.items():
            by_id[number] = token
        self.given = np.array([len(t) > 0 for t in by_id] or [False])
        self.lengths = np.array([len(t) for t in by_id] or [0], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), dtype=np.uint8)
        self.whole = np.zeros(max(size, 1), dtype=bool)
        for number, token in enumerate(by_id):
            state = 0
            for b in token:
                state = utf8_step(state, b)
                if state == BROKEN:
                    break
            self.whole[number] = state == 0

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and where each begins (one more for the end)."""
        bad = (ids >= len(self.given)) | ~self.given[np.minimum(ids, len(self.given) - 1)]
        if bad.any():
            raise ValueError(f"no token has the id {int(ids[bad][0])}")
        lengths = self.lengths[ids]
        where = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(lengths, out=where[1:])
        source = np.repeat(self.starts[ids] - where[:-1], lengths) + np.arange(where[-1])
        return self.flat[source], where


def _batches(batch: pa.RecordBatch, made: dict[str, tuple[list, pa.DataType]], sizes: list[int]):
    """The batch with new columns, cut into runs of rows whose new values have about ``OUT_BYTES``."""
    row = 0
    while row < batch.num_rows:
        end, size = row, 0
        while end < batch.num_rows and (end == row or size + sizes[end] <= OUT_BYTES):
            size += sizes[end]
            end += 1
        part = batch.slice(row, end - row)
        columns = list(part.columns) + [pa.array(values[row:end], kind) for values, kind in made.values()]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *made])
        row = end


def _encode_task(ranks: list[tuple[bytes, int]], pattern: str, text_at: int, names: tuple[str, str]):
    key = hashlib.sha256(repr((ranks, pattern)).encode()).hexdigest()

    def run(batches):
        for batch in batches:
            encoder = worker_kept(key, lambda: Encoder(dict(ranks), pattern))
            ids, counts = [], []
            gc.disable()    # hundreds of thousands of small tuples without cycles: looking for cycles takes a third of the time
            try:
                for text in batch.column(text_at):
                    chunks = list(encoder(text.as_py() or ""))
                    ids.append(b"".join(c.tobytes() for c in chunks))
                    counts.append(sum(map(len, chunks)))
            finally:
                gc.enable()
            yield from _batches(batch, {names[0]: (ids, pa.binary()), names[1]: (counts, pa.int64())}, list(map(len, ids)))
    return run


def _decode_task(ranks: list[tuple[bytes, int]], ids_at: int, names: tuple[str, str]):
    def run(batches):
        table = None
        for batch in batches:
            table = table or TokenBytes(dict(ranks))
            raws, texts = [], []
            for value in batch.column(ids_at):
                ids, stream, raw, text = np.frombuffer(value.as_py() or b"", dtype="<u4"), Utf8Stream(table), [], []
                for at in range(0, len(ids), WINDOW):
                    a, b = stream.feed(ids[at:at + WINDOW])
                    raw.append(a)
                    text.append(b)
                text.append(stream.finish())
                raws.append(b"".join(raw))
                # the text only where it differs from the bytes: equal UTF-8 is not sent twice
                texts.append("".join(text) if stream.broken else None)
            yield from _batches(batch, {names[0]: (raws, pa.binary()), names[1]: (texts, pa.string())}, list(map(len, raws)))
    return run


def encode(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str, text_col: str = "text",
           ids_col: str = "ids", count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the ids of its text (little-endian unsigned 32-bit integers, as binary) and their number."""
    kept = [c for c in docs.columns if c not in (ids_col, count_col)]
    rows = docs.select(*[docs[c] for c in kept])
    schema = StructType(rows.schema.fields + [StructField(ids_col, BinaryType()), StructField(count_col, LongType())])
    return rows.mapInArrow(_encode_task(ranks, pattern, kept.index(text_col), (ids_col, count_col)), schema)


def decode(encoded: DataFrame, ranks: list[tuple[bytes, int]], ids_col: str = "ids",
           decoded_col: str = "decoded", text_col: str = "decoded_text") -> DataFrame:
    """``encoded`` with the bytes of its ids, and these as text (invalid UTF-8 as U+FFFD)."""
    kept = [c for c in encoded.columns if c not in (decoded_col, text_col)]
    rows = encoded.select(*[encoded[c] for c in kept])
    schema = StructType(rows.schema.fields + [StructField(decoded_col, BinaryType()), StructField(text_col, StringType())])
    made = rows.mapInArrow(_decode_task(ranks, kept.index(ids_col), (decoded_col, text_col)), schema)
    return made.withColumn(text_col, F.coalesce(made[text_col], made[decoded_col].cast("string")))


def round_trip(docs: DataFrame, ranks: list[tuple[bytes, int]], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again (in one task each)."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    encoding, decoding = _encode_task(ranks, pattern, 1, ("ids", "n_tokens")), _decode_task(ranks, 1, ("decoded", "decoded_text"))

    def run(batches):
        encoded = (batch.select(["doc_id", "ids", "n_tokens"]) for batch in encoding(batches))
        for batch in decoding(encoded):
            yield batch.select(["doc_id", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
