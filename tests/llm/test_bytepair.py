import hashlib
import random

import numpy as np
import pytest

from quarry.llm import bytepair, queries

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

RANKS = bytepair.read_ranks(tokenizers.path(bytepair.VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=dict(RANKS), special_tokens={})


def ids_of(encoder, text, window=bytepair.WINDOW):
    return [int(i) for chunk in encoder(text, window) for i in chunk]


def texts(seed, n):
    pick = random.Random(seed)
    kinds = ["ab =-é你\n\t 'srelvtm1", [chr(c) for c in range(32, 0x3000)], "abcdefghijklmnopqrstuvwxyz", "a", " \n", "0123456789 "]
    for _ in range(n):
        kind = pick.choice(kinds)
        yield "".join(pick.choice(kind) for _ in range(pick.randrange(80)))


def test_equals_the_library(library):
    encoder = bytepair.Encoder(dict(RANKS), tokenizers.PATTERN)
    for i, text in enumerate(texts(1, 1500)):
        assert ids_of(encoder, text, (7, 31, bytepair.WINDOW)[i % 3]) == library.encode_ordinary(text)
    for text in ("a" * 50_000, "=" * 30_001, "x y " * 20_000 + "é" * 5000, "<|endoftext|>", ""):
        assert ids_of(encoder, text, 1000) == library.encode_ordinary(text)


def random_ranks(seed):
    """Tokens in no sensible order: some that merging never gives, some before their parts."""
    pick = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)] + list({bytes(pick.choice(b"abc") for _ in range(pick.randrange(2, 7))) for _ in range(40)})
    pick.shuffle(tokens)
    return {t: i for i, t in enumerate(tokens)}


@pytest.mark.parametrize("seed", range(12))
def test_any_ranks(seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(bytepair, "MAX_STATES", 5)      # states are forgotten all the time
        monkeypatch.setattr(bytepair, "MAX_PAIRS", 3)
    ranks = random_ranks(seed)
    library = tiktoken.Encoding("any", pat_str=r"[a-c]+|[^a-c]+", mergeable_ranks=ranks, special_tokens={})
    run, pick = bytepair.Transducer(ranks), random.Random(seed + 100)
    for _ in range(400):
        text = "".join(pick.choice("abc") for _ in range(pick.randrange(1, 30)))
        assert run(text.encode()) == library.encode_ordinary(text), text


def test_ids_come_out_before_the_end(library):
    """Lookahead is bounded: whatever follows, ids are out once no longer token can be open."""
    run = bytepair.Transducer(dict(RANKS))
    state, out, longest = 0, 0, max(len(t) for t, _ in RANKS)
    piece = ("internationalization" * 20).encode()
    for i, byte in enumerate(piece):
        state, emitted = run._move(state, byte)
        out += sum(len(library.decode_single_token_bytes(t)) for t in emitted)
        assert i + 1 - out <= 2 * longest
    assert out > 0


def test_decoding_in_chunks(library):
    table, pick = bytepair.TokenBytes(dict(RANKS)), random.Random(3)
    for _ in range(1500):
        ids = np.array([pick.randrange(pick.choice([256, len(RANKS)])) for _ in range(pick.randrange(30))], dtype="<u4")
        stream, raw, text, at = bytepair.Utf8Stream(table), b"", "", 0
        while at < len(ids):
            step = pick.randrange(1, 5)
            a, b = stream.feed(ids[at:at + step])
            raw, text, at = raw + a, text + b, at + step
            assert text == text.encode().decode()
        text += stream.finish()
        want = b"".join(library.decode_single_token_bytes(int(i)) for i in ids)
        assert raw == want and text == want.decode("utf-8", "replace")
    with pytest.raises(ValueError):
        table(np.array([len(RANKS) + 5], dtype="<u4"))


def test_query(spark, docs, no_docs, library, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_byte_bpe(spark, str(tmp_path))
    want = []
    for row in docs.collect():
        text = row.text or ""
        ids = np.array(library.encode_ordinary(text), dtype="<u4")
        want.append((row.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert bytepair.round_trip(no_docs, RANKS, tokenizers.PATTERN).collect() == []


def test_other_columns_and_names(spark, library):
    rows = spark.createDataFrame([(1, "héllo wörld", 5, "x"), (2, None, 6, None)], "doc_id bigint, text string, ids int, n_tokens string")
    encoded = bytepair.encode(rows, RANKS, tokenizers.PATTERN, ids_col="code", count_col="len")
    assert encoded.columns == ["doc_id", "text", "ids", "n_tokens", "code", "len"]
    decoded = bytepair.decode(encoded, RANKS, ids_col="code").collect()
    assert [(r.text or "") for r in decoded] == [r.decoded_text for r in decoded] and decoded[0].ids == 5
    assert bytepair.encode(rows, RANKS, tokenizers.PATTERN).columns == ["doc_id", "text", "ids", "n_tokens"]
    bad = spark.createDataFrame([(bytearray(np.array([160, 161], dtype="<u4").tobytes()),)], "ids binary")
    row = bytepair.decode(bad, RANKS).first()
    raw = b"".join(library.decode_single_token_bytes(i) for i in (160, 161))
    assert bytes(row.decoded) == raw and row.decoded_text == raw.decode("utf-8", "replace")
