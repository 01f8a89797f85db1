"""Results that depend on a document and the model alone, and targets met to the word."""

import math
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import langid, mixing, toxicity

from conftest_llm import blank_words, words

TEXTS = ["abc.", "und the", " the", "...the dog", "der hund ", "1 2 3", "Ärger über", "x" * 700 + " the", "the " * 300, "", None, "\n\nund", "a.", " ", "Éa É"]
LEARNED = [("en", "the cat and the dog with their house"), ("de", "der hund und die katze mit ihrem haus über Ärger"), ("fr", "le chat et le chien dans la maison été")]


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(i, f"{t} {'abcdefgh'[i % 8]} " * (1 + i % 3), lang) for i in range(30) for lang, t in [LEARNED[i % 3]]]
    return langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True)), rows


def test_a_text_alone_and_in_any_batch(spark, languages):
    model, _ = languages
    alone = {}
    for i, t in enumerate(TEXTS):
        row = langid.predict(spark.createDataFrame([(i, t)], "doc_id bigint, text string"), model).first()
        alone[i] = (row.lang_pred, row.score)
    for order in (list(range(len(TEXTS))), list(range(len(TEXTS)))[::-1], [1, 0, 1, 3, 2, 0, 1, 9, 11, 12, 1]):
        together = spark.createDataFrame([(i, TEXTS[i]) for i in order], "doc_id bigint, text string").coalesce(1)
        assert [(r.lang_pred, r.score) for r in langid.predict(together, model).collect()] == [alone[i] for i in order]


def letters(text):
    """Lower-cased letters as bytes, one space for what lies between."""
    lower = text.translate({c: c + 32 for c in [*range(65, 91), *range(0xC0, 0xDF)]}).encode()
    return re.sub(rb"[^a-z\x80-\xff]+", b" ", lower)


def test_predictions_equal_brute_force(spark, languages):
    """Greedy longest phrases by searching the samples, in pieces of 256 bytes."""
    model, rows = languages
    samples = {}
    for lang, _ in LEARNED:
        texts = sorted({t: i for i, t, own in reversed(rows) if own == lang}.items(), key=lambda x: x[1])
        samples[lang] = letters(" ".join(t for t, _ in texts))
    tested = [t for t in TEXTS if t]
    got = langid.predict(spark.createDataFrame(list(enumerate(tested)), "doc_id bigint, text string"), model).collect()
    for row in got:
        symbols, costs = letters(tested[row.doc_id]), {}
        for lang, sample in samples.items():
            n = 0
            for at in range(0, len(symbols), langid.PIECE):
                piece, i = symbols[at:at + langid.PIECE], 0
                while i < len(piece):
                    j = i + 1
                    while j < len(piece) and piece[i:j + 1] in sample:
                        j += 1
                    n, i = n + 1, j
            costs[lang] = n * math.log2(len(sample) + 1)
        if not re.search(r"[^\W\d_]", tested[row.doc_id]):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        best = min(sorted(costs), key=costs.get)
        score = 1 / sum(2 ** (-(c - costs[best]) / 4) for c in costs.values())
        assert row.lang_pred == best and abs(row.score - score) < 1e-9, tested[row.doc_id][:40]


def test_a_long_clean_text_is_not_toxic(spark):
    rows, labels = [], []
    for i in range(200):
        body = [" ".join(words(9, i * 11 + s)) for s in range(6)]
        if i % 4 == 0:
            body[i % 6] += " vile scum"
        rows.append((i, ". ".join(body)))
        labels.append((i, int(i % 4 == 0)))
    clean = ". ".join(" ".join(words(9, 5000 + s)) for s in range(20_000))
    rows += [(1000, clean), (1001, clean + ". vile scum here")]
    found = {r.doc_id: r for r in toxicity.toxicity(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                                    spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert found[1000].score < 0.1 and found[1000].predicted == 0
    assert found[1001].predicted == 1 and found[1001].worst_sentence == 20_000


@pytest.mark.parametrize("sources", [
    {"a": [3]}, {"a": [3, 3, 3, 3]}, {f"s{i:02}": [20] for i in range(40)}, {"a": [1] * 30, "b": [500], "c": [7, 0, 9]}, {"a": [0, 0], "b": [5]},
    {f"s{i:02}": [1 + i % 4] * (1 + i % 7) for i in range(25)}])
def test_every_source_takes_its_target(spark, sources):
    rows, n = [], 0
    for source, sizes in sources.items():
        for size in sizes:
            rows.append((n, " ".join(words(size, n)), source))
            n += 1
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    size = {i: len(blank_words(t)) for i, t, _ in rows}
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * size[r.doc_id] for r in got)
    for source in sources:
        mine = [r for r in got if r.source == source]
        assert sum(r.taken for r in mine) == math.floor((mine[0].target or 0) + 0.5)
        assert {r.shard: r.words for r in mine} == {s: sum(r.taken for r in mine if r.shard == s) for s in {r.shard for r in mine}}
