"""Operators on texts against brute force, on rows with every awkward case."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ROWS, SHARED, blank_words, words

from quarry.llm import decontaminate, langid, mixing, neardup, recompression, suffix_index, suffix_tree, toxicity


def first_starts(rows, split, width):
    """Earliest (doc, start) of each window; a null id comes last."""
    first = {}
    for doc, text in rows:
        x = split(text)
        for i in range(len(x) - width + 1):
            key = tuple(x[i:i + width])
            at = (math.inf if doc is None else doc, i)
            first[key] = min(first.get(key, at), at)
    return first


def removed(doc, x, first, width):
    gone = [False] * len(x)
    for i in range(len(x) - width + 1):
        if first[tuple(x[i:i + width])] < (math.inf if doc is None else doc, i):
            gone[i:i + width] = [True] * width
    return gone


def counted(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("width", [20, 8, 3])
def test_recompression(docs, width):
    first = first_starts(ROWS, blank_words, width)
    want = []
    for doc, text in ROWS:
        x = blank_words(text)
        gone = removed(doc, x, first, width)
        kept = " ".join(w for w, g in zip(x, gone) if not g)
        want.append((doc, len(x), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert counted(recompression.remove(docs, width).collect()) == counted(want)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_suffix_index(docs, batches):
    split = lambda t: (t or "").encode()
    first = first_starts(ROWS, split, 100)
    want = []
    for doc, text in ROWS:
        x = split(text)
        gone = removed(doc, x, first, 100)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want.append((doc, len(x), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(x, gone) if not g)).hexdigest()))
    assert counted(suffix_index.remove(docs, batches=batches).collect()) == counted(want)


def test_rows_without_an_id_are_documents(spark):
    same, other = " ".join(words(60, 21)), [" ".join(words(30, 22 + i) + [f"z{i}"] + words(30, 40)) for i in range(2)]
    rows = [(None, same)] * 3 + [(None, x) for x in other] + [(7, "a b"), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string")
    want = sorted([0, 60, 60, 0, 30, 0, 0, 0])
    found = recompression.remove(docs).collect()
    assert sorted(r.n_removed for r in found) == want and sum(r.doc_id is None for r in found) == 7
    assert counted(found) == counted(recompression.remove(docs.repartition(5)).collect())
    kept = recompression.cut(docs)
    assert kept.columns == docs.columns and sorted(len((r.text or "").split()) for r in kept.collect()) == [0, 0, 2, 31, 60, 61]
    n = {x: len(x.encode()) for x in (same, *other)}
    for batches in (1, 3):
        by_bytes = suffix_index.remove(docs, batches=batches).collect()
        assert sorted(r.n_removed for r in by_bytes if r.n_bytes == n[same])[1:] == [n[same]] * 2
        assert sum(r.doc_id is None for r in by_bytes) == 7
        assert sum(r.n_removed > 0 for r in by_bytes) == 3


def test_levels_merge_geometrically(docs, monkeypatch):
    made = []
    add = suffix_index.Levels.add
    monkeypatch.setattr(suffix_index.Levels, "add", lambda self, level: (add(self, level), made.append([s for s, _ in self.levels])))
    suffix_index.remove(docs, batches=6).count()
    assert made == [[1], [2], [2, 1], [4], [4, 1]]


def test_near_duplicates(docs):
    def shingles(text):
        x = blank_words(text, lower=True)
        return frozenset([tuple(x)] if 0 < len(x) < 5 else [tuple(x[i:i + 5]) for i in range(len(x) - 4)])
    sets = [shingles(t) for _, t in ROWS]
    group = list(range(len(ROWS)))
    for _ in ROWS:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                same_id = ROWS[i][0] is not None and ROWS[i][0] == ROWS[j][0]
                if same_id or a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    want = []
    for i, (doc, _) in enumerate(ROWS):
        component = min((ROWS[j][0] for j in range(len(ROWS)) if group[j] == group[i] and ROWS[j][0] is not None), default=None)
        want.append((doc, len(sets[i]), component, doc == component))
    assert counted(neardup.near_duplicates(docs).collect()) == counted(want)


def test_near_duplicates_in_many_blocks(docs, monkeypatch):
    whole = counted(neardup.near_duplicates(docs).collect())
    monkeypatch.setattr(neardup, "LIST_BLOCK", 2)
    monkeypatch.setattr(neardup, "GROUP_BLOCK", 50)
    assert counted(neardup.near_duplicates(docs).collect()) == whole


def grown(sets, group):
    """Trees of rows by all pairs of a group."""
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if group[i] == group[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def flat_sets(sets):
    return (np.concatenate([np.sort(np.array(sorted(x), dtype=np.uint64)) for x in sets]),
            np.concatenate([[0], np.cumsum([len(x) for x in sets])]))


def partition(label):
    out = {}
    for i, x in enumerate(label):
        out.setdefault(int(x), []).append(i)
    return sorted(out.values())


@pytest.mark.parametrize("seed", range(60))
def test_sets_are_confirmed_as_by_all_pairs(seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(1, 1 << 62, 4 + seed % 9)
    sets = [set(rng.choice(pool, rng.integers(1, len(pool) + 1), replace=False).tolist()) for _ in range(2 + seed % 23)]
    group = np.sort(rng.integers(0, 3, len(sets)))
    label = neardup._confirmed(group, *flat_sets(sets), 75, 100)
    assert partition(label) == partition(grown(sets, group))


def test_a_shared_template_costs_no_pairs(monkeypatch):
    template = range(30)
    sets = [set(template) | {1000 + 20 * i + j for j in range(20)} for i in range(20000)]
    met = []
    monkeypatch.setattr(neardup._Postings, "of", lambda self, token: met.append(1) or self.rows[:0])
    assert len(set(neardup._confirmed(np.zeros(len(sets), int), *flat_sets(sets), 75, 100).tolist())) == len(sets)
    assert not met


def test_decontamination(spark, docs):
    items = [(1, SHARED), (2, "one two"), (2, "one two"), (3, None), (4, "..."), (None, "a a"), (10, " ".join(words(12, 4))), (5, "a a a")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    want = []
    for doc, text in ROWS:
        x, hit, found = split(text), set(), set()
        for item, body in items:
            y = split(body)
            size = min(10, len(y))
            for j in range(len(y) - size + 1 if y and item is not None else 0):
                for i in range(len(x) - size + 1):
                    if x[i:i + size] == y[j:j + size]:
                        hit.update(range(i, i + size))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((doc, len(x), len(hit), len(found), digest, bool(hit)))
    got = decontaminate.decontaminate(docs, benchmark).drop("items")
    assert counted(got.collect()) == counted(want)
    blocks = decontaminate.find_items(docs.select("doc_id", "text"), benchmark, block_words=5).selectExpr("doc_id", "n_words", "cast(size(hit_words) as bigint)")
    assert counted(blocks.collect()) == counted([w[:3] for w in want])
    assert not decontaminate.decontaminate(docs, benchmark.limit(0)).where("contaminated").count()


def test_mixing(docs):
    rows = [r.asDict() for r in mixing.mix_sources(docs).collect()]
    assert len(rows) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    assert None in by and math.isclose(sum(b[0]["target"] for b in by.values()), 1.5 * total)
    for some in by.values():
        assert some[0]["source_size"] == sum(r["size"] for r in some)
        assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 8 * (1 + len({r["shard"] for r in some}))
    assert counted(tuple(sorted(r.items(), key=str)) for r in rows) == counted(
        tuple(sorted(r.asDict().items(), key=str)) for r in mixing.mix_sources(docs).collect())


def test_apportionment(spark):
    """Highest quotients, seat by seat."""
    weights = [50.0, 30.5, 7.25, 7.25, 1.0, 0.0]
    for seats in (0, 1, 2, 7, 100, 1001):
        want = [0] * len(weights)
        for _ in range(seats):
            best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * want[i] + 1), -i))
            want[best] += 1
        df = spark.createDataFrame([(i, w, seats) for i, w in enumerate(weights)], "i int, w double, seats bigint")
        got = {r.i: r.quota for r in mixing.sainte_lague(df, "w", "seats", [], [df["i"]]).collect()}
        assert [got[i] for i in range(len(weights))] == want


def test_suffix_tree_base_and_sums(spark, docs):
    kept = [t for d, t in ROWS if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    count = Counter(w for t in kept for w in [*blank_words(t, True), None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for doc, text in ROWS:
        x = [*blank_words(text, True), None]
        want[(doc, len(x), sum(count[w] > 0 for w in x), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), 6))] += 1
    shape = lambda df: Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())
    train = suffix_tree.F.crc32(suffix_tree.F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    whole = suffix_tree.score(docs, train, min_count=1, gain=0.1)
    assert shape(whole) == want
    pieces = suffix_tree.score(docs, train, min_count=1, gain=0.1, model_bytes=20_000, head_words=5)  # several passes and a joined tail
    assert shape(pieces) == want
    scores = lambda df: sorted(round(r.score, 6) for r in df.collect())
    assert scores(pieces) == scores(whole)


def test_suffix_tree_distributions_sum_to_one(docs):
    import numpy as np

    tree, _ = suffix_tree.fit(docs.select("doc_id", "text"), min_count=2, gain=0.1)
    levels, _, _ = next(tree.pieces())
    assert any(length >= 3 for length in levels)
    for length, level in levels.items():
        for context in level.contexts[:40]:
            codes = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
            assert math.isclose((10 ** suffix_tree.log_probability(levels, codes, length)).sum(), 1, rel_tol=1e-9)


def test_suffix_tree_contexts_longer_than_a_first_round(spark):
    """States longer than the first round's contexts are kept, and pieces of the tree score alike."""
    import numpy as np

    rows = [(i, " ".join(f"{'ab'[(i + j * j) % 2]}{'n' * 12}{'yz'[(i + j * j) % 2]}" for j in range(40))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    tree, _ = suffix_tree.fit(df)
    assert max(next(tree.pieces())[0]) > suffix_tree.FIRST
    whole = suffix_tree.score(df).collect()
    right = np.mean([r.score for r in whole]) / 40
    assert right > -0.8
    pieces = suffix_tree.score(df, model_bytes=500).collect()
    assert sorted(round(r.score, 6) for r in pieces) == sorted(round(r.score, 6) for r in whole)


def test_languages(spark):
    text = {"en": "the cat and the dog with their house ", "de": "der hund und die katze mit ihrem haus ", "xx": "zqx vvk wqz "}
    rows = [(i, text[lang] * (1 + i % 4), lang) for i in range(60) for lang in [list(text)[i % 3]]]
    rows += [(100, None, "en"), (101, "", "de"), (102, "1234 ... !", "en"), (103, "the dog", None), (104, "DER HUND", None),
             (105, text["xx"] * 5000, None), (None, "the house", "de")]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    assert [got[i].lang_pred for i in (100, 101, 102, 103, 104, 105)] == ["und", "und", "und", "en", "de", "xx"]
    none = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in langid.identify(none).collect()] == ["und"]


def test_languages_are_learned_from_whole_texts(spark):
    """A shared header longer than any prefix, copies, letterless texts, and more than 16 labels."""
    header = " ".join(words(400, 6)) + " "
    tell = {f"l{k:02}": " ".join(f"{chr(97 + k)}{chr(97 + (k * 7 + j) % 26)}{chr(97 + j * 3 % 26)}" for j in range(12)) for k in range(20)}
    rows = [(i * 20 + k, header + text, lang) for k, (lang, text) in enumerate(tell.items()) for i in range(5)]
    rows += [(1000 + i, "... 123", "l00") for i in range(300)] + [(2000 + i, header, "l01") for i in range(300)]
    rows += [(5000 + k, text, None) for k, text in enumerate(tell.values())]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert [got[5000 + k] for k in range(20)] == list(tell)


def test_cross_parse_finds_longest_matches():
    import numpy as np

    sample, text = "abracadabra", "dabraxabrac"
    symbol = {c: i + 1 for i, c in enumerate("abrcdx")}
    table = langid.suffix_automaton(np.array([symbol[c] for c in sample], np.uint8), 7)
    want, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j + 1] in sample and text[i:j] in sample:
            j += 1
        want, i = want + 1, j
    grid = np.array([[symbol[c]] for c in text], np.uint8)
    assert langid.phrases(grid, np.array([len(text)]), table)[0] == want


def test_toxicity_finds_the_sentence(spark):
    rows, labels = [], []
    for i in range(300):
        body = [" ".join(words(9, i * 11 + s)) for s in range(6)]
        if i % 4 == 0:
            body[i % 6] += " vile scum"
        rows.append((i, ". ".join(body)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (None, "vile scum. good day"), (5, rows[5][1])]
    labels += [(7, 1, None), (None, 0, 1), (2000, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id % 4 == 0)
            if r.predicted:
                assert r.worst_sentence == r.doc_id % 6
        elif r.doc_id is not None:
            assert r.score == 0 and r.worst_sentence is None
    nothing = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.score < 1e-5 for r in toxicity.toxicity(docs, nothing).collect())


@pytest.mark.parametrize("run", [
    lambda d: neardup.near_duplicates(d), lambda d: recompression.remove(d), lambda d: recompression.cut(d), lambda d: suffix_index.remove(d),
    lambda d: suffix_tree.score_held_out(d), lambda d: langid.identify(d), lambda d: mixing.mix_sources(d)])
def test_empty_table(no_docs, run):
    assert run(no_docs).collect() == []


def test_empty_labels_and_items(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert toxicity.toxicity(no_docs, labels).collect() == [] == decontaminate.decontaminate(no_docs, items).collect()


def test_cut_keeps_columns(docs):
    got = recompression.cut(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == ROWS[0][1] and 2 not in texts and texts[6] is None and texts[7] == ""
    assert texts[11] == "a"  # all windows of a run but the first repeat it, and cover all but its first word
