import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import text as T


def java_bucket(word: str, size: int = 1 << 20) -> int:
    """Java String.hashCode, then the non-negative remainder mod size."""
    h = 0
    for ch in word:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    if h >= 1 << 31:
        h -= 1 << 32
    return h % size


def test_stop_list_is_fixed():
    words = T.stop_words()
    assert len(words) == 319 and len(set(words)) == 319
    assert words[0] == "a" and words[-1] == "yourselves"
    assert all(w == w.lower() for w in words)


def test_tokens_and_cleaning(spark):
    rows = [("Great sound, isn't it",), ("the and of",), ("",), ("Ünïcode wörds 42x",)]
    out = spark.createDataFrame(rows, "t string").select(
        T.raw_tokens(F.col("t")).alias("raw"), T.clean_tokens(F.col("t")).alias("clean"),
        T.cleaned_text(F.col("t")).alias("text"), T.document_buckets(F.col("t")).alias("b")).collect()
    assert out[0].raw == ["great", "sound", "isn", "t", "it"]
    assert out[0].clean == ["great", "sound", "isn", "t"]
    assert out[0].text == " great sound isn t"
    assert out[0].b == [0] + [java_bucket(w) for w in ["great", "sound", "isn", "t"]]
    # only stop words: no tokens, but the document still has its bucket-0 entry
    assert out[1].clean == [] and out[1].text == "" and out[1].b == [0]
    assert out[2].b == [0]
    # non-ASCII letters split words, as the letter class is ASCII only
    assert out[3].raw == ["n", "code", "w", "rds", "x"]


def test_duplicates_are_kept(spark):
    out = spark.createDataFrame([("bad bad BAD good",)], "t string") \
        .select(T.clean_tokens(F.col("t")).alias("c")).first().c
    assert out == ["bad", "bad", "bad", "good"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_lowercase, min_size=1, max_size=30), min_size=1, max_size=20))
def test_bucket_matches_java_hash(spark, words):
    got = spark.createDataFrame([(w,) for w in words], "w string") \
        .select("w", T.bucket(F.col("w")).alias("b")).collect()
    assert [(r.w, r.b) for r in got] == [(w, java_bucket(w)) for w in words]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=200),
                          st.text(alphabet=string.ascii_letters + " ,.", min_size=0, max_size=3000)),
                min_size=1, max_size=30),
       st.sampled_from([1 << 20, 1 << 4]))
def test_arrow_buckets_equal_column_expression(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    fast = {r.id: r.buckets for r in T.with_buckets(df, "t", ["id"], num_features=size).collect()}
    slow = {r.id: r.b for r in df.select("id", T.document_buckets(F.col("t"), size).alias("b")).collect()}
    assert fast == slow


def test_arrow_buckets_long_word_and_chunks(spark, monkeypatch):
    words = ["a" * 5000, "zz", "b" * 70000, "word"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "")], "id long, t string")
    got = {r.id: r.buckets for r in T.with_buckets(df, "t", ["id"]).collect()}
    assert got[1] == [0] + [java_bucket(w) for w in words]
    assert got[2] == [0] and got[3] == [0]
