import pytest
from pyspark.errors import PySparkException

from quarry.sources import readers


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_comma_edge_rows(spark):
    good, rejected = readers.parse_comma(lines(
        spark, "1,0,1,1", '"c_customer_sk","college_education","male","label"', "2,,1,0", "2,\\N,1,0",
        "3, 1 ,0,1", "4,1,0", "4,1,0,", "5,1,0,1,9"))
    kept = sorted((r.c_customer_sk, r.college_education, r.male, r.label) for r in good.collect())
    assert kept == [("1", 0.0, 1.0, 1.0), ("3", 1.0, 0.0, 1.0), ("5", 1.0, 0.0, 1.0)]
    assert rejected.count() == 5


def test_space_strict_and_drop(spark):
    good, _ = readers.parse_space(lines(spark, "1.0 2.5 3e2", "1.0 2.0 "), mode="drop")
    assert [r.features for r in good.collect()] == [[1.0, 2.5, 300.0], [1.0, 2.0]]
    for bad in ("1.0  2.0", "1.0 x", "1.0 nan"):
        strict, _ = readers.parse_space(lines(spark, bad), mode="strict")
        with pytest.raises(PySparkException):
            strict.collect()
        dropped, rejected = readers.parse_space(lines(spark, bad, "3.0 4.0"), mode="drop")
        assert dropped.count() == 1 and rejected.count() == 1
    ragged, _ = readers.parse_space(lines(spark, "1 2", "1 2 3"), mode="strict", width=2)
    with pytest.raises(PySparkException):
        ragged.collect()
    kept, rejected = readers.parse_space(lines(spark, "1 2", "1 2 3"), mode="drop", width=2)
    assert kept.count() == 1 and rejected.count() == 1


def test_tab_edge_rows(spark):
    good, rejected = readers.parse_tab(lines(
        spark, "7\tPOS\tGreat sound, isn't it", "8\tNEG\t", "9\tNEG\tbad\t", "9\tNEG\tbad\tx",
        "10\tpos\tfine", "11\tNEU\tthe and of"), ["NEG", "NEU", "POS"])
    kept = sorted((r.review_id, r.label_index, r.text) for r in good.collect())
    assert kept == [("11", 1, "the and of"), ("7", 2, "Great sound, isn't it"), ("9", 0, "bad")]
    assert rejected.count() == 3


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "POS", "a\tb\nc"), (2, "NEG", "d")], "doc_id long, label string, text string")
    path = str(tmp_path / "tab")
    readers.write_tab(df, path)
    good, rejected = readers.read_tab(spark, path, ["NEG", "NEU", "POS"])
    assert sorted((r.review_id, r.text) for r in good.collect()) == [("1", "a b c"), ("2", "d")]
    assert rejected.count() == 0


def test_number_forms_follow_java_double_parsing(spark):
    """Forms Java's Double.valueOf accepts are kept; quoted, \\N and the
    lower-case nan/inf spellings (which only Spark's cast would take) are rejected."""
    accepted = {"1d": 1.0, "1f": 1.0, "0x1p3": 8.0, " 2 ": 2.0, "1e3": 1000.0, "+5": 5.0,
                "Infinity": float("inf")}
    rows = [f"{i},{v},0,1" for i, v in enumerate(accepted)] + ['90,"1",0,1', "91,\\N,0,1", "92,NaN,0,1",
                                                              "93,nan,0,1", "94,inf,0,1", "95,-Infinity,0,1"]
    good, rejected = readers.parse_comma(lines(spark, *rows))
    got = {r.c_customer_sk: r.college_education for r in good.collect()}
    for i, v in enumerate(accepted.values()):
        assert got[str(i)] == v
    assert got["92"] != got["92"]          # NaN kept, as in Java
    assert got["95"] == float("-inf")
    assert rejected.count() == 4
