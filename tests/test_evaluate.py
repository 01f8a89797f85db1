import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate, report


def test_confusion_and_summary(spark):
    pairs = [(0, 0), (0, 2), (1, 1), (2, 2), (2, 2), (2, 0)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    m = {r.label: (r.NEG, r.NEU, r.POS, r.total)
         for r in evaluate.confusion_matrix(df, ["NEG", "NEU", "POS"]).collect()}
    assert m == {0: (1, 0, 1, 2), 1: (0, 1, 0, 1), 2: (1, 0, 2, 3)}
    s = evaluate.summary(df).first()
    assert (s.correct, s.incorrect, s.total) == (4, 2, 6)
    assert s.pct_correct == 66.6667 and s.pct_incorrect == 33.3333


def test_confusion_matches_multiclass_metrics(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics

    pairs = [(float(i % 3), float((i * 7) % 3)) for i in range(50)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    ref = MulticlassMetrics(df.select("prediction", "label").rdd.map(tuple)).confusionMatrix().toArray()
    got = {(r.actual, r.predicted): r.n for r in evaluate.confusion_long(df, classes=(0, 1, 2)).collect()}
    for a in range(3):
        for p in range(3):
            assert got.get((a, p), 0) == ref[a][p]
    acc = evaluate.accuracy(df).first().accuracy
    assert acc == pytest.approx(sum(ref[i][i] for i in range(3)) / 50)


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    s = evaluate.summary(df).first()
    assert s.total == 0 and s.pct_correct is None


def test_auc_matches_binary_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = [(float(i % 2 == 0 or i % 7 == 0), round((i * 37 % 101) / 101.0, 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "label double, probability double")
    ours = evaluate.auc(df, "probability", digits=12).first().auc
    ref = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label",
                                        metricName="areaUnderROC").evaluate(df)
    assert ours == pytest.approx(ref, abs=1e-9)
    # ties share one score value: a third of all rows on a single score
    skewed = df.withColumn("probability", F.when(F.col("probability") < 0.34, 0.5)
                           .otherwise(F.col("probability")))
    ours = evaluate.auc(skewed, "probability", digits=12).first().auc
    ref = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label").evaluate(skewed)
    assert ours == pytest.approx(ref, abs=1e-9)


def _java_report(correct, total, matrix, labels):
    """Expected text, following the original layout rules."""
    from decimal import ROUND_HALF_EVEN, Decimal

    def fmt(x):
        d = Decimal(repr(x)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_EVEN)
        s = format(d, "f").rstrip("0").rstrip(".")
        return s

    inc = total - correct
    out = ["", "=" * 55, "Summary", "-" * 55,
           "Correctly Classified Instances".ljust(40) + ": " + str(correct).rjust(10) + "\t"
           + fmt(100.0 * correct / total).rjust(10) + "%",
           "Incorrectly Classified Instances".ljust(40) + ": " + str(inc).rjust(10) + "\t"
           + fmt(100.0 * inc / total).rjust(10) + "%",
           "Total Classified Instances".ljust(40) + ": " + str(total).rjust(10), "",
           "=" * 55, "Confusion Matrix", "-" * 55,
           "".join("abcdef"[i].ljust(5) + "\t" for i in range(len(labels))) + "<--Classified as"]
    for i, name in enumerate(labels):
        out.append("".join(str(n).ljust(5) + "\t" for n in matrix[i]) + " |  " + str(sum(matrix[i])).ljust(6)
                   + "\t" + "abcdef"[i].ljust(5) + " = " + name)
        out.append("")
    return out


def test_report_text(spark):
    labels = ["NEG", "NEU", "POS"]
    pairs = [(0, 0), (0, 2), (1, 1), (2, 2), (2, 2), (2, 0), (2, 2)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    lines = report.classification_report(evaluate.summary(df), evaluate.confusion_matrix(df, labels), labels)
    got = [r.line for r in lines.orderBy("line_no").collect()]
    assert got == _java_report(5, 7, [[1, 0, 1], [0, 1, 0], [1, 0, 3]], labels)


def test_letter_codes(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 25, 26, 27, 701)], "i int")
    assert [r[0] for r in df.orderBy("i").select(report.letter_code(F.col("i"))).collect()] == ["a", "b", "z", "ba", "bb", "baz"]


def test_report_never_cuts_counts(spark):
    labels = ["NEG", "POS"]
    summary = spark.createDataFrame([(12345678901, 1234569, 12346913470, 99.99, 0.01)],
                                    "correct bigint, incorrect bigint, total bigint, pct_correct double, pct_incorrect double")
    matrix = spark.createDataFrame([(0, "NEG", 1234567, 3, 1234570), (1, "POS", 0, 12, 12)],
                                   "label int, label_name string, NEG bigint, POS bigint, total bigint")
    text = [r.line for r in report.classification_report(summary, matrix, labels).orderBy("line_no").collect()]
    assert text[4].split(": ")[1].startswith("12345678901\t") and text[6].endswith(": 12346913470")
    assert text[12] == "1234567\t3    \t |  1234570\ta     = NEG" and text[14] == "0    \t12   \t |  12    \tb     = POS"


def test_text_sink(spark, tmp_path):
    labels = ["NEG", "POS"]
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "label int, prediction int")
    lines = report.classification_report(evaluate.summary(df), evaluate.confusion_matrix(df, labels), labels)
    path = str(tmp_path / "result")
    report.write_text(lines, path)
    back = [r.value for r in spark.read.text(path).collect()]
    assert back == [r.line for r in lines.orderBy("line_no").collect()]
    with pytest.raises(RuntimeError):
        report.require_rows(df.limit(0))


def test_drop_views(spark):
    spark.range(3).createOrReplaceTempView("quarry_tmp_view")
    report.drop_views(spark, "quarry_tmp_view", "quarry_absent_view")
    assert "quarry_tmp_view" not in [t.name for t in spark.catalog.listTables()]


def test_auc_without_negatives_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.7)], "label double, probability double")
    assert evaluate.auc(df).first().auc is None
