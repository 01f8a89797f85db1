"""Report tables, their text form, and sinks.

Reports are DataFrames of ``(line_no, line)`` built with column expressions
(``concat`` with blanks up to a width; longer values print whole); the text sink writes them in line order.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import fixed
from .kmeans import CLUSTER

# Fixed values of the classification report layout (must match for identical text).
RULE = "======================================================="
THIN_RULE = "-------------------------------------------------------"
TITLE_SUMMARY = "Summary"
TITLE_MATRIX = "Confusion Matrix"
CAPTION_CORRECT = "Correctly Classified Instances"
CAPTION_INCORRECT = "Incorrectly Classified Instances"
CAPTION_TOTAL = "Total Classified Instances"
CAPTION_COLUMNS = "<--Classified as"
NAME_WIDTH, COUNT_WIDTH, CELL_WIDTH, TOTAL_WIDTH = 40, 10, 5, 6


def letter_code(i: Column) -> Column:
    """Code of class i: a, b, ..., z, ba, bb, ... (base 26 with letters as digits, T14)."""
    return F.translate(F.lower(F.conv(i.cast("string"), 10, 26)), "0123456789abcdefghijklmnop", "abcdefghijklmnopqrstuvwxyz")


def pad_left(x: Column, width: int) -> Column:
    """Blanks before a text up to ``width``; a longer text stays whole."""
    return F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(x))), x)


def pad_right(x: Column, width: int) -> Column:
    """Blanks after a text up to ``width``; a longer text stays whole."""
    return F.concat(x, F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(x))))


def decimal_text(x: Column) -> Column:
    """A value already rounded to 4 places, printed without trailing zeros."""
    s = F.regexp_replace(F.regexp_replace(x.cast("decimal(20,4)").cast("string"), "0+$", ""),
                         "\\.$", "")
    return F.coalesce(s, F.lit("NaN"))


def _lines(df: DataFrame, *numbered: tuple[int, Column]) -> list[DataFrame]:
    return [df.select(F.lit(n).alias("line_no"), line.alias("line")) for n, line in numbered]


def classification_report(summary: DataFrame, matrix: DataFrame, labels: list[str]) -> DataFrame:
    """The summary block and the letter-coded confusion matrix as text lines."""
    fixed = [(0, ""), (1, RULE), (2, TITLE_SUMMARY), (3, THIN_RULE), (7, ""), (8, RULE),
             (9, TITLE_MATRIX), (10, THIN_RULE)]
    spark = summary.sparkSession
    parts = [spark.createDataFrame(fixed, "line_no int, line string")]
    heads = [F.concat(pad_right(letter_code(F.lit(i)), CELL_WIDTH), F.lit("\t")) for i in range(len(labels))]
    parts += _lines(summary, (11, F.concat(*heads, F.lit(CAPTION_COLUMNS))))
    caption = lambda text: F.lit(text.ljust(NAME_WIDTH) + ": ")
    count = lambda c: pad_left(F.col(c).cast("string"), COUNT_WIDTH)
    pct = lambda c: pad_left(decimal_text(F.col(c)), COUNT_WIDTH)
    parts += _lines(
        summary,
        (4, F.concat(caption(CAPTION_CORRECT), count("correct"), F.lit("\t"), pct("pct_correct"), F.lit("%"))),
        (5, F.concat(caption(CAPTION_INCORRECT), count("incorrect"), F.lit("\t"), pct("pct_incorrect"),
                     F.lit("%"))),
        (6, F.concat(caption(CAPTION_TOTAL), count("total"))),
    )
    cells = [F.concat(pad_right(F.col(name).cast("string"), CELL_WIDTH), F.lit("\t")) for name in labels]
    row = F.concat(*cells, F.lit(" |  "), pad_right(F.col("total").cast("string"), TOTAL_WIDTH),
                   F.lit("\t"), pad_right(letter_code(F.col("label")), CELL_WIDTH), F.lit(" = "), F.col("label_name"))
    parts.append(matrix.select((F.col("label") * 2 + 12).alias("line_no"), row.alias("line")))
    parts.append(matrix.select((F.col("label") * 2 + 13).alias("line_no"), F.lit("").alias("line")))
    return reduce(DataFrame.unionByName, parts)


def cluster_lines(report: DataFrame, feature_cols: list[str], decimals: int | None = None) -> DataFrame:
    """``Cluster <id> [c1,c2,...] n=<size>`` per cluster, CRLF-terminated (T16). Centres as Spark
    prints doubles, or rounded to fixed ``decimals`` (before they are printed: engines print halves differently)."""
    shown = [F.col(f).cast("string") if decimals is None else F.format_string(f"%.{decimals}f", fixed(F.col(f), decimals)) for f in feature_cols]
    center = F.concat_ws(",", *shown)
    line = F.concat(F.lit("Cluster "), F.col(CLUSTER).cast("string"), F.lit(" ["), center,
                    F.lit("] n="), F.col("n").cast("string"), F.lit("\r"))
    return report.select(F.col(CLUSTER).alias("line_no"), line.alias("line"))


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    """Fail when a result is empty (A11; the original only printed a warning)."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")
    return df


def write_text(lines: DataFrame, path: str) -> None:
    """Put the report lines in order, as one text file, in the place of ``path`` (K3).

    They are written to a staging folder beside it first. Only a whole text is swapped in, by
    two renames; so a write that fails leaves the former text as it was and removes its staging folder, and
    a driver lost between the renames leaves the former text in ``<path>.former``, which the next write
    puts back first. Reports are a few dozen lines (bounded by the class or cluster count), so
    a single output partition is safe; errors propagate.
    """
    spark = lines.sparkSession
    target = path.rstrip("/")
    staging, former = f"{target}.staging-{uuid.uuid4().hex}", f"{target}.former"
    store, at = _place(spark, target)
    if not store.exists(at(target)) and store.exists(at(former)):
        _renamed(store, at, former, target)
    try:
        (lines.repartition(1).sortWithinPartitions("line_no").select("line").write.text(staging))
        store.delete(at(former), True)
        if store.exists(at(target)):
            _renamed(store, at, target, former)
        _renamed(store, at, staging, target)
        store.delete(at(former), True)
    except BaseException:
        store.delete(at(staging), True)
        if not store.exists(at(target)) and store.exists(at(former)):
            _renamed(store, at, former, target)
        raise


def _place(spark, path: str):
    """The path's file system, and a function that makes its paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def _renamed(store, at, old: str, new: str) -> None:
    if not store.rename(at(old), at(new)):
        raise OSError(f"cannot rename {old} to {new}")


def drop_views(spark, *names: str) -> None:
    """Drop temporary views if present (K6)."""
    for name in names:
        spark.catalog.dropTempView(name)
