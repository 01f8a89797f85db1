"""Typed readers for the three delimited text shapes.

Each reader takes a one-column DataFrame of lines (``value``, as produced by
``spark.read.text`` on a file or a directory of part files). Parsing is column expressions only
(``split``, ``get``, ``try_cast``), so it runs inside whole-stage codegen
and partitions like the scan; a bad line never fails the job (but for ``strict`` vectors). Three ways to use a parse:

* ``parse_*`` returns ``(good, rejected)`` DataFrames, each a scan of its own when it is read;
* ``observe_*`` returns ``Parsed``: the good rows, whose one job also counts the lines and the rejected ones;
* ``located_rejects`` finds the rejected lines again: file, line number, text, and whether it is a header.

Java's ``String.split`` drops trailing empty fields, Spark's ``split`` keeps
them: the readers strip trailing delimiters first, so field counts agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

VALUE = "value"
COMMA_FIELDS = ("c_customer_sk", "college_education", "male", "label")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file or of every file in a directory.

    Split sizes follow ``spark.sql.files.maxPartitionBytes``; no header is
    expected (a header line simply fails to parse and lands in ``rejected``).
    """
    return spark.read.text(path)


# The only spellings of NaN / infinity that Java's Double.valueOf
# accepts (after trimming). Spark's cast also accepts case-insensitive
# nan / inf / infinity, which Java rejects.
JAVA_SPECIALS = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity")
SPARK_ONLY_SPECIAL = "^[+-]?(nan|inf|infinity)$"


def _num(field: Column) -> Column:
    """String -> double with Java's Double.valueOf rules; NULL where it would throw."""
    text = F.trim(field)
    spark_only = F.lower(text).rlike(SPARK_ONLY_SPECIAL) & ~text.isin(*JAVA_SPECIALS)
    return F.when(spark_only, F.lit(None).cast("double")).otherwise(field.try_cast("double"))


@dataclass
class Parsed:
    """Good rows, and counts that come from the job which reads them."""

    good: DataFrame
    seen: Observation

    @property
    def n_lines(self) -> int:
        """Lines read. Waits for the first job on ``good``: run one (write or collect all of it) before."""
        return self.seen.get["n_lines"]

    @property
    def n_rejected(self) -> int:
        """Lines that are not in ``good``; from the same job."""
        return self.seen.get["n_rejected"]


def _observed(flagged: DataFrame, columns: list[str]) -> Parsed:
    """The rows marked ``_ok``, with both counts taken as they pass."""
    seen = Observation()
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("_ok")).alias("n_rejected"))
    return Parsed(counted.where("_ok").select(*columns), seen)


def _split_up(flagged: DataFrame, columns: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    return flagged.where("_ok").select(*columns), flagged.where(~F.col("_ok")).select(value)


def parse_comma(lines: DataFrame, value: str = VALUE) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of comma records, see ``flag_comma``."""
    return _split_up(flag_comma(lines, value), list(COMMA_FIELDS), value)


def observe_comma(lines: DataFrame, value: str = VALUE) -> Parsed:
    return _observed(flag_comma(lines, value), list(COMMA_FIELDS))


def flag_comma(lines: DataFrame, value: str = VALUE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, f1, f2, label`` records.

    Fields 1-3 must parse as doubles (surrounding blanks allowed); fields past
    the fourth are ignored; field 0 is kept as the string ``c_customer_sk``.
    A row with a missing or non-numeric field 1-3 is rejected (the original
    dropped the unparsable ones and failed on short rows).
    """
    f = F.split(F.col(value), ",")
    parsed = lines.select(
        F.get(f, 0).alias("c_customer_sk"),
        _num(F.get(f, 1)).alias("college_education"),
        _num(F.get(f, 2)).alias("male"),
        _num(F.get(f, 3)).alias("label"),
        F.col(value), *keep,
    )
    return parsed.withColumn("_ok", F.col("college_education").isNotNull() & F.col("male").isNotNull()
                             & F.col("label").isNotNull())


def parse_space(lines: DataFrame, value: str = VALUE, mode: str = "strict",
                width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of vectors, see ``flag_space``."""
    good, rejected = _split_up(flag_space(lines, value, mode, width), ["features"], value)
    return good, (rejected if mode == "drop" else lines.limit(0).select(value))


def observe_space(lines: DataFrame, value: str = VALUE, mode: str = "strict", width: int | None = None) -> Parsed:
    return _observed(flag_space(lines, value, mode, width), ["features"])


def flag_space(lines: DataFrame, value: str = VALUE, mode: str = "strict", width: int | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """All-numeric, single-blank-separated vectors (S4, T2) -> ``features array<double>``.

    ``mode="strict"`` fails the job on the first bad token (an empty token
    from two blanks, a word) as the original does, and on rows whose width
    differs from ``width``; ``mode="drop"`` moves such rows to ``rejected``.
    Trailing blanks are ignored.
    """
    if mode not in ("strict", "drop"):
        raise ValueError("mode must be 'strict' or 'drop'")
    tokens = F.split(F.regexp_replace(F.col(value), " +$", ""), " ")
    values = F.transform(tokens, _num)
    parsed = lines.select(F.col(value), values.alias("features"), *keep)
    bad_token = F.exists("features", lambda x: x.isNull())
    if mode == "strict":
        parsed = parsed.withColumn("features", F.when(
            bad_token, F.raise_error(F.concat(F.lit("unparsable vector line: "), F.col(value))))
            .otherwise(F.col("features")))
        if width is not None:
            parsed = parsed.withColumn("features", F.when(
                F.size("features") != width,
                F.raise_error(F.concat(F.lit("vector width differs: "), F.col(value))))
                .otherwise(F.col("features")))
        return parsed.withColumn("_ok", F.col("features").isNotNull())
    ok = ~bad_token if width is None else (~bad_token & (F.size("features") == width))
    return parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))


def vector_columns(parsed: DataFrame, width: int, prefix: str = "x") -> DataFrame:
    """``features array<double>`` -> ``x0 .. x{width-1}`` double columns."""
    return parsed.select(*[F.col("features")[i].alias(f"{prefix}{i}") for i in range(width)])


TAB_COLUMNS = ["review_id", "label", "label_index", "text"]


def parse_tab(lines: DataFrame, labels: list[str], value: str = VALUE) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of documents, see ``flag_tab``."""
    return _split_up(flag_tab(lines, labels, value), TAB_COLUMNS, value)


def observe_tab(lines: DataFrame, labels: list[str], value: str = VALUE) -> Parsed:
    return _observed(flag_tab(lines, labels, value), TAB_COLUMNS)


def flag_tab(lines: DataFrame, labels: list[str], value: str = VALUE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id <tab> label <tab> text`` records.

    Kept: exactly three fields after trailing tabs are stripped, a non-empty
    text, and a label found in ``labels`` (matched exactly, case-sensitive);
    ``label_index`` is its position. Everything else is rejected (the
    original turned an unknown label into -1 and failed later).
    """
    f = F.split(F.regexp_replace(F.col(value), "\t+$", ""), "\t")
    index = (F.array_position(F.array(*[F.lit(x) for x in labels]), F.get(f, 1)) - 1).cast("int")
    parsed = lines.select(
        F.get(f, 0).alias("review_id"), F.get(f, 1).alias("label"), index.alias("label_index"),
        F.get(f, 2).alias("text"), F.size(f).alias("_n"), F.col(value), *keep)
    ok = (F.col("_n") == 3) & (F.col("text") != "") & (F.col("label_index") >= 0)
    return parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))


def read_comma(spark: SparkSession, path: str):
    return parse_comma(read_lines(spark, path))


def read_observed(spark: SparkSession, path: str, observe, **options) -> Parsed:
    """``observe_comma``, ``observe_space`` or ``observe_tab`` of a file or folder."""
    return observe(read_lines(spark, path), **options)


def read_space(spark: SparkSession, path: str, mode: str = "strict", width: int | None = None):
    return parse_space(read_lines(spark, path), mode=mode, width=width)


def read_tab(spark: SparkSession, path: str, labels: list[str]):
    return parse_tab(read_lines(spark, path), labels)


def located_rejects(spark: SparkSession, path: str, flag) -> DataFrame:
    """``file, line_no, line, is_header`` of the rejected lines of a file or folder.

    ``flag`` is ``flag_comma``, or another flagging parse with its arguments bound (``functools.partial``). ``line_no`` counts from 1
    in each file, however Spark splits it: lines are numbered within a split as it is read, and the splits before it
    in the file are added from one row a split. Only rejected lines are joined with these. A
    header is the first line of a file if it holds the comma record's field names."""
    place = F.monotonically_increasing_id()     # goes up by one within a split
    lines = read_lines(spark, path).select(VALUE, F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("start"), place.alias("place"))
    splits = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)    # the splits of one file
    splits = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    wrong = flag(lines, keep=("file", "start", "place")).where(~F.col("_ok")).select("file", "start", "place", VALUE)
    line_no = (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_no")
    header = (line_no == 1) & (F.col(VALUE) == ",".join(COMMA_FIELDS))
    return wrong.join(splits, ["file", "start"]).select("file", line_no, F.col(VALUE).alias("line"), header.alias("is_header"))


def write_comma(df: DataFrame, path: str, cols=COMMA_FIELDS) -> None:
    """Write records in the comma shape (the extraction's output contract)."""
    df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).alias(VALUE)) \
        .write.mode("overwrite").text(path)


def write_space(df: DataFrame, path: str, cols) -> None:
    """Write vectors in the space shape: one line of doubles per row."""
    df.select(F.concat_ws(" ", *[F.col(c).cast("double").cast("string") for c in cols]).alias(VALUE)) \
        .write.mode("overwrite").text(path)


def write_tab(df: DataFrame, path: str, id_col="doc_id", label_col="label", text_col="text") -> None:
    """Write documents in the tab shape; tabs and line breaks in the text become blanks."""
    text = F.regexp_replace(F.col(text_col), "[\t\r\n]+", " ")
    df.select(F.concat_ws("\t", F.col(id_col).cast("string"), F.col(label_col), text).alias(VALUE)) \
        .write.mode("overwrite").text(path)
