"""Leaving rows out where they are read, before a join moves them.

A Bloom filter over the join keys of the small side is built with two aggregations and
tested in the scan of the large side, as a column expression: no Python, no shuffle of the large side.
Each key sets ``BITS`` bits of one 64-bit word (a blocked filter), so a row is tested with one look-up. The
filter is an array that a scalar subquery ships with the plan.

Its size is set by a documented bound, ``quarry.prune.maxFilterBytes`` (1 MiB unless set), never by the data: with
more keys than ``BITS_PER_KEY`` allows, the filter would let too much pass and is left out. The rows of
the join are the same with or without it; only false positives differ, and the join itself removes them.
Below ``quarry.prune.minBytes`` of the large side (64 MiB by Spark's own estimate, unless set) the two small jobs would
cost more than they save, and the rows stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FILTER_BYTES = 1 << 20
DEFAULT_MIN_BYTES = 64 << 20
BITS = 4            # set by a key, in one word
BITS_PER_KEY = 8    # at least; about 3 % of other keys pass then
PLACES = 63         # the places of a word


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words)).cast("int")


def _bits(key: Column) -> Column:
    """A word with up to ``BITS`` bits, from six bits each of one hash."""
    hashed, out = F.xxhash64(key, F.lit(2)), None
    for i in range(BITS):
        place = F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(PLACES)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def filter_words(n_keys: int, max_bytes: int) -> int:
    """Number of words (a power of two), 0 if ``n_keys`` are too many for ``max_bytes``."""
    if n_keys * BITS_PER_KEY > 8 * max_bytes:
        return 0
    wanted = 1 << max(6, (n_keys * 2 * BITS_PER_KEY // 64).bit_length())
    return min(wanted, 1 << (max_bytes // 8).bit_length() - 1)


def bloom_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row, ``filter``: an array of ``words`` 64-bit words. At most ``words`` rows reach the last task."""
    own = keys.where(F.col(key).isNotNull()).select(_word(F.col(key), words).alias("at"), _bits(F.col(key)).alias("bits"))
    empty = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("bigint").alias("bits"))
    by_word = own.unionByName(empty).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return by_word.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("filter"))


def keep_possible(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``keys``, and without null keys. An inner or
    semi join with ``keys`` gives the same rows as before. Counting ``keys`` is a job (of a Parquet footer each, for a table)."""
    spark = rows.sparkSession
    if rows.schema[key].dataType != keys.schema[key].dataType:
        return rows     # equal values of different types hash apart
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < int(spark.conf.get("quarry.prune.minBytes", str(DEFAULT_MIN_BYTES))):
        return rows
    limit = int(spark.conf.get("quarry.prune.maxFilterBytes", str(DEFAULT_FILTER_BYTES)))
    words = filter_words(keys.count(), limit)
    if not words:
        return rows
    word = F.get(bloom_filter(keys, key, words).scalar(), _word(F.col(key), words))
    return rows.where(word.bitwiseAND(_bits(F.col(key))) == _bits(F.col(key)))
