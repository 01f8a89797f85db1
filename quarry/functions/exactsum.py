"""Sums of doubles that do not depend on the order of adding.

A finite double is a 53-bit integer times a power of two. Cut at fixed bit positions (every 32
bits of the whole range of exponents, ``BINS`` positions), it becomes three integers below 2^32, each in a
position of its own. Integers add exactly in any order, so a task adds its rows by position, Spark adds
the tasks' integers, and only in the end is the exact total rounded, once, to the
nearest double. The result is that of an infinitely precise sum, however the rows are partitioned.

A task sends at most ``BINS`` numbers for each key and column, whatever its number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 32                  # bits of a position
LOWEST = -1074              # exponent of the least bit of a double
BINS = 68                   # positions that the exponents of doubles reach, with room for three pieces
NAN, UP, DOWN = 100, 101, 102   # positions that count what is no number


def pieces(x):
    """(index, position, integer) of the pieces of the doubles ``x``; zeros give none."""
    import numpy as np

    finite = np.isfinite(x)
    fraction, exponent = np.frexp(np.where(finite, x, 0.0))
    mantissa = np.ldexp(fraction, 53).astype(np.int64)
    offset = np.maximum(exponent.astype(np.int64) - 53 - LOWEST, 0)
    short = exponent - 53 < LOWEST      # subnormal: the low bits are zeros
    mantissa = np.where(short, mantissa >> np.where(short, LOWEST - (exponent - 53), 0), mantissa)
    sign, size = np.sign(mantissa), np.abs(mantissa)
    position, shift = offset // WIDTH, offset % WIDTH
    mask = (1 << WIDTH) - 1
    low = (size & mask).astype(np.uint64) << shift.astype(np.uint64)
    high = (size >> WIDTH).astype(np.uint64) << shift.astype(np.uint64)     # below 2^53
    parts = [low & np.uint64(mask), (low >> np.uint64(WIDTH)) + (high & np.uint64(mask)), high >> np.uint64(WIDTH)]
    index = np.arange(len(x))
    found = [(index, position + i, part.astype(np.int64) * sign) for i, part in enumerate(parts)]
    special = np.select([np.isnan(x), x == np.inf, x == -np.inf], [NAN, UP, DOWN], 0)
    found.append((index, special, (special > 0).astype(np.int64)))
    index, position, value = (np.concatenate(side) for side in zip(*found))
    some = value != 0
    return index[some], position[some], value[some]


def add(totals: dict, key, x) -> None:
    """Add the doubles ``x`` (one array) to ``totals[key, position]``, as Python integers."""
    import numpy as np

    _, position, value = pieces(x)
    if not len(position):
        return
    order = np.argsort(position, kind="stable")
    position, value = position[order], value[order]
    edges = np.flatnonzero(np.append(True, position[1:] != position[:-1]))
    # below 2^33 each: 2^30 of them fit
    for p, s in zip(position[edges].tolist(), np.add.reduceat(value, edges).tolist()):
        totals[key, p] = totals.get((key, p), 0) + s


def total(parts) -> float:
    """The double nearest to the sum of (position, integer) pairs."""
    found: dict[int, int] = {}
    for position, s in parts:
        found[position] = found.get(position, 0) + int(s)
    if found.get(NAN) or (found.get(UP) and found.get(DOWN)):
        return float("nan")
    if found.get(UP) or found.get(DOWN):
        return float("inf") if found.get(UP) else float("-inf")
    whole = sum(s << (WIDTH * position) for position, s in found.items() if position < NAN)
    try:
        return whole / (1 << -LOWEST)       # division of integers rounds correctly
    except OverflowError:
        return float("inf") if whole > 0 else float("-inf")


def exact_sums(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """``keys`` (bounded in number: classes, clusters) and the exactly rounded sum of each of ``columns``.

    As in SQL, nulls are left out and a sum over none is null; without keys there is one row, also for no input."""
    keys, columns = list(keys), list(columns)
    own = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    key_fields = [f for f in own.schema.fields[:len(keys)]]
    sent = T.StructType([*key_fields, T.StructField("_column", T.IntegerType()), T.StructField("_position", T.IntegerType()),
                         T.StructField("_part", T.DecimalType(38, 0))])

    def run(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        totals: dict = {}
        for batch in batches:
            groups = {(): slice(None)}
            if keys and batch.num_rows:
                coded = [batch.column(i).dictionary_encode(null_encoding="encode") for i in range(len(keys))]
                codes = np.stack([c.indices.to_numpy(zero_copy_only=False) for c in coded])
                named, which = np.unique(codes, axis=1, return_inverse=True)
                groups = {tuple(c.dictionary[int(i)].as_py() for c, i in zip(coded, name)): which.ravel() == g for g, name in enumerate(named.T)}
            for c in range(len(columns)):
                array = batch.column(len(keys) + c)
                x, given = array.to_numpy(zero_copy_only=False), ~np.asarray(array.is_null())
                for name, rows in groups.items():
                    seen = given if isinstance(rows, slice) else given & rows
                    totals[((name, c), -1)] = totals.get(((name, c), -1), 0) + int(seen.sum())     # how many were summed
                    add(totals, (name, c), x[seen])
        found = [(*name, c, p, Decimal(s)) for ((name, c), p), s in totals.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(sent.names, row)) for row in found], schema=arrow_schema(sent))

    parts = own.mapInArrow(run, sent).groupBy(*keys, "_column", "_position").agg(F.sum("_part").alias("_part"))
    by_key = parts.groupBy(*keys).agg(F.collect_list(F.struct("_column", "_position", F.col("_part").cast("string").alias("_part"))).alias("_parts"))
    result = T.StructType([*key_fields, *[T.StructField(c, T.DoubleType()) for c in columns]])

    def finish(batches):        # at most (BINS + 4) * columns entries a key
        import pyarrow as pa

        for batch in batches:
            rows = []
            for entries in batch.column(len(keys)).to_pylist():
                sums = []
                for c in range(len(columns)):
                    mine = [(e["_position"], int(e["_part"])) for e in entries if e["_column"] == c]
                    n = sum(s for p, s in mine if p == -1)
                    sums.append(total([e for e in mine if e[0] >= 0]) if n else None)
                rows.append(sums)
            new = [pa.array([r[c] for r in rows], pa.float64()) for c in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], *new], names=result.names)

    return by_key.mapInArrow(finish, result)


def arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
