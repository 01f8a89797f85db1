"""Memory of the Arrow kernels of q28: bounded by slices of a batch, not by the batch."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from quarry.functions import text as T
from quarry.operators import bayes, tfidf


def kernel(monkeypatch, make):
    """The first function that ``make`` hands to ``mapInArrow``."""
    taken, real = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, run, schema, *more: taken.append(run) or real(df, run, schema, *more))
    make()
    monkeypatch.undo()
    return taken[0]


def peak_mb(run, batch):
    """Most that NumPy held while a kernel worked on a batch."""
    tracemalloc.start()
    rows = 0
    for made in run(iter([batch])):
        rows += made.num_rows
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak, rows


def test_list_slices_hold_whole_rows_up_to_a_bound():
    lists = [[1] * n for n in (0, 3, 4, 0, 9, 1, 2, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(lists)], names=["id", "x"]).slice(1)
    parts = list(T.list_slices(batch, "x", 4))
    assert [p.column(0).to_pylist() for p in parts] == [[1], [2, 3], [4], [5, 6, 7]]
    assert [x for p in parts for x in p.column(1).to_pylist()] == lists[1:]
    assert list(T.list_slices(batch.slice(0, 0), "x", 4)) == []


@pytest.mark.parametrize("counts", [None, "n"])
def test_memory_of_the_hashing_kernel_does_not_grow_with_the_batch(spark, monkeypatch, counts):
    df = spark.createDataFrame([(1, "a")], "id bigint, t string")
    run = kernel(monkeypatch, lambda: T.with_buckets(df, "t", ["id"], counts_col=counts))
    lists = pa.array([[f"w{i % 50}x{j}" for j in range(100)] for i in range(10000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(10000)), lists], names=["id", "_tokens"])
    peak, rows = peak_mb(run, batch)
    assert rows == 10000 and peak < 40


def test_memory_of_the_counting_kernel_does_not_grow_with_the_batch(spark, monkeypatch):
    import pyarrow as pa
    df = spark.createDataFrame([(1, [1])], "label int, buckets array<int>")
    count = kernel(monkeypatch, lambda: tfidf.bucket_counts(df, "buckets", "label"))
    lists = pa.array([[(i * j) % 5000 for j in range(100)] for i in range(10000)], pa.list_(pa.int32()))
    label = pa.array(np.arange(10000) % 3, pa.int32())
    peak, _ = peak_mb(count, pa.RecordBatch.from_arrays([lists, label], names=["lists", "label"]))
    assert peak < 20


def test_counts_added_in_steps_equal_those_of_one():

    rng, tally = np.random.default_rng(3), tfidf._Tally()
    want = np.zeros(300, np.int64)
    for n in (0, 5, 200, 40, 300):
        keys = np.sort(rng.choice(300, n, replace=False))
        counts = rng.integers(1, 9, n)
        want[keys] += counts
        tally.add(keys, counts)
        tally.settle()
    keys, counts = tally.taken()
    assert np.array_equal(keys, np.flatnonzero(want)) and np.array_equal(counts, want[keys])
    assert len(tally.taken()[0]) == 0


def test_memory_of_the_scoring_kernel_does_not_grow_with_the_batch():
    lists = pa.array([[(i * j) % 5000 for j in range(100)] for i in range(10000)], pa.list_(pa.int32()))
    label = pa.array(np.arange(10000) % 3, pa.int32())
    empty = pa.nulls(10000, pa.float64()), pa.nulls(10000, pa.int32())
    batch = pa.RecordBatch.from_arrays([label, lists, *empty], names=["label", "buckets", "_z", "_c"])
    peak, rows = peak_mb(bayes._best_class(SimpleNamespace(value=np.ones((3, 1 << 20))), [0, 1, 2], [0.0, 1.0, 0.0]), batch)
    assert rows == 10000 and peak < 6
