"""What operators and the pipeline store goes with the scope around them."""

import glob
import os

import pytest

import corpus_pipeline
from quarry import session
from quarry.llm import queries

SF = "/root/testdata/sf0.001"
RUNS = {"pipeline": corpus_pipeline.run, **{n: q for n, q in queries.QUERIES.items() if n.split("_")[0] in ("op1", "op2", "op5", "op10", "op13")}}


def stored(spark):
    root = os.path.join(session.checkpoint_dir(spark).split("file:")[-1], session.ROOT)
    return [f for f in glob.glob(root + "/**", recursive=True) if os.path.isfile(f) and "/app-" not in f]


@pytest.mark.parametrize("name", sorted(RUNS))
def test_nothing_is_left(spark, name):
    with session.kept_tables(spark):
        assert RUNS[name](spark, SF).collect()
        assert stored(spark)
    assert stored(spark) == []
