import pytest

from conftest_llm import ROWS


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows, and clashing extra columns."""
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if i != 9 else None, 1, 2.0, True, "x") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_words int, "
                                       "score double, kept boolean, part string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("1 = 0")
