import pytest

from llm_cases import DOCS, NASTY, PLAIN


@pytest.fixture(scope="session")
def nasty(spark):
    """Documents with nulls in every column, an empty, a blank and a very long text, equal texts, a
    repeated row, and extra columns whose names clash with what the operators add."""
    rows = [(*r, "a", 1.0, 2, True, 3, 4, "z") for r in NASTY]
    return spark.createDataFrame(rows, DOCS + ", words string, score double, row long, label boolean, "
                                 "sequence_id long, start long, fp string").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def benchmark(spark):
    words = PLAIN.split()
    return spark.createDataFrame(
        [(10, " ".join(words[2:14]), 0), (11, "one", 0), (12, None, 0), (None, " ".join(words[:11]), 0), (13, "", 0),
         (14, " ".join(words[2:14]), 0), (14, " ".join(words[2:14]), 0)], "item_id long, text string, words int")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(9)] + [(None, 1, 1), (1, None, None), (1, 0, 1)],
                                 "doc_id long, quality int, toxic int")
