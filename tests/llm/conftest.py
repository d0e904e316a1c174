import pytest
from odd_rows import TEXTS


@pytest.fixture
def odd_texts(spark):
    """The rows above with more columns, some named like the operators' own."""
    schema = "doc_id bigint, text string, score string, n_words string, cut string, label string"
    return spark.createDataFrame([(k, t, "s", "n", "c", "l") for k, t in TEXTS], schema)


@pytest.fixture
def no_texts(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from starloom.llm.shipping import ship

    ship(spark)
