import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make
