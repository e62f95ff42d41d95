import pytest


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame of documents from (doc_id, text) pairs, with extra clashing columns."""
    def build(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                     "doc_id long, text string, run string, marks int")
    return build


TINY = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, "  \n "), (None, "word " * 120), (4, "a"), (None, None)]
