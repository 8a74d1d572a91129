import pytest

DOCS = "doc_id long, text string, id string, fp long, n int, score string, rid string, bin int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns whose names clash
    with the operators' own, over several partitions."""
    def make(rows, parts=3):
        full = [(i, t, "x", 1, 2, "s", "r", 3) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
