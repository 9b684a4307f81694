import pytest
from edge_rows import ROWS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, row string, score string, spans string, copies int, copy int, order_key string, group_size int, keep_id string, keep_rows int, kept boolean, piece_ids string, component_id string"


def documents(spark, rows):
    """(doc_id, text) rows with the other columns of documents, and extra ones whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s1" if (i or 0) % 3 else None, len(t or ""), "k", 1, "r", "x", "y", 777, 5, "o", 888, "i", 9, True, "p", "c") for i, t in rows], SCHEMA)


@pytest.fixture
def docs_of(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture
def edge(docs_of):
    return docs_of(ROWS)


@pytest.fixture
def nothing(docs_of):
    return docs_of([])
