import pytest

DOCS = "doc_id long, text string, source string, n_chars long, digest string, n long, node long, size long, u double, __drop string"


@pytest.fixture
def make(spark):
    """Rows (doc_id, text[, source]) as documents with extra columns whose names operators use inside."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, 2, 3, 0.5, "y") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build
