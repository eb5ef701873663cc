import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text[, lang, source]) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", *([extra] if extra else []))

    return make
