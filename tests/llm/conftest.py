import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) tuples, with columns that clash with the operators' own names."""

    def make(*rows):
        full = [(*r[:2], "en", r[2] if len(r) > 2 else "s", 0, "x", "y", "z") for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, hash string, shard string, fp string"
        return spark.createDataFrame(full, schema)

    return make
