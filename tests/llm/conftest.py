import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with the other columns and clashing extra ones."""

    def make(rows, source="s"):
        full = [(i, t, "en", source if not isinstance(source, dict) else source.get(i), None if t is None else len(t), "x", 7, True) for i, t in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, key int, kept boolean"
        return spark.createDataFrame(full, schema)

    return make
