import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents with the given texts, numbered from 1; a pair gives its own id."""

    def make(texts, **columns):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)

    return make


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
