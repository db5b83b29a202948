import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, sig string, row string, _n int, value string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text[, lang[, source]]) rows, with further columns whose names clash."""

    def build(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *("en", "web")[len(r) - 2 :])[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, len(text or ""), "s", "r", 1, "v"))
        return spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a frame as plain tuples, sorted with nulls first."""

    def collect(df, *columns):
        rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])

    return collect
