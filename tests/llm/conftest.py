import pytest

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from texts (ids from 0) or from (doc_id, text) pairs."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS_SCHEMA
        )

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls in any column, empty, blank and repeated rows, a tie and a very long text, with
    extra columns whose names clash with those that operators add."""
    long_text = " ".join(f"word{i % 997} and{i % 13}" for i in range(60_000))
    docs = make_docs([
        (0, None), (1, ""), (2, "  \n\t "), (3, "one"), (4, "one two"), (5, long_text),
        (6, "same text here for both of them"), (7, "same text here for both of them"),
        (7, "same text here for both of them"), (None, "a row without an id"), (8, "zwölf Boxkämpfer 😀 jagen"),
    ])
    clashing = ("hash", "score", "rep", "component", "band", "n", "a", "b", "rn", "size", "piece", "label", "toxic")
    return docs.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in clashing])
