import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (id, text) or (id, text, lang)."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] else None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name, value in (extra or {}).items():
            df = df.withColumn(name, value)
        return df

    return make


@pytest.fixture(scope="session")
def hard(documents):
    """Nulls, empty, long and repeated rows, white space only, other scripts, and an empty id."""
    long = " ".join(f"word{i % 997} filler" for i in range(20_000))
    rows = [
        (1, None),
        (2, ""),
        (3, "  \n\t\n "),
        (4, long),
        (5, long),
        (6, "日本語の文 हिन्दी ไทย\u0000\u001c\u0085é"),
        (7, "same text here", None),
        (7, "same text here", None),
        (None, "no id but text that is long enough to be a line"),
        (8, "\n".join(["line " * 8] * 3)),
    ]
    return documents(rows)
