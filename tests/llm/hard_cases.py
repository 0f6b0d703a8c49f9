"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def hard_rows():
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    base = " ".join(f"Word{i}" for i in range(60))
    texts = [
        None, "", "   \n\t ", "one", "a b c d", base, base, base + " extra", base.replace("Word30", "other"),
        "éèê über ñandú 漢字 😀 " * 20, long, "x" * 5000, base.lower(), "tail " + base,
    ]
    rows = [(i * 3, t, "en", None if i % 4 == 3 else f"src{i % 3}", None) for i, t in enumerate(texts)]
    rows.append((None, "no id but a text of more than five words", None, None, 7))
    return rows + rows[5:7]


@pytest.fixture(scope="session")
def hard_docs(spark):
    """A table in the documents' shape that holds every awkward case."""
    return spark.createDataFrame(hard_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
