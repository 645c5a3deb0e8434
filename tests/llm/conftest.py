from __future__ import annotations

import pytest

ODD = [
    (1, "the cat sat on the mat and looked at the door for a while", "en"),
    (1, "the cat sat on the mat and looked at the door for a while", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \n\t ", "de"),
    (None, "a row without an id but with some words in it all the same", "fr"),
    (5, "x" * 50_000 + " " + "long words and many of them " * 3000, "xx"),
    (6, "one", "en"),
    (7, "été \U0001f642 \x00   café 　 日本語", None),
]
#: columns that operators themselves use inside
CLASHES = "n_words kept n_tokens key id list member fp win at found base spans row_key text_key h p component".split()
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) rows, with further columns of clashing names."""

    def make(rows):
        rows = [(*r, None)[:3] for r in rows]
        names = "".join(f", {c} string" for c in CLASHES)
        return spark.createDataFrame([(*r, *CLASHES) for r in rows], SCHEMA + names)

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def none(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def bag():
    """Rows of the named columns as sorted plain tuples."""

    def rows(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

    return rows
