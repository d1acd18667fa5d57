import hashlib

import pytest

# One text of every awkward kind: null, empty, no letters, ties, very long with and without white space.
LONG = "lorem ipsum dolor " * 6000
RUN = "a" * 90_000
AWKWARD = [None, "", "  \n\t ", "123 !!", "one", "one two", "é ñ ß", "x" + " " * 70_000 + "y", "tab\t\nline", LONG, RUN, "a b a b a b", "a b a b a b"]


@pytest.fixture
def awkward(spark):
    """Documents with awkward texts, repeated rows and clashing extra columns."""
    rows = [(i, t, "en", "src", "clash", "clash", "clash") for i, t in enumerate(AWKWARD)]
    rows += [rows[-1], (None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fp string, host string, `dotted.name` string")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
