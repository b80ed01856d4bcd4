import pytest


@pytest.fixture(scope="session")
def shared(spark):
    """The session, which names a shared folder."""
    assert spark.conf.get("spark.checkpoint.dir")
    return spark


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, start int, spans string, kept string, key string, id string"


@pytest.fixture(scope="session")
def frame(shared):
    """Documents from (doc_id, text[, source]), with further columns that clash in name."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None, 1.0, 7, "x", "y", "z", "w") for r in rows]
        return shared.createDataFrame(full, SCHEMA)

    return make


PLAIN = " ".join(f"word{i} is followed by item{i * 7 % 23}," for i in range(40))
#: Nulls, empty and long texts, ties, repeated rows and a row without an id.
ODD = [(1, None), (2, ""), (3, "   \n "), (4, PLAIN), (4, PLAIN), (5, PLAIN), (None, PLAIN), (6, "été naïve 日本 " * 3000), (7, "x" * 50_000, None)]
