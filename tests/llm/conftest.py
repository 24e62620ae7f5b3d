import pytest

pytest.importorskip("rowtide.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, cid string, token string"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, source]) as a table with further columns whose names operators use inside."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 0, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank TODAY"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, long),
        (7, long + " tail"),
        (8, "two words"),
        (9, "Two words"),
        (9, "Two words"),
        (10, "été à la plage\nété à la plage\nÉTÉ À LA PLAGE"),
        (None, "a row without an id that has some words in it"),
        (None, None),
        (11, "a row without an id that has some words in it"),
    ]
