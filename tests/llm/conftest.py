import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tid string, key long, size int, row string, rid long, score double, block long, kept string, n_bytes string"
#: Column names that operators use inside.
CLASHES = {"tid": "x", "key": 1, "size": 2, "row": "r", "rid": 3, "score": 0.5, "block": 4, "kept": "k", "n_bytes": "b"}


def frame(spark, rows):
    """Documents (id, text) with more columns, whose names clash with inner ones."""
    full = [(i, t, "en", "src0", None if t is None else len(t), *CLASHES.values()) for i, t in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


@pytest.fixture
def docs(spark):
    return lambda rows: frame(spark, rows)


def prose(rng, n, words=400):
    """n texts of invented words."""
    import numpy as np

    pool = np.array(["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(900)])
    return [" ".join(rng.choice(pool, words)) + "." for _ in range(n)]


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    import numpy as np

    rng = np.random.default_rng(5)
    a, b, c = prose(rng, 3, 300)
    return [(1, a), (1, a), (2, a), (None, a), (3, None), (4, ""), (5, " \n"), (6, "é"), (7, b + "\n" + c), (8, c), (None, None), (9, "word " * 3000), (10, "x" * 9000), (11, "日本語 🙂 " * 200), (12, "short text"), (12, "other text")]
