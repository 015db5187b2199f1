from __future__ import annotations

import pytest

#: Nulls, empty and very long texts, repeated rows, one id twice, ties, and columns with names that operators use themselves.
ROWS = [
    (1, "The cat sat on the mat and the dog ran to the house of the king", "en", "a", 0),
    (2, None, None, None, 0),
    (3, "", "en", "a", 0),
    (4, "   \n\t ", "fr", "b", 0),
    (5, "le chat est sur la table et le chien dans la maison du roi", "fr", "b", 0),
    (5, "le chat est sur la table et le chien dans la maison du roi", "fr", "b", 0),
    (7, "word " * 20000, "en", "a", 0),
    (None, "an id that is null, and the text of it", "en", None, 0),
    (9, "12345 67890 !!!", None, "c", 0),
    (10, "x", "en", "a", 0),
    (10, "another text of the same id", "en", "a", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, size int, taken int, fp int, score int, runs string, base string, thash int, k int, bucket int, u int, v int, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r[:4], r[4], 1, 2, 3, "r", "b", 4, 5, 6, 7, 8, len(r[1] or "")) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
