import random

import pytest

#: Extra columns whose names clash with those that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, uid long, doc long, key long, words int, row int, n long, part int"


def frame(spark, rows):
    """(doc_id, text) rows with clashing extra columns, some of them null."""
    return spark.createDataFrame([(i, t, None, 1, 2, None, 3, 4, 5, 6) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def prose():
    """Distinct pseudo-words in sentences, the same each time."""
    rnd = random.Random(11)
    syllables = "ba ce di fo gu la me ni po ru sa te vi zo".split()

    def word():
        return "".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4)))

    def make(n):
        out = [word() for _ in range(n)]
        return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(out))

    return make


@pytest.fixture(scope="session")
def awkward(spark, prose):
    """Nulls, empty and blank texts, repeated rows, ties, one long text."""
    a = prose(120)
    rows = [(1, a), (1, a), (2, a), (3, None), (None, prose(30)), (4, ""), (5, " \n\n \t"), (6, prose(25_000)), (7, "é" * 50 + " 日本語 😀 " + a), (None, None), (8, "x")]
    return frame(spark, rows), rows


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
