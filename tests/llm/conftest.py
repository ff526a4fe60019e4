import random

import pytest

SYLLABLES = "an er th in on re ti es or st en at nd he ha ea ed ou is it".split()


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n invented words."""

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows): documents from (doc_id, text), with further columns whose names clash with those that operators make."""

    def make(rows, n=3):
        rows = [(d, t, "en", "s", len(t or ""), "x", 1) for d, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, hits int").repartition(n)

    return make
