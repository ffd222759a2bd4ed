import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


@pytest.fixture(scope="session")
def documents(spark):
    """Makes (doc_id, text) tables, with columns whose names operators use inside."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1, None, "y") for i, t in rows],
            "doc_id long, text string, id string, class int, n long, bucket string")
    return make


@pytest.fixture
def prose():
    """Random texts of a given number of words; the same for the same seed."""
    def make(n, seed=0):
        pick = random.Random(seed)
        return " ".join(pick.choice(WORDS) + str(pick.randrange(30)) for _ in range(n))
    return make


def by_id(result, key="doc_id"):
    """The result's rows by id; each id once."""
    rows = result.collect()
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found
