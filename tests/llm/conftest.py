import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): a table (doc_id, text) with extra columns whose names the operators use."""

    def make(rows):
        names = ["n", "h1", "row", "hash", "copy", "token", "line"]
        schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([(i, t, *names) for i, t in rows], schema)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n invented words."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n))

    return make
