import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns whose names clash with internal ones.
EXTRA = "_id string, _row string, _text long, words string, rep long, _m int"


@pytest.fixture(scope="session")
def shipped(spark):
    from marketfold.session import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(shipped):
    """Documents table of (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", 1, "w", 2, 3) for r in rows]
        return shipped.createDataFrame(full, f"{DOCS}, {EXTRA}").repartition(3)
    return make


def prose(seed: int, n: int, letters: str = "abcdefghijklmnop") -> str:
    import random
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(n))


ODD = [(None, "null id " + prose(1, 60)), (None, "null id " + prose(1, 60)), (900, None), (901, ""), (902, "   \n\t \n"),
       (903, prose(2, 30_000)), (904, prose(3, 80)), (904, prose(3, 80)), (905, prose(3, 80)), (906, "\x1c\u2003e\u0301 " * 40), (None, None)]
