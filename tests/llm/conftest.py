import random

import pytest

WORDS = ["".join(random.Random(i).choices("abcdefghij", k=random.Random(i + 999).randint(2, 6))) for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Unrelated texts, exact and near copies, shared passages, short and empty texts, nulls, a long one."""
    rng = random.Random(1)
    rows = [(i, prose(i, 120)) for i in range(40)]
    for i in range(40, 60):  # near copies of 0 with some words changed
        w = prose(0, 120).split()
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = "new" + str(rng.randrange(1000))
        rows.append((i, " ".join(w)))
    shared = prose(777, 60)
    rows += [(60 + i, prose(1000 + i, 40) + " " + shared + "\n" + prose(2000 + i, 30)) for i in range(8)]
    rows += [(70, prose(5, 120)), (71, "  " + prose(5, 120).replace(" ", "\n")), (72, "one two"), (73, "one two"), (74, ""), (75, ""), (76, None), (77, None), (78, " \n "), (79, "short"), (80, prose(9000, 20000))]
    rows += [(81, " ".join([prose(42, 55)] * 4)), (None, prose(3, 120)), (12, prose(12, 120))]
    return spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in rows], SCHEMA)
