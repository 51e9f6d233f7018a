import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "id bigint, key string, block int, fp string, grp int, row_0 string, seed int")


def prose(rng, n, words=None):
    words = words or "the of and to in house river stone garden window under silver morning people walked".split()
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Small documents with nulls, empty, blank and very long texts, copies, near copies, shared
    passages, a repeated id and a repeated row."""
    rng = random.Random(5)
    passage = prose(rng, 30, [f"w{i}" for i in range(50)])
    texts = [prose(rng, rng.randint(5, 120)) for _ in range(30)]
    texts += [texts[3], texts[3], texts[4] + " tail", texts[5].replace("river", "brook", 1)]
    texts += [f"{prose(rng, 10)} {passage} {prose(rng, 12)}" for _ in range(5)]
    texts += [None, "", " \n\t ", "a", "two words", "###$$$%%%", "a " * 40_000, "x" * 30_000, "Ünïcode ﬁ 漢字 🙂   x"]
    found = [(i, t) for i, t in enumerate(texts)]
    found += [(None, texts[3]), (None, None), (7, "another text under an id that is taken"), (9, texts[9])]
    return [(i, t, rng.choice(["en", "de", None]), "src0", None if t is None else len(t), 1, "k", 2, "f", 3, "r", 4) for i, t in found]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
