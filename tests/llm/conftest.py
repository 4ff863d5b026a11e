"""Fixtures of the operator tests: a small corpus with planted cases and edge rows."""

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) of a corpus with copies, near copies, shared passages, hot lines, junk and edge cases."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(800)] + 40 * ["the", "of"] + ["the", "of", "and", "der", "die", "la", "é", "ñandú"]

    def prose(n):
        out = []
        for i in range(n):
            out.append(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n"]))
        return " ".join(out)

    docs = [prose(rng.randint(1, 400)) for _ in range(60)]
    passage, line = prose(70), "a common line in very many of the documents here"
    docs += [docs[3]] * 4 + [docs[5] + " tail"] * 2
    base = prose(300).split()
    for i in range(25):
        near = list(base)
        for j in rng.sample(range(300), 1 + i % 12):
            near[j] = f"z{i}_{j}"
        docs.append(" ".join(near))
    docs += [prose(40) + " " + passage + " " + prose(30) for _ in range(12)]
    docs += [line + "\n" + prose(50) + "\n" + line for _ in range(15)]
    docs += ["a b " * 200, "x " * 120, " ".join(f"p{i % 40}" for i in range(300)), "#*$%&|<> " * 50, "ÀÉ The 12 \x1c tab\tvt\x0bff\x0c",
             "one two three four", "ONE two  three FOUR", "   ", "\n\n", prose(6000)]
    out = list(enumerate(docs))
    out += [(None, None), (None, ""), (900, None), (901, docs[7]), (901, docs[7]), (902, prose(120)), (902, prose(90))]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus as a documents table with a clashing extra column, over several partitions."""
    return spark.createDataFrame([(i, t, "en", "row", None) for i, t in rows], DOC_SCHEMA.replace("source", "row")).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
