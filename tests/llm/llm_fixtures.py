"""Small fixtures of the training-data operators."""

import random


import pytest


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

#: columns an operator may use inside; a table that brings them must not clash
CLASHES = ("id", "key", "n", "node", "root", "size", "row", "x", "label", "score", "rank", "block", "address", "payload")


def text_rows(seed=0):
    """Documents with nulls, empty and very long texts, ties and copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(30, 120))) for _ in range(25)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]

    def edited(t, changes):
        words = t.split(" ")
        for _ in range(changes):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return " ".join(words)
    rows += [(100 + i, base[i % 25], "en", "s0") for i in range(10)]
    rows += [(200 + i, edited(base[i % 12], 1 + i % 7), "en", "s1") for i in range(60)]
    rows += [(300 + i, " ".join(rng.choices(vocabulary, k=15)) + " " + " ".join(base[3].split(" ")[:28]), "en", None) for i in range(6)]
    rows += [(400, None, None, None), (401, "", "en", "s2"), (402, " \t\n ", "en", "s2"), (403, "one", "en", "s2"), (404, "ONE", "en", "s2"),
             (405, "one two", "en", "s2"), (None, base[0], "en", "s0"), (406, " ".join(rng.choices(vocabulary, k=30000)), "en", "s0"),
             (407, "same " * 300, "en", "s1"), (408, "same " * 250, "en", "s1"), (409, "É é naïve É é", "fr", "s1")]
    rows += [rows[0], rows[0]]  # repeated rows
    return rows


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "cast(length(text) as long) n_chars")
    for c in CLASHES if clash else ():
        df = df.selectExpr("*", f"'clash' as {c}")
    return df


@pytest.fixture(scope="module")
def rows():
    return text_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows, clash=True).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], clash=True)
