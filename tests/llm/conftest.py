import random

import pytest
from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def text(rng, n):
    return "\n".join(sentence(rng, 12) for _ in range(max(1, n // 12)))


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, empties, repeats, ties, copies and one very long text."""
    rng = random.Random(7)
    rows = [(i, text(rng, 60 + i)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "one two three four")]
    rows += [(105, rows[3][1]), (106, rows[3][1] + " more"), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(107, rows[5][1].replace("w1 ", "w2 ", 1)), (None, rows[6][1]), (None, None)]
    rows += [(108, text(rng, 60_000)), (109, "漢字 é   ünï x \U0001f642 " * 30), (110, "a" * 5000)]
    return rows


CLASHES = "kept score fertility limits id_ p row_ place_ part_ key bands class_id spans redacted pattern".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (id, text) rows, with further columns named like those inside the operators."""

    def make(rows, clash=True):
        data = [(i, t, None if i is None else "en" if i % 3 else None, "s", None) for i, t in rows]
        docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return docs.select("*", *[F.lit("x").alias(name) for name in CLASHES]) if clash else docs

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
