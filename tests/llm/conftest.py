import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# the tests' tasks import the package from here; set before the session starts its workers
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
sys.path.insert(0, os.path.join(ROOT, "tests"))

#: Names that operators use inside; as further columns of an input they must do no harm.
CLASHES = "id key score text_key spans range ghost packed node bands label pattern value start n_words term position"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHES.split()
)
LONG = " ".join(f"w{i % 977}q{i % 13}" for i in range(30_000))
COPY = " ".join(f"copy{i}" for i in range(80))
NEAR = COPY.replace("copy79", "other")


def rows_of(texts):
    """Rows (doc_id, text) as full rows, with nulls in every further column."""
    return [(i, t, None, None, None, *["x"] * len(CLASHES.split())) for i, t in texts]


EDGE_TEXTS = [
    (5, COPY),
    (3, COPY),
    (4, NEAR),
    (1, None),
    (2, ""),
    (7, " \n\t "),
    (8, "one two"),
    (9, "one two"),
    (9, "one two"),
    (9, COPY + " and a different text under the same id"),
    (None, COPY),
    (None, None),
    (10, LONG),
    (11, "Ünïcode 😀 ſ ﬁ И \x00 \x1c İ <|endoftext|> tail"),
    (12, "x" * 60_000),
    (-4, "mail ann@example.org from 10.0.0.1, card 4111 1111 1111 1111, call +1 (234) 555-2222"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(rows_of(EDGE_TEXTS), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
