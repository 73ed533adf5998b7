"""Tables with odd rows, as fixtures the tests import; a second conftest would hide the first one."""

import pytest
from pyspark.sql import functions as F

LONG = "many words and lines of a very long text " * 20_000
PROSE = "The quick brown fox jumps over the lazy dog near the river bank while seven wizards mix potions in an old tower"
#: (doc_id, text): repeated rows, ties, null and empty texts, a null id, a very long text.
EDGES = [(1, PROSE), (2, None), (3, ""), (4, PROSE), (4, PROSE), (None, "an orphan of no id"), (5, LONG), (6, " \t\n"), (7, "!"), (7, "é ß")]
#: Columns that operators might use themselves.
CLASHING = "ids decoded labels score lang lang_pred size shard place version fp class component_id failed measured piece length offset sequence_id n_words"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from duebook.llm.common import prepare

    prepare(spark)


@pytest.fixture(scope="session")
def frame(spark):
    def build(rows, schema="doc_id long, text string", extra=CLASHING):
        names = [c for c in extra.split() if c not in schema.split()]
        df = spark.createDataFrame(rows, schema)
        return df.select("*", *[F.lit("x").alias(n) for n in names])

    return build


@pytest.fixture(scope="session")
def edges(frame):
    return frame(EDGES)


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])


SAMPLE = "/root/testdata/sf0.001"
