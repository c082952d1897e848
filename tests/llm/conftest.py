import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside, on columns that are not theirs.
        T.StructField("batch", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("owner", T.StringType()),
    ]
)
BASE = " ".join(f"word{i % 37}x{i}" for i in range(120))
NEAR = BASE.replace("word5x5 ", "other ")
LONG = " ".join(f"l{i % 1009}" for i in range(60_000))


def row(doc_id, text, lang="en", source="s", **more):
    return (doc_id, text, lang, source, None if text is None else len(text), "b", "z", None, 7, "o")


AWKWARD = [
    row(1, BASE + "\nA line that many have, word for word.\n"),
    row(2, BASE + "\nA line that many have, word for word.\n"),
    row(3, NEAR + "\nA line that many have, word for word!\n", source=None),
    row(3, NEAR + "\nA line that many have, word for word!\n", source=None),
    row(4, None, lang=None),
    row(5, "", source="t"),
    row(6, " \t\n ", lang="de"),
    row(7, "one", source="t"),
    row(8, "same same " * 60, lang="de"),
    row(9, LONG, lang="de", source="u"),
    row(9, "Ünïcode — ελληνικά, 中文 text without much more to say", source="u"),
    row(None, "nothing known about this one, not even its number", source="u"),
    row(-5, BASE + " tail", lang=None, source="t"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
