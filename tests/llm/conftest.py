import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


def words(n, seed):
    """n words that differ with the seed."""
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 100_003}" for i in range(n))


def rows():
    base = words(120, 1)
    passage = words(60, 77)
    texts = [
        base,
        base,
        base.replace("w", "W", 3),
        " ".join(base.split()[:110] + ["other", "ending"]),
        words(40, 5) + " " + passage + " " + words(30, 6),
        words(25, 8) + "\n" + passage + "\n" + words(45, 9),
        "",
        None,
        "   \n\t ",
        "three words only",
        "a" * 5000,
        "x y " * 4000,
        "naïve café ▁ ünïcode ☃ " * 12 + words(30, 12),
        "one line of words here that repeats itself\n" * 9,
        "Released under the MIT License.",
        "% & # junk*** with$$$ many### symbols%%% in&&& it*** and$$$ so### on%%% until&&& the*** rule$$$ sees### it%%% "
        "as&&& junk*** for$$$ sure### now%%%",
    ]
    out = [
        (i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], None if t is None else len(t), "r", "s", "k")
        for i, t in enumerate(texts)
    ]
    out.append(out[4])
    out.append((None, words(50, 3), "en", "a", 10, "r", "s", "k"))
    return out


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
