import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, lexicon=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(3)) + str(r.randrange(lexicon)) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long_text = words(7, 30_000)
    return [
        (None, "a row without an id", "en", "a", None),
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (3, "   \n\t ", "de", "b", 6),
        (4, long_text, "en", "b", len(long_text)),
        (5, "one two three four five six seven", "en", "c", 33),
        (5, "one two three four five six seven", "en", "c", 33),
        (5, "the same id with another text of its own", "en", "c", 40),
        (6, "one two three four five six seven", "fr", "c", 33),
        (7, "éà ü 漢字 \U0001f600 ß", "fr", "d", 9),
        (8, "!!! ... ???", "es", None, 11),
        (9, "x", "es", "e", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """With columns named like what operators add."""
    from pyspark.sql import functions as F

    names = ("size", "shard", "slot", "score", "predicted", "rejected", "lang_pred", "copies", "rate", "target", "mt_k1", "mt_cell", "mt_source", "mt_size", "node", "bucket", "guest", "id")
    return spark.createDataFrame(odd_rows(), DOCS).withColumns({n: F.lit("mine") for n in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
