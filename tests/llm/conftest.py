import pytest

from ..conftest import SF_SMALL

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, sig string, component_id int, "
          "__llm_key string, __llm_kept int, __mix_of string, __mix_size int, __mix_copies string, _pid int, __pid int, "
          "_local string, _base int, _tie int, key int, size int, n int, rank int, row int, name string, _id int, of int")


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest scale."""
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows and
    ids, and extra columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    same = " ".join(f"tie{i}" for i in range(40))
    rows = [(1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (2, "another text with the same id", "de", "b"),
            (3, None, None, None), (4, "", "en", "a"), (5, "   \n\t ", "en", None), (None, same, "en", "a"),
            (None, None, None, None), (6, long, "en", "b"), (7, long + " end", "fr", "c"), (8, "one two", "en", "c"),
            (9, "ONE two", "en", "c"), (10, "é — 漢字 ß", "de", "c"), (11, "123 456 !!", None, "c")]
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "x", 7, "k", 1, "m", 2, "c", 3, 4, "l", 5, 6, *range(5), "n", 8, 9)
                                   for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    """No rows."""
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
