import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    os.environ["PYTHONPATH"] = sys.path[0]
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in any column, empty and blank texts, a very long text, ties, repeated rows, a repeated id with another text.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t \n", "en", "a", 5), (None, "no id here at all", "en", None, 17), (None, None, None, None, None),
    (4, "one two three four five six", "en", "a", 27), (4, "one two three four five six", "en", "a", 27), (4, "another text with the same id", "en", "a", 29),
    (5, "word " * 60_000, "en", "b", 300_000), (6, "x" * 200_000, None, "b", 200_000), (7, "ÀÉ ß 漢字 😀   é", "fr", "b", 10),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def clashing(odd):
    """Extra columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    names = ("row", "_k", "h", "n", "c", "r", "w", "m", "ln", "term", "text_md5", "score", "items", "asked", "part", "known", "host")
    return odd.withColumns({n: F.lit(n) for n in names})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
