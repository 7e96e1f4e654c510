import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from riskframe.llm.common import workers_import
    from riskframe.session import build_session
    s = build_session("local[4]", app="riskframe-llm-tests", shuffle_partitions=4, driver_memory="6g")
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-llm-ckpt-"))
    workers_import(s)
    yield s


PHRASE = ("the quick brown fox jumps over the lazy dog while seven clever wizards brew potent mixtures of strange "
          "herbs beneath a pale moon and sing old songs about rivers mountains and forgotten kings of the north "
          "who sailed across cold seas in wooden ships to find new land")


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, shared passages."""
    words = PHRASE.split()
    near = words[:]
    near[20] = "changed"
    rows = [
        (1, PHRASE, "en", "a", 1), (2, PHRASE, None, None, None), (3, " ".join(near), "en", "a", 3),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (6, "   \n\t ", "en", "a", 6), (7, "one", "en", "a", 3),
        (8, "one two", "en", "a", 7), (9, "One  two ", "en", "a", 9), (10, "été 日本語 <|endoftext|> 'tis we'll", "fr", "b", 4),
        (11, "x" * 3000, "de", "b", 3000), (12, ("a b " * 4000), "es", "b", 16000),
        (13, "start of its own " + PHRASE + " and another end", "en", "b", 2), (13, "repeated id, other text", "en", "b", 1),
        (14, "\x00 nul \x1c \x85   marks", "en", "b", 5), (14, "\x00 nul \x1c \x85   marks", "en", "b", 5),
        (None, "no id here", "en", "b", 1), (None, PHRASE, "en", "b", 1), (20, "😀😀 it's 12³ items!?", "en", "b", 2),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    # columns whose names clash with those the operators make
    return df.withColumns({"key": F.lit(1), "size": F.lit("x"), "score": F.lit(0.5), "bucket": F.lit(2), "n": F.lit(3)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
