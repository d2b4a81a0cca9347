import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PHRASE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix potent "
          "brews beside nineteen glowing lanterns near an old river mill")
LONG = " ".join(f"w{k % 977}x{k // 977}" for k in range(6000))


def rows_with_trouble():
    """Nulls, empty and very long texts, ties, repeated rows, shared passages."""
    base = [f"alpha{k} beta{k} gamma{k} delta{k}" for k in range(60)]
    near = PHRASE.replace("lazy", "sleepy")
    docs = [
        (0, PHRASE + "\nsecond line here\nthird line here\nfourth line here"),
        (1, "other start\nsecond line here\nthird line here\nfourth line here\nother end"),
        (2, None), (3, ""), (4, "   \n \t\n"), (5, PHRASE), (6, PHRASE), (7, near),
        (8, "Prefix words " + PHRASE + " and a suffix"), (9, "tiny"), (10, "Tiny"), (11, "a b c"),
        (12, " ".join(["again"] * 45)), (13, LONG), (14, LONG + " end"), (15, " ".join(base)),
        (16, " ".join(base[:-1] + ["other words here now"])), (17, "x\n\n \nsecond line here\n\nthird line here\nfourth line here"),
        (18, "Zażółć gęślą jaźń naïve café Straße 東京 東京   tail"), (19, "second line here\r\nthird"),
        (20, "a" * 300 + "  double  spaces\ttabs\n\n\nlines"), (None, "null id " + PHRASE), (21, "b b b b b b"),
        (5, PHRASE), (5, PHRASE), (9, None),
    ]
    return docs


@pytest.fixture(scope="session")
def trouble(spark):
    rows = [(i, t, "source", 1, "clash", 2) for i, t in rows_with_trouble()]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, start int, bucket string, n int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def pairs():
    return rows_with_trouble()
