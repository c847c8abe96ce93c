import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.functions.ids import string_id
from shelfwise.functions.reviews import parsed_date, rating_is_acceptable, review_date, review_rating
from shelfwise.functions.text import tokens
from shelfwise.functions.vectors import cosine, dot


def python_id(text):
    units = text.encode("utf-16-be")
    value = 0
    for i in range(0, len(units), 2):
        value = (value * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return value & 0xFFFFFFF


def ids_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(string_id(F.col("t"))).collect()]


def test_ids_match_the_string_hash(spark):
    texts = ["", "a", "Aa", "BB", "Customer#000000001", "é", "漢字", "😀x😀", "z" * 300]
    assert ids_of(spark, texts) == [python_id(t) for t in texts]
    assert ids_of(spark, [None]) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=50))
def test_ids_of_any_text(spark, texts):
    assert ids_of(spark, texts) == [python_id(t) for t in texts]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("February 03, 2010", (2010, 2, 3)),
        ("February 3, 2010", (2010, 2, 3)),
        ("february 3, 2010", (2010, 2, 3)),
        ("Feb 03, 2010", (2010, 2, 3)),
        ("  Feb   03,   2010", (2010, 2, 3)),
        ("February 03, 2010 extra", (2010, 2, 3)),
        ("February 03, 2010\nmore\nlines", (2010, 2, 3)),
        ("February 30, 2010", (2010, 3, 2)),
        ("February 30, 2012", (2012, 3, 1)),
        ("March 0, 2012", (2012, 2, 29)),
        ("December 32, 2010", (2011, 1, 1)),
        ("February 03, 10", (10, 2, 3)),
        ("June 0000005, 1999", (1999, 6, 5)),
        ("June -1, 2012", (2012, 5, 30)),
        ("June 1000001, 2010", (4748, 4, 28)),
        ("February 03,2010", None),
        ("Sept 03, 2010", None),
        ("Febru 03, 2010", None),
        ("02 03, 2010", None),
        ("February 99999999999, 2010", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_review_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(review_date(F.col("t")).alias("d")).select(F.date_format("d", "yyyy-MM-dd HH:mm:ss"))
    want = dt.date(*expected).isoformat() + " 00:00:00" if expected else None
    assert got.first()[0] == want


@pytest.mark.parametrize(
    "text, accepted, date",
    [
        ("June 5, 0", True, "0000-06-05"),
        ("June 5, -5", True, "-0005-06-05"),
        ("June 5, 200001", True, "+200001-06-05"),
        ("June 5, 292000", True, "+292000-06-05"),
        ("June 5, 292999", True, None),
        ("June 5, -99999999", True, None),
        ("June 5, 99999999999999999999", True, None),
        ("June 99999999999999999999, 2010", True, None),
        ("June 300000000, 2010", True, None),
        ("June 100000000, -200000", True, "+73791-02-11"),
        ("Sept 5, 2010", False, None),
        ("June 5 2010", False, None),
        ("", False, None),
    ],
)
def test_dates_far_away(spark, text, accepted, date):
    df = spark.createDataFrame([(text,)], "t string").select(parsed_date(F.col("t")).alias("p"))
    row = df.select(F.coalesce("p.accepted", F.lit(False)), F.col("p.date").cast("date").cast("string")).first()
    assert tuple(row) == (accepted, date)


@pytest.mark.parametrize(
    "text, value, kept",
    [
        ("5.0", 5.0, True), (" 4 ", 4.0, True), ("5d", 5.0, True), ("5.0f", 5.0, True),
        ("-1", -1.0, True), ("0x1p3", 8.0, True), ("1e400", float("inf"), True),
        ("Infinity", float("inf"), True), ("None", None, True), ("none", None, False),
        ("", None, False), ("five", None, False), ("inf", None, False), ("nan", None, False),
        ("infinity", None, False), ("\tinf", None, False), ("\tnan", None, False), ("+nan", None, False),
        ("\tInfinity ", float("inf"), True), ("\t3\n", 3.0, True), (None, None, False),
    ],
)
def test_review_rating(spark, text, value, kept):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(review_rating(F.col("t")), rating_is_acceptable(F.col("t"))).first()
    assert tuple(row) == (value, kept)


def test_rating_not_a_number_is_kept(spark):
    df = spark.createDataFrame([("NaN",)], "t string")
    assert df.select(F.isnan(review_rating(F.col("t")))).first()[0]
    assert df.select(rating_is_acceptable(F.col("t"))).first()[0]


def test_vectors(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])],
        "a array<float>, b array<float>",
    )
    rows = df.select(dot(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [10.0, 0.0, 0.0]
    assert rows[0][1] == pytest.approx(1.0) and rows[1][1] == 0.0 and rows[2][1] is None


def test_tokens(spark):
    df = spark.createDataFrame([("Émile's 2nd café — 漢字, don't!",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["émile", "s", "2nd", "café", "漢字", "don", "t"]
