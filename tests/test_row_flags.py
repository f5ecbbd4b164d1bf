"""Checks within one response, with all kinds of missing values."""

import pytest

from surveysieve.functions.columns import nan_to_null
from surveysieve.functions.text import WHITE_SPACE, sorted_tokens, strip, text_key
from surveysieve.operators import row_flags
from pyspark.sql import functions as F

INF = float("inf")


def flags(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_value_in_range(spark):
    df = nan_to_null(
        spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,), (float("nan"),)], "`a b.c` double")
    )
    assert flags(df, row_flags.value_in_range("a b.c", 2, 3)) == [False, True, True, False, False]
    assert flags(df, row_flags.value_in_range("a b.c", -INF, 2)) == [True, True, False, False, False]
    assert flags(df, row_flags.value_in_range("a b.c", 2, INF)) == [False, True, True, False, False]
    assert flags(df, row_flags.value_in_range("a b.c", -INF, INF)) == [True, True, True, False, False]


def test_custom_condition(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("y", None)], "`Q1.a` string, n int")
    assert flags(df, row_flags.custom_condition("`Q1.a` == 'x' and n < 5")) == [True, False, False]
    assert flags(df, row_flags.custom_condition("NOT (`Q1.a` <=> 'x')")) == [False, True, True]


def test_reverse_coded(spark):
    rows = [(7, 7, 7, 6), (7, 7, 1, 1), (4, 4, 7, 7), (-99, 7, 7, None), (None, -99, 1, 1), (1, None, -99, 2)]
    df = spark.createDataFrame(rows, "p1 int, p2 int, n1 int, n2 int")
    column = row_flags.reverse_coded(["p1", "p2"], ["n1", "n2"], 1, 7)
    # The midpoint gives a product of 0, which counts.
    assert flags(df, column) == [True, False, True, True, False, True]
    strict = row_flags.reverse_coded(["p1", "p2"], ["n1", "n2"], 1, 7, 0.5)
    assert flags(df, strict) == [True, False, False, True, False, True]
    with pytest.raises(ValueError):
        row_flags.reverse_coded(["p1"], ["n1"], 3, 3)


def test_suspicious_character(spark):
    df = spark.createDataFrame([("a\xa0b", None), ("ab", "c%%"), (None, None), ("", "%")], "a string, b string")
    assert flags(df, row_flags.suspicious_character(df.columns, ["a", "b"])) == [True, False, False, False]
    with pytest.warns(UserWarning, match="gone"):
        column = row_flags.suspicious_character(df.columns, ["a", "gone", "b"], ["%%", "\xa0"])
    assert flags(df, column) == [True, True, False, False]
    with pytest.warns(UserWarning):
        assert flags(df, row_flags.suspicious_character(df.columns, ["gone"])) == [False] * 4


def test_suspicious_name(spark):
    rows = [("Ann Lee", " lee"), ("J", "J"), ("Élodie", "ÉLODIE x"), (None, "a"), ("Jo-Ann", "ann"), ("ab_c", "ab c")]
    df = spark.createDataFrame(rows, "f string, l string")
    assert flags(df, row_flags.suspicious_name("f", "l")) == [True, False, True, False, True, False]
    assert flags(df, row_flags.suspicious_name("f", "l", 4)) == [False, False, True, False, False, False]
    assert flags(df, row_flags.suspicious_name("f", "l", 1))[1]


def test_outside_region(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "place string")
    assert flags(df, row_flags.outside_region(F.col("place"), "A", False)) == [False, True, False]
    assert flags(df, row_flags.outside_region(F.col("place"), "A", True)) == [False, True, True]


def test_white_space_is_what_python_strips():
    assert set(WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_text_helpers(spark):
    texts = ["　 b  a\xa0A \x1c", "", "   ", "x" * 63, "é" * 32, "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert flags(df, strip(F.col("t"))) == [t.strip() for t in texts]
    assert flags(df, sorted_tokens(F.col("t"))) == [" ".join(sorted(t.split())) for t in texts]
    keys = flags(df, text_key(F.col("t")))
    assert keys[3] == texts[3] and len(keys[4]) == 64 and len(set(keys)) == len(texts)
