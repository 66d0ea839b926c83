from datetime import datetime

import pytest
from pyspark.sql import functions as F

from duskwork.functions import dates, text
from duskwork.sources.params import ParameterError, number_param, param, set_param
from tests.helpers import rows


def one(spark, column, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first()[0]


@pytest.mark.parametrize("value, expected", [(None, None), ("", None), ("   ", None), (" a ", "a")])
def test_trimmed(spark, value, expected):
    assert one(spark, text.trimmed("x"), value) == expected
    assert one(spark, text.has_text("x"), value) is (expected is not None)
    assert one(spark, text.yes_no(text.has_text("x")), value) == ("Y" if expected else "N")


@pytest.mark.parametrize("value, expected", [(None, None), ("        ", None), ("AB      ", "AB"), (" AB", " AB")])
def test_code(spark, value, expected):
    assert one(spark, text.code("x"), value) == expected


def test_padded(spark):
    assert one(spark, text.padded("x"), "AB") == "AB      "
    assert one(spark, text.padded("x"), "ABCDEFGHIJ") == "ABCDEFGH"


def test_decode_treats_null_as_equal(spark):
    column = text.decode("x", [("a", "1"), (None, "null")], "other")
    assert [one(spark, column, v) for v in ("a", None, "z")] == ["1", "null", "other"]
    assert one(spark, text.decode("x", [("a", "1")]), "z") is None


def test_joined_reads_null_as_empty(spark):
    assert one(spark, text.joined("a", F.col("x"), "b")) == "ab"
    assert one(spark, text.joined(F.col("x"), F.col("x"))) is None
    assert one(spark, text.piped(F.lit(1), F.col("x"), F.lit("z"))) == "1||z"


@pytest.mark.parametrize("race, expected", [("CHI", "Tan Mei"), ("OTH", "Mei Tan"), (None, "Mei Tan")])
def test_full_name(spark, race, expected):
    frame = spark.createDataFrame([(race, " Tan ", "Mei  ")], "race string, s string, g string")
    assert frame.select(text.full_name("race", "s", "g")).first()[0] == expected


@pytest.mark.parametrize("size, pieces", [(0, 0), (10, 1), (78, 1), (79, 2), (468, 6), (500, 6)])
def test_fixed_segments(spark, size, pieces):
    got = one(spark, text.segments("x", 78, 6), "a" * size)
    assert len(got) == 6 and sum(p is not None for p in got) == pieces


@pytest.mark.parametrize("size, pieces", [(10, 1), (78, 1), (79, 2), (500, 7)])
def test_segments_of_whole_text(spark, size, pieces):
    got = one(spark, text.segments("x", 78), "a" * size)
    assert len(got) == pieces and "".join(got) == "a" * size


@pytest.mark.parametrize("value, pattern, hit", [
    ("a\\b", "a\\b", True), ("a_b", "a_b", True), ("axb", "a_b", True), ("axxb", "a%b", True), ("ab", "a_b", False),
])
def test_like_pattern(spark, value, pattern, hit):
    frame = spark.createDataFrame([(value, pattern)], "t string, p string")
    assert frame.select(text.matches("t", text.like_pattern(F.col("p")))).first()[0] is hit


def test_dates(spark):
    when = datetime(2024, 3, 9, 13, 5, 7)
    assert dates.key_of(when) == 20240309
    assert dates.last_run_stamp(when) == "20240903"
    assert dates.days_before(when, "1.5") == datetime(2024, 3, 8, 1, 5, 7)
    frame = spark.range(1).select(dates.moment(when).alias("t"))
    assert frame.select(dates.date_key(F.col("t")), dates.stamp_text(F.col("t"))).first()[:] == (20240309, "2024-03-09 13:05:07")
    assert frame.schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_params(spark):
    table = spark.createDataFrame([("A", "1.5"), ("B", "x"), ("C", "1"), ("C", "2"), ("D", None)], "param_code string, value string")
    assert param(table, "B") == "x"
    assert number_param(table, "A") == 1.5
    for code in ("C", "NONE"):
        with pytest.raises(ParameterError):
            param(table, code)
    with pytest.raises(ParameterError):
        number_param(table, "D")
    with pytest.raises(ValueError):
        number_param(table, "B")
    assert rows(set_param(table, "A", "7"))[0] == ("A", "7")
