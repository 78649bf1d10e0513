import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from periodlens.functions import numbers, period, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "given, expected",
    [(" Mine ID ", "mine_id"), ("S&S  (flag)", "s_s_flag"), ("__X--y__", "x_y"), ("﻿ID", "id")],
)
def test_normalize_header(given, expected):
    assert text.normalize_header(given) == expected


def test_clean_text(spark):
    assert column(spark, [" a ", "\t\xa0", "", None, "a b"], text.clean_text) == ["a", None, None, None, "a b"]


def test_parse_bool(spark):
    given = ["Y", "no", " TRUE ", "0", "maybe", " ", None]
    assert column(spark, given, text.parse_bool) == [True, False, True, False, None, None, None]


def test_parse_int(spark):
    assert column(spark, ["5", " 5 ", "5.0", "", "-3", "x"], text.parse_int) == [5, 5, None, None, -3, None]


def test_unparsable(spark):
    assert column(spark, ["5.0", "", "7"], lambda c: text.is_unparsable(c, text.parse_int(c))) == [True, False, False]


def test_parse_decimal(spark):
    found = column(spark, ["1,234.50", "x", "", "-2"], text.parse_decimal)
    assert found == [Decimal("1234.50"), None, None, Decimal("-2")]


def test_parse_date(spark):
    good = ["2020-03-07", "3/7/2020", "20200307", "07-MAR-2020", "2020/3/7", " 7-mar-2020 "]
    bad = ["3/7/20", "02/30/2020", "03/07/2020 00:00", "", None, "2020115"]
    found = column(spark, good + bad, text.parse_date)
    assert found == [dt.date(2020, 3, 7)] * len(good) + [None] * len(bad)


def test_period_keys(spark):
    days = ["2020-03-31", "2020-04-01", "2020-12-31"]
    assert column(spark, days, lambda c: period.period_of_date(c.cast("date"))) == ["2020Q1", "2020Q2", "2020Q4"]
    keys = ["2020Q4", "2021Q1"]
    following = lambda c: period.next_period_key(period.period_year(c), period.period_quarter(c))
    assert column(spark, keys, following) == ["2021Q1", "2021Q2"]


def test_decimal_id_text(spark):
    given = ["12.50", "12.5", "0.00", "", None, "007", "1,000", "+5", ".5", "0.5"]
    assert column(spark, given, text.decimal_id_text) == ["12.50", "12.5", "", "", "", "7", "1000", "5", "0.5", "0.5"]


def test_record_id_treats_null_as_empty(spark):
    row = spark.range(1).select(
        text.record_id([F.lit("a"), F.lit(None).cast("string"), F.lit("b")]).alias("x"),
        text.record_id([F.lit("a"), F.lit(""), F.lit("b")]).alias("y"),
        text.record_id([F.lit("a"), F.lit("b"), F.lit("")]).alias("z"),
    ).first()
    assert row.x == row.y != row.z


def test_row_fingerprint(spark):
    df = spark.createDataFrame([("1", None), ("1", None), ("1", "")], "b string, a string")
    found = [r[0] for r in df.select(text.row_fingerprint(["b", "a"])).collect()]
    assert found[0] == found[1] != found[2]


def test_composite_key_and_digits(spark):
    row = spark.range(1).select(
        text.composite_key(F.lit("v"), F.lit(None).cast("string"), F.lit(3)).alias("key"),
        text.fixed_digits(F.lit(60.65), 1).alias("one"),
        text.fixed_digits(F.lit(0.5), 2).alias("two"),
    ).first()
    assert (row.key, row.one, row.two) == ("v||3", "60.7", "0.50")


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, -1), (1, None), (None, 2)], "n int, d int")
    found = [r[0] for r in df.select(numbers.guarded_ratio(F.col("n"), F.col("d"))).collect()]
    assert found == [0.5, None, None, None, None]


def test_model_family(spark):
    versions = ["rule_score_v1", "logreg_v1_x", "other"]
    assert column(spark, versions, numbers.model_family) == ["rule_score", "logreg", "unknown"]


def test_decimal_id_text_of_cleaned_numbers(spark):
    given = ["+1,200.50", "007", ".5", "5.", "1e3", "12", "-3", "0.00", "x", None, "0.5", "00", "+.5", "2e0"]
    expected = ["1200.50", "7", "0.5", "5", "1E3", "12", "-3", "", "", "", "0.5", "", "0.5", "2E0"]
    found = column(spark, given, lambda c: text.decimal_id_text(c, text.parse_decimal(c)))
    assert found == expected
    assert column(spark, given, text.decimal_id_text) == expected
