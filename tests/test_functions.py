"""Scalar rules at their edges."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions.calendar import calendar_parts, days_between
from clickloom.functions.hashing import fold_of
from clickloom.functions.offers import active_flag, discount_bucket
from clickloom.functions.scores import blend, hard_label, log_loss, min_max
from clickloom.functions.values import (
    blank_words, key_long, key_text, number, parse_timestamp, strict_timestamp, text_to_number,
)

NAN = float("nan")


def values(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


def test_number_texts(spark):
    cases = {
        "1e3": 1000.0, " 7 ": 7.0, "inf": float("inf"), "-Infinity": float("-inf"), "nan": None,
        "1,000": None, "True": None, "0x10": None, "0x1p3": None, "1d": None, "2f": None, "": None,
        ".5": 0.5, "5.": 5.0, "-3": -3.0, "e5": None, "+1.5E-2": 0.015,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)],
                               "s string, want double").coalesce(1)
    for text, want, got in values(df, "s", "want", text_to_number(F.col("s"))):
        assert got == want, text


def test_number_of_typed_columns(spark):
    df = spark.createDataFrame([(1, NAN, "x"), (None, 2.5, "3")], "i int, d double, s string").coalesce(1)
    got = values(df, number(df, "i", 0), number(df, "d", 0), number(df, "s", 0))
    assert got == [(1.0, 0.0, 0.0), (0.0, 2.5, 3.0)]
    assert values(df, number(df, "d")) == [None, 2.5]


def test_missing_words(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("",), ("0",), ("na",)], "s string").coalesce(1)
    assert values(df, blank_words(F.col("s"))) == [None, None, None, "0", "na"]


def test_keys(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "s string").coalesce(1)
    assert values(df, key_long(F.col("s"), 0)) == [12, 0, 0]
    ids = spark.createDataFrame([(5,), (None,)], "i bigint").coalesce(1)
    assert values(ids, key_text(F.col("i"))) == ["5", None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(df, key_long(F.col("s")))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("2023-11-05",), ("11/06/2023",), ("03/10/2024 02:30:00",), ("junk",), (None,)]
        df = spark.createDataFrame(rows, "s string").coalesce(1)
        both = parse_timestamp(F.col("s"), ["yyyy-MM-dd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss"])
        assert values(df, both) == [
            datetime(2023, 11, 5), datetime(2023, 11, 6), datetime(2024, 3, 10, 2, 30), None, None
        ]
        assert values(df, parse_timestamp(F.col("s")))[:2] == [datetime(2023, 11, 5), None]
        one = parse_timestamp(F.col("s"), ["MM/dd/yyyy"])
        assert values(df, one) == [None, datetime(2023, 11, 6), None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_strict_timestamp(spark):
    good = spark.createDataFrame([("2023-11-05 01:02:03",)], "s string")
    assert values(good, strict_timestamp(F.col("s"))) == [datetime(2023, 11, 5, 1, 2, 3)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        values(spark.createDataFrame([("junk",)], "s string"), strict_timestamp(F.col("s")))


def test_calendar(spark):
    days = [datetime(2023, 11, 4, 13), datetime(2023, 11, 5), datetime(2023, 11, 6), None]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz").coalesce(1)
    parts = calendar_parts(F.col("t"), "t")
    assert values(df, *parts) == [
        (13, 4, 11, 5, 1), (0, 5, 11, 6, 1), (0, 6, 11, 0, 0), (None, None, None, None, 0)
    ]
    assert df.select(*parts).columns == [
        "t_hour", "t_day", "t_month", "t_dayofweek", "t_is_weekend"
    ]


def test_days_are_whole_periods_rounded_down(spark):
    end = datetime(2024, 1, 24, 1)
    starts = [datetime(2024, 1, 22, 23), datetime(2024, 1, 25, 6), end, None]
    df = spark.createDataFrame([(s,) for s in starts], "t timestamp_ntz").coalesce(1)
    got = values(df, days_between(F.col("t"), F.lit(end).cast("timestamp_ntz")))
    assert got == [1, -2, 0, None]


def test_discount_buckets(spark):
    cases = [(None, "unk"), (NAN, "unk"), (-1.0, "<5"), (0.0, "zero"), (4.99, "<5"), (5.0, "5-20"),
             (19.99, "5-20"), (20.0, "20-50"), (49.99, "20-50"), (50.0, "50+")]
    df = spark.createDataFrame(cases, "v double, want string")
    for want, got in values(df, "want", discount_bucket(number(df, "v"))):
        assert got == want


def test_active_window(spark):
    as_of, day = datetime(2023, 11, 5, 17), datetime(2023, 11, 5)
    before, after = datetime(2023, 11, 4), datetime(2023, 11, 6)
    rows = [(None, None, 1), (None, after, 1), (before, None, 1), (day, after, 1), (before, day, 1),
            (after, None, 0), (None, before, 0), (datetime(2023, 11, 5, 9), None, 0)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    flag = active_flag(F.col("a"), F.col("b"), F.lit(as_of).cast("timestamp_ntz"))
    for want, got in values(df, "want", flag):
        assert got == want


def test_scores(spark):
    df = spark.createDataFrame([(0.5, 0.6), (0.51, None)], "a double, b double").coalesce(1)
    assert values(df, blend(F.col("a"), F.col("b"))) == [pytest.approx(0.53), 0.51]
    assert values(df, blend(F.col("a"))) == [0.5, 0.51]
    assert values(df, hard_label(F.col("a"))) == [0, 1]
    assert values(df, min_max(F.col("a"), F.lit(0.5), F.lit(0.5)))[0] == 0.0


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.5)], "y int, p double")
    (got,) = values(df.agg(log_loss(F.col("y"), F.col("p")).alias("l")), "l")
    assert got == pytest.approx(0.6931471805599453 / 3, abs=1e-12)
    wrong = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert 30 < values(wrong.agg(log_loss(F.col("y"), F.col("p")).alias("l")), "l")[0] < 40


def test_folds_are_stable_and_even(spark):
    df = spark.range(5000).select("id", fold_of(F.col("id"), 5).alias("fold"))
    sizes = dict(df.groupBy("fold").count().collect())
    assert sorted(sizes) == [0, 1, 2, 3, 4] and min(sizes.values()) > 850
    again = spark.range(5000).repartition(3).select("id", fold_of(F.col("id"), 5).alias("fold"))
    assert df.exceptAll(again).isEmpty()


def test_dates_compare_with_datetimes(spark):
    df = spark.createDataFrame([(date(2024, 1, 23),), (date(2024, 1, 24),)], "d date").coalesce(1)
    assert values(df, F.col("d") >= F.lit(datetime(2024, 1, 24))) == [False, True]
