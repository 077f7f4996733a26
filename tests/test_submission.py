"""Template match and submission layout."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom.operators import metrics
from clickloom.operators.submission import format_submission, match_template, usable


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_template(spark, hot_rows):
    template = spark.createDataFrame(
        [(0, "1", 1), (1, "1", 1), (2, "1", 2), (3, "2", 1), (4, "3", 3), (5, None, 3)],
        "n int, id2 string, id3 bigint").withColumn("pred", F.lit(9.0))
    predictions = spark.createDataFrame(
        [(1, 1, 1, 0.1), (3, 1, 1, 0.3), (2, 1, 1, 0.2), (1, 1, 2, None), (9, 8, 8, 0.8)],
        "pos int, id2 bigint, id3 bigint, pred double")
    got = match_template(template, predictions, "pos", hot_rows=hot_rows)
    assert {r["n"]: (r["pred"], r["matched"]) for r in got.collect()} == {
        0: (0.3, True), 1: (0.3, True), 2: (None, True), 3: (0.0, False), 4: (0.0, False),
        5: (0.0, False)}
    assert metrics.match_summary(got).first() == (6, 3)


def test_template_of_a_hot_key_is_spread_and_complete(spark):
    template = spark.range(900).select(
        "id", F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("id2"), F.lit(1).alias("id3"))
    predictions = spark.range(1, 800).select(
        F.lit(0).alias("pos"), F.col("id").alias("id2"), F.lit(1).alias("id3"),
        (F.col("id") / 1000).alias("pred"))
    got = match_template(template, predictions, "pos", hot_rows=10)
    assert metrics.match_summary(got).first() == (900, 800)
    assert got.where("id2 = 1 and pred = 0.001").count() == 600


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("a", 1, 2, date(2023, 11, 6), 0.5), ("0", 3, 4, None, 0.6), ("0.0", 5, None, None, 0.7),
         (None, 7, 8, date(2023, 1, 2), 0.8)],
        "id1 string, id2 bigint, id3 bigint, id5 date, pred double").coalesce(1)


def test_ids_and_dates_are_kept_where_usable(rows):
    got = format_submission(rows).collect()
    assert got[0] == ("a", 1, 2, "11/06/2023", 0.5)
    assert got[1] == ("3_4_16-23_2023-11-05", 3, 4, "11/05/2023", 0.6)
    assert got[2] == ("5_0_16-23_2023-11-05", 5, 0, "11/05/2023", 0.7)
    assert got[3][0] == "7_8_16-23_2023-11-05" and got[3][3] == "01/02/2023"


def test_ids_and_dates_are_rebuilt_where_zero(spark, rows):
    zeros = rows.withColumn("id1", F.lit(0)).withColumn("id5", F.lit(0))
    assert usable(zeros) == set() and usable(rows) == {"id1", "id5"}
    got = format_submission(zeros).collect()
    assert got[0] == ("1_2_16-23_2023-11-05", 1, 2, "11/05/2023", 0.5)
    bare = format_submission(rows.drop("id1", "id5")).collect()
    assert bare == got


def test_text_dates_and_bad_keys(spark):
    df = spark.createDataFrame([("a", "x", "7", "11/09/2023", 0.1), ("b", "2", None, "soon", 0.2)],
                               "id1 string, id2 string, id3 string, id5 string, pred double").coalesce(1)
    got = format_submission(df, date_formats=("MM/dd/yyyy",)).collect()
    assert got == [("a", 0, 7, "11/09/2023", 0.1), ("b", 2, 0, "11/05/2023", 0.2)]
