"""Inputs that the test tables do not hold: bad numbers, constants, odd strings, null scores."""

import math

import pytest
from pyspark.sql import functions as F

from labelkit.functions.exprs import lenient_int
from labelkit.operators import metrics as M
from labelkit.operators import profile as P
from labelkit.sources import files as IO
from labelkit.sources import messages as MS


def test_out_of_range_numbers_become_null(spark):
    df = spark.createDataFrame([(99999999999, float("nan")), (7, 7.9)], "a bigint, b double")
    got = df.select(lenient_int("a", df.schema["a"].dataType), lenient_int("b", df.schema["b"].dataType)).collect()
    assert [tuple(r) for r in got] == [(None, None), (7, 7)]


def test_replay_counts(spark):
    df = spark.range(3)
    assert [MS.repeat_rows(df, n).count() for n in (0, 1, 3)] == [0, 3, 9]
    with pytest.raises(ValueError):
        MS.repeat_rows(df, -1)


def test_constant_column_has_no_correlation(spark):
    df = spark.range(20).select((F.lit(0.1)).alias("c"), F.col("id").cast("double").alias("x"))
    got = {(r.x, r.y): r.r for r in P.correlation(df, ["c", "x"]).collect()}
    assert math.isnan(got["c", "x"]) and got["c", "c"] == 1.0


def test_csv_gives_strings_back(spark, tmp_dir):
    rows = [(" a ", 'q"q', ""), (None, "x;y", "z ")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    IO.write_delimited(df, f"{tmp_dir}/csv")
    got = sorted((tuple(r) for r in IO.read_by_header(spark, f"{tmp_dir}/csv").collect()), key=repr)
    assert [r[:2] for r in got] == sorted((r[:2] for r in rows), key=repr)


def test_columns_bind_by_header(spark, tmp_dir):
    df = spark.createDataFrame([(1000, 33)], "balance int, age int")
    IO.write_delimited(df, f"{tmp_dir}/swapped")
    assert IO.read_by_header(spark, f"{tmp_dir}/swapped").first().age == "33"


def test_null_scores_count_as_missed(spark):
    rows = [(1.0, 1)] * 4 + [(-1.0, 1)] * 2 + [(None, 1)] * 2 + [(-1.0, 0)] * 4 + [(None, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert M.threshold_summary(df, "score").first().recall == pytest.approx(0.5)
