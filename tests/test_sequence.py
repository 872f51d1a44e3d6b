"""The range-partitioned numbering must equal the plain window on any layout."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelkit.operators.sequence import sequence_within_groups
from labelkit.sources.contacts import derive_contacts

from conftest import SF_CHECK


def _collect(df, cols):
    """Rows as text, so that NaN equals NaN and times beyond pandas' range compare."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in cols]
    return sorted(tuple(r) for r in df.select(*shown).collect())


def _windowed(df, sort_cols, levels, lags):
    at = {
        name: Window.partitionBy(*group).orderBy(*[c for c in sort_cols if c not in group])
        for name, group in levels.items()
    }
    out = df.withColumns({name: F.row_number().over(w) for name, w in at.items()})
    return out.withColumns({o: F.lag(src, 1).over(at[level]) for o, (src, level) in lags.items()})


def _skewed(spark):
    rnd = random.Random(9)
    rows = []
    t0 = datetime(2024, 1, 1)
    for i in range(3000):
        # one hot group with about a third of all rows, a null group, ties in time
        g = 1 if i % 3 == 0 else (None if i % 97 == 0 else rnd.randint(2, 40))
        ts = t0 + timedelta(days=rnd.randint(0, 800))
        rows.append((i, g, ts, rnd.choice(["F", "O", "P"])))
    return spark.createDataFrame(rows, "k long, g long, ts timestamp, s string").withColumn(
        "yr", F.year("ts")
    )


@pytest.mark.parametrize("parts", [1, 3, 13, None])
def test_equals_window_on_skewed_groups(spark, parts):
    df = _skewed(spark)
    args = dict(
        sort_cols=["g", "ts", "k"],
        levels={"rn": ["g"], "rn_y": ["g", "yr"]},
        lags={"prev_ts": ("ts", "rn"), "prev_s": ("s", "rn"), "prev_s_y": ("s", "rn_y")},
    )
    # the year orders like the time, so it may lead the key (finer groups need it there)
    args["sort_cols"] = ["g", "yr", "ts", "k"]
    cols = ["k", "rn", "rn_y", "prev_ts", "prev_s", "prev_s_y"]
    got = sequence_within_groups(df, num_partitions=parts, **args)
    assert got.columns == [*df.columns, "rn", "rn_y", "prev_ts", "prev_s", "prev_s_y"]
    assert _collect(got, cols) == _collect(_windowed(df, **args), cols)


@pytest.mark.parametrize("parts", [1, 7])
def test_nan_null_and_late_times_behave_as_in_a_window(spark, parts):
    df = spark.sql(
        """SELECT id AS k, CASE WHEN id % 4 = 0 THEN double('NaN') WHEN id % 4 = 1 THEN NULL ELSE 1.5D END AS g,
                  CASE WHEN id % 5 = 0 THEN double('NaN') WHEN id % 5 = 1 THEN NULL ELSE double(id % 3) END AS x,
                  CASE WHEN id % 2 = 0 THEN timestamp'9999-12-31 23:59:59' ELSE timestamp'0001-01-02 00:00:00' END AS t,
                  array(id, NULL) AS a
           FROM range(200)"""
    )
    args = dict(
        sort_cols=["g", "x", "k"],
        levels={"rn": ["g"]},
        lags={"lag_x": ("x", "rn"), "lag_t": ("t", "rn"), "lag_a": ("a", "rn")},
    )
    cols = ["k", "rn", "lag_x", "lag_t", "lag_a"]
    got = sequence_within_groups(df, num_partitions=parts, **args)
    assert _collect(got, cols) == _collect(_windowed(df, **args), cols)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, g long")
    out = sequence_within_groups(df, ["g", "k"], {"rn": ["g"]}, {"prev": ("k", "rn")})
    assert out.columns == ["k", "g", "rn", "prev"] and out.collect() == []


def test_contacts_equal_the_window_form(spark):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    customer = spark.read.parquet(f"{SF_CHECK}/customer.parquet")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    year = Window.partitionBy("o_custkey", F.year("o_orderdate")).orderBy("o_orderdate", "o_orderkey")
    want = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("contact_id"),
        F.row_number().over(year).alias("campaign"),
        (F.row_number().over(w) - 1).alias("previous"),
        F.coalesce(F.datediff("o_orderdate", F.lag("o_orderdate").over(w)), F.lit(-1)).alias("pdays"),
        F.coalesce(F.lag("o_orderstatus").over(w), F.lit("unknown")).alias("poutcome"),
    )
    assert _collect(derive_contacts(spark, SF_CHECK), want.columns) == _collect(want, want.columns)


def _brute(rows):
    """Row number and lag per group by sorting in Python (None sorts first)."""
    def k(v):
        return (v is not None, v if v is not None else 0)

    out = {}
    ordered = sorted(rows, key=lambda r: (k(r[1]), r[2], r[0]))
    prev_g, n, prev_v = object(), 0, None
    for key, g, t, v in ordered:
        if g != prev_g:
            n, prev_v = 0, None
        n += 1
        out[key] = (n, prev_v)
        prev_g, prev_v = g, v
    return out


@pytest.mark.parametrize("seed,parts", [(1, 2), (2, 5), (3, 11)])
def test_matches_brute_force(spark, seed, parts):
    rnd = random.Random(seed)
    rows = []
    for i in range(1500):
        g = rnd.choice([None, 1, 1, 1, 2, 3, rnd.randint(4, 30)])
        rows.append((i, g, rnd.randint(0, 40), rnd.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, "k long, g long, t long, v string")
    out = sequence_within_groups(
        df, ["g", "t", "k"], {"rn": ["g"]}, {"lag_v": ("v", "rn")}, num_partitions=parts
    )
    got = {r.k: (r.rn, r.lag_v) for r in out.collect()}
    assert got == _brute(rows)
