import math
import random

import pytest
from pyspark.sql import Row

from labelkit.functions.exprs import hash_bucket, linear_score, range_tile
from labelkit.operators import profile as P


@pytest.mark.parametrize("bounds", [[], [5.0], [1.0, 2.0, 3.0], [0.0, 10.0, 20.0, 30.0, 40.0]])
def test_range_tile_counts_bounds_at_or_below(spark, bounds):
    values = [-1e9, -1.0, 0.0, 1.0, 1.5, 2.0, 3.0, 5.0, 10.0, 25.0, 40.0, 1e9, float("nan")]
    df = spark.createDataFrame([Row(v=v) for v in values])
    got = [r.t for r in df.select(range_tile("v", bounds).alias("t")).collect()]
    # Spark orders NaN above every number, so it lands in the last tile
    want = [len(bounds) if math.isnan(v) else sum(b <= v for b in bounds) for v in values]
    assert got == want


def test_hash_bucket_range_and_determinism(spark):
    df = spark.range(500)
    b1 = [r.b for r in df.select(hash_bucket("id").alias("b")).collect()]
    b2 = [r.b for r in df.repartition(3).orderBy("id").select(hash_bucket("id").alias("b")).collect()]
    assert b1 == b2 and all(0 <= b < 10000 for b in b1)


def test_linear_score_order(spark):
    df = spark.createDataFrame([Row(a=2, b=3)])
    v = df.select(linear_score([("a", 0.5), ("b", -1.0)], 0.25).alias("s")).first().s
    assert v == ((0.25 + 0.5 * 2) + -1.0 * 3)


def _brute_hist(vals, bins=20):
    xs = [float(v) for v in vals if v is not None]
    mn, mx = min(xs), max(xs)
    if mn == mx:
        return {0: len(xs)}
    width = (mx - mn) / bins
    out = {}
    for x in xs:
        b = bins - 1 if x == mx else min(int(math.floor((x - mn) / width)), bins - 1)
        out[b] = out.get(b, 0) + 1
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_histogram_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 400
    cols = {
        "a": [rnd.randint(-500, 500) for _ in range(n)],
        "b": [None if rnd.random() < 0.1 else rnd.gauss(0, 3) for _ in range(n)],
        "c": [7] * n,
        "d": [rnd.choice([0.1, 0.2, 0.3]) for _ in range(n)],
    }
    rows = [Row(a=cols["a"][i], b=cols["b"][i], c=cols["c"][i], d=cols["d"][i]) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b double, c int, d double")
    got = {}
    for r in P.histogram(df, list(cols)).collect():
        got.setdefault(r.column, {})[r.bin] = r["count"]
    for c, vals in cols.items():
        assert got[c] == _brute_hist(vals), c


def test_local_table_round_trips_values(spark):
    from labelkit.functions.local import local_table

    rows = [("a'b", 1, 0.1, True, None), (None, -7, float("nan"), False, 1e-300), ("x", None, 1.2345678901234567e20, None, -0.0)]
    df = local_table(spark, rows, "s string, i bigint, d double, b boolean, e double")
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("a'b", 1, 0.1, True, None)
    assert got[1][0] is None and got[1][1] == -7 and math.isnan(got[1][2]) and got[1][4] == 1e-300
    assert got[2][2] == 1.2345678901234567e20 and got[2][3] is None
    assert local_table(spark, [], "s string").count() == 0
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "bigint", "double", "boolean", "double"]


@pytest.mark.parametrize("bounds", [[], [5.0], [1.0, 2.0, 3.0], [0.0, 10.0, 20.0, 30.0, 40.0]])
def test_with_tile_counts_bounds_at_or_below(spark, bounds):
    from labelkit.operators.prefix import with_tile

    values = [-math.inf, -1e9, -1.0, 0.0, 1.0, 1.5, 2.0, 3.0, 5.0, 10.0, 25.0, 40.0, 1e9, math.inf,
              float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r._tile for r in with_tile(df, "v", bounds).orderBy("i").collect()]
    # NaN (Spark's largest value) gets the tile after the last; null stays null
    want = [
        None if v is None else len(bounds) + 1 if math.isnan(v) else sum(b <= v for b in bounds)
        for v in values
    ]
    assert got == want


def test_with_tile_many_bounds_matches_bisect(spark):
    import bisect

    from labelkit.operators.prefix import with_tile

    rnd = random.Random(3)
    bounds = sorted({round(rnd.uniform(0, 1000), 3) for _ in range(3000)})
    values = [rnd.uniform(-10, 1010) for _ in range(2000)] + bounds[::7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r._tile for r in with_tile(df, "v", bounds).orderBy("i").collect()]
    assert got == [bisect.bisect_right(bounds, v) for v in values]
