import math

import pytest
from pyspark.sql import Row

from labelkit.operators import profile as P


def test_histogram_rules(spark):
    rows = [Row(a=float(v), c=7, n=None if v % 5 == 0 else v) for v in range(0, 101)]
    df = spark.createDataFrame(rows, "a double, c int, n int")
    h = {(r.column, r.bin): r for r in P.histogram(df, ["a", "c", "n", "missing"], bins=20).collect()}
    # x = max goes to the last bin
    assert h[("a", 19)]["count"] == 6  # 95..100
    assert sum(r["count"] for (c, _), r in h.items() if c == "a") == 101
    # constant column: one bin, width 1, all rows
    const = [r for (c, _), r in h.items() if c == "c"]
    assert len(const) == 1 and const[0].bin == 0 and const[0].width == 1.0 and const[0]["count"] == 101
    # nulls are reported, not binned; counts + nulls = rows
    ns = [r for (c, _), r in h.items() if c == "n"]
    assert ns[0].n_null == 21 and sum(r["count"] for r in ns) + ns[0].n_null == 101
    assert all(c != "missing" for c, _ in h)


def test_histogram_dense_fills_empty_bins(spark):
    df = spark.createDataFrame([Row(x=0), Row(x=0), Row(x=100)])
    dense = P.histogram(df, ["x"], bins=20, dense=True).collect()
    assert [r.bin for r in dense] == list(range(20))
    assert [r["count"] for r in dense] == [2] + [0] * 18 + [1]
    assert dense[0].center == pytest.approx(2.5) and dense[19].center == pytest.approx(97.5)


def test_histogram_all_null_column_skipped(spark):
    df = spark.createDataFrame([Row(x=None), Row(x=None)], "x int")
    assert P.histogram(df, ["x"]).count() == 0


def test_correlation_constant_and_symmetry(spark):
    rows = [Row(a=float(i), b=float(2 * i + (i % 3)), k=1.0) for i in range(50)]
    df = spark.createDataFrame(rows)
    m = {(r.x, r.y): r.r for r in P.correlation(df, ["a", "b", "k"]).collect()}
    assert m[("a", "a")] == 1.0 and m[("k", "k")] == 1.0
    assert math.isnan(m[("a", "k")]) and math.isnan(m[("k", "b")])
    assert m[("a", "b")] == pytest.approx(m[("b", "a")]) and -1 <= m[("a", "b")] <= 1


def test_correlation_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    rows = [Row(a=float(i % 17), b=float((i * 7) % 11), c=float(i)) for i in range(300)]
    df = spark.createDataFrame(rows)
    cols = ["a", "b", "c"]
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(df)
    mat = Correlation.corr(vec, "v").head()[0].toArray()
    ours = {(r.x, r.y): r.r for r in P.correlation(df, cols).collect()}
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            assert ours[(x, y)] == pytest.approx(mat[i][j], abs=1e-12)


def test_correlation_needs_two_columns(spark):
    with pytest.raises(ValueError):
        P.correlation(spark.createDataFrame([Row(a=1)]), ["a"])


def test_summary_balance_minmax(spark):
    df = spark.createDataFrame([Row(label=1, v=3), Row(label=0, v=None), Row(label=0, v=9)])
    s = P.dataset_summary(df, keep_leakage=False).first()
    assert (s.rows, s.cols, s.keep_duration) == (3, 2, False) and s.generated_at
    bal = [tuple(r) for r in P.class_balance(df).collect()]
    assert bal == [(0, 2, "no"), (1, 1, "yes")]
    mm = P.column_min_max(df, ["v"]).first()
    assert (mm.min, mm.max, mm.n, mm.n_null) == (3.0, 9.0, 2, 1)


def test_correlation_with_nulls_uses_pairwise_rows(spark):
    rows = [Row(a=float(i), b=None if i % 4 == 0 else float((i * 3) % 7), c=float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r.x, r.y): r.r for r in P.correlation(df, ["a", "b", "c"]).collect()}
    import numpy as np

    pairs = [(r.a, r.b) for r in rows if r.b is not None]
    want = np.corrcoef([p[0] for p in pairs], [p[1] for p in pairs])[0, 1]
    assert m[("a", "b")] == pytest.approx(want, abs=1e-12)
    want_ac = np.corrcoef([r.a for r in rows], [r.c for r in rows])[0, 1]
    assert m[("a", "c")] == pytest.approx(want_ac, abs=1e-12)


def test_histogram_constant_column_counts_null_rows(spark):
    # the original counts every row into a constant column's one bin
    df = spark.createDataFrame([Row(c=4), Row(c=4), Row(c=None)], "c int")
    (r,) = P.histogram(df, ["c"]).collect()
    assert (r.bin, r["count"], r.width, r.n_bins, r.n_null) == (0, 3, 1.0, 1, 1)
