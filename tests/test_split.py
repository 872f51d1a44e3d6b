import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from labelkit.operators import split as S


def _frame(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("label")
    )


def test_hash_split_disjoint_complete_stable(spark):
    df = _frame(spark)
    train, test = S.hash_split(df, "key")
    tr = {r.key for r in train.collect()}
    te = {r.key for r in test.collect()}
    assert not (tr & te) and len(tr | te) == 2000
    assert 0.75 < len(tr) / 2000 < 0.85
    tr2 = {r.key for r in S.hash_split(df.repartition(7), "key")[0].collect()}
    assert tr2 == tr  # unchanged under repartitioning


def test_anti_join_equals_hash_complement(spark):
    df = _frame(spark, 500)
    train, test = S.hash_split(df, "key")
    anti = S.anti_join(df, train, "key")
    assert sorted(r.key for r in anti.collect()) == sorted(r.key for r in test.collect())


def test_split_counts_and_guards(spark):
    df = _frame(spark)
    c = S.split_counts(df, "key").first()
    assert c.train_rows + c.test_rows == 2000
    assert c.train_pos + c.train_neg == c.train_rows
    w = S.check_split(c)
    assert w.w0 == pytest.approx(c.train_rows / (2 * c.train_neg))
    with pytest.raises(RuntimeError):
        S.check_split({"train_rows": 0, "test_rows": 1, "train_neg": 0, "train_pos": 0})
    with pytest.raises(RuntimeError):
        S.check_split({"train_rows": 5, "test_rows": 1, "train_neg": 5, "train_pos": 0})


def test_class_weights_table_and_column(spark):
    df = spark.createDataFrame([Row(label=0)] * 6 + [Row(label=1)] * 2)
    t = {r.label: r for r in S.class_weight_table(df).collect()}
    assert t[0].weight == pytest.approx(8 / 12) and t[1].weight == pytest.approx(2.0)
    w = S.ClassWeights(6, 2)
    out = S.add_class_weight(spark.createDataFrame([Row(label=0), Row(label=1), Row(label=None)], "label int"), w)
    assert [r.weight for r in out.collect()] == pytest.approx([8 / 12, 2.0, 2.0])


def test_stratified_sample_skips_other_labels(spark):
    df = spark.createDataFrame(
        [Row(label=0)] * 100 + [Row(label=1)] * 100 + [Row(label=None)] * 50 + [Row(label=2)] * 50,
        "label int",
    )
    s = S.stratified_sample(df, fraction=0.8, seed=42).collect()
    assert all(r.label in (0, 1) for r in s)
    assert 120 < len(s) < 200


def test_sample_split_disjoint_complete_weighted(spark):
    df = _frame(spark, 1000)
    train, test, w = S.sample_split_with_weights(df, "label", 0.8, 42)
    tr = [r.key for r in train.collect()]
    te = [r.key for r in test.collect()]
    assert not set(tr) & set(te) and len(tr) + len(te) == 1000 and len(set(tr)) == len(tr)
    n0 = sum(1 for r in train.collect() if r.label == 0)
    assert w.n0 == n0 and w.w0 == pytest.approx(len(tr) / (2 * n0))
    assert all(r.weight == pytest.approx(w.w1) for r in test.filter("label = 1").collect())
