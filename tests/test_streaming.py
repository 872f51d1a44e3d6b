import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from labelkit.operators import features as FE
from labelkit.operators import models as MD
from labelkit.operators.clean import clean
from labelkit.session import scratch_path
from labelkit.sources import messages as MS
from labelkit.spec import CONTACTS
from labelkit.streaming import scoring as ST

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    from labelkit.sources.contacts import contacts

    df = clean(contacts(spark, SF_SMALL), CONTACTS)
    cats, nums = CONTACTS.features(False, "drop_pdays_clean")
    model = FE.build_pipeline(MD.make_estimator("LogisticRegression", maxIter=10, weight_col=None), cats, nums).fit(df)
    return model, contacts(spark, SF_SMALL)


def test_batch_scores_equal_stream_scores(spark, fitted):
    model, raw = fitted
    base = scratch_path(spark, "t-stream")
    MS.write_messages(MS.to_messages(raw, CONTACTS), f"{base}/in", max_records_per_file=400)
    q = ST.score_stream(
        spark, model, CONTACTS, f"{base}/ckpt",
        source={"fmt": "text", "path": f"{base}/in", "max_per_trigger": 1},
        sink={"fmt": "text", "path": f"{base}/out"},
        pdays_features="drop_pdays_clean", trigger={"availableNow": True},
    )
    q.awaitTermination()
    progress = ST.progress_table(spark, q).collect()
    assert len(progress) >= 2 and sum(r.input_rows for r in progress) == raw.count()
    streamed = [json.loads(r.value) for r in spark.read.text(f"{base}/out").collect()]
    batch = ST.score_frame(MS.to_messages(raw, CONTACTS), model, CONTACTS,
                           pdays_features="drop_pdays_clean", with_ingest_time=False)
    b = sorted((r.age, r.balance, r.day, r.predicted_label, round(r.p1, 12)) for r in batch.collect())
    s = sorted((m["age"], m["balance"], m["day"], m["predicted_label"], round(m["p1"], 12)) for m in streamed)
    assert b == s
    m0 = streamed[0]
    assert "ingest_ts" in m0 and "pdays_clean" not in m0 and "label" not in m0
    assert list(m0)[-3:] == ["ingest_ts", "predicted_label", "p1"]
    # restart on the same checkpoint: nothing new, no duplicate output
    q2 = ST.score_stream(
        spark, model, CONTACTS, f"{base}/ckpt",
        source={"fmt": "text", "path": f"{base}/in", "max_per_trigger": 1},
        sink={"fmt": "text", "path": f"{base}/out"},
        pdays_features="drop_pdays_clean", trigger={"availableNow": True},
    )
    q2.awaitTermination()
    assert spark.read.text(f"{base}/out").count() == raw.count()
    feed = ST.read_predictions(spark, f"{base}/out")
    assert feed.columns == ["ingest_ts", "predicted_label", "p1", "age", "job"]
    assert feed.filter(F.col("p1").isNull()).count() == 0


def test_null_numeric_feature_fails_scoring(spark, fitted):
    model, raw = fitted
    bad = spark.createDataFrame([Row(value=json.dumps({"age": None, "job": "x", "balance": 1}))])
    with pytest.raises(Exception):
        ST.score_frame(bad, model, CONTACTS, pdays_features="drop_pdays_clean").collect()


def test_p1_from_short_probability(spark):
    from pyspark.ml.linalg import Vectors

    from labelkit.functions.exprs import class_one_probability

    df = spark.createDataFrame([Row(probability=Vectors.dense([1.0])), Row(probability=Vectors.dense([0.3, 0.7]))])
    assert [r.p1 for r in df.select(class_one_probability("probability").alias("p1")).collect()] == [0.0, 0.7]


def test_encode_omits_nulls_keeps_order(spark):
    df = spark.createDataFrame([Row(p1=0.5, age=None, job="a", predicted_label=1)], "p1 double, age int, job string, predicted_label int")
    v = json.loads(ST.encode_predictions(df).first().value)
    assert list(v) == ["job", "predicted_label", "p1"]


def test_stream_input_keeps_the_tables_partitions_and_comes_in_batches(spark, monkeypatch):
    from labelkit.plans import catalog_io as CI

    monkeypatch.setattr(CI, "_MESSAGES", 50)
    base = scratch_path(spark, "t-input")
    messages = spark.range(0, 1000, 1, 2).select(F.col("id").cast("string").alias("value"))
    per_batch = CI._write_input(messages, f"{base}/in")
    held = spark.read.text(f"{base}/in")
    files = held.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("value").cast("int")).alias("low"), F.max(F.col("value").cast("int")).alias("high")
    ).collect()
    # files of neighbouring rows: nothing was shuffled
    assert len(files) == 20 and all(f.n == 50 and f.high - f.low == 49 for f in files)
    assert per_batch == 5
    few = spark.range(3).select(F.col("id").cast("string").alias("value"))
    assert CI._write_input(few, f"{base}/few") >= 1 and spark.read.text(f"{base}/few").count() == 3
    assert CI._write_input(few.limit(0), f"{base}/none") >= 1 and spark.read.text(f"{base}/none").count() == 0
