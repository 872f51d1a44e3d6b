"""End-to-end jobs (profile report, training, streaming) with tiny settings."""

from labelkit.plans import inference as INF
from labelkit.plans import profiling as PR
from labelkit.plans import training as TR
from labelkit.session import scratch_path
from labelkit.sources.contacts import contacts
from labelkit.sources.messages import read_metadata
from labelkit.spec import CONTACTS

from conftest import SF_SMALL

TINY = {
    "LogisticRegression": {"maxIter": 5},
    "RandomForest": {"numTrees": 3, "maxDepth": 3},
    "GBT": {"maxIter": 3, "maxDepth": 2},
}
TINY_GRIDS = {
    "LogisticRegression": {"regParam": [0.0, 0.1]},
    "RandomForest": {"maxDepth": [2, 3]},
    "GBT": {"maxIter": [2, 3]},
}


def test_profile_report(spark):
    out = scratch_path(spark, "t-report")
    rep = PR.run_profile(contacts(spark, SF_SMALL), CONTACTS, out, pdays_features="drop_pdays_clean")
    summary = spark.read.option("header", True).csv(f"{out}/dataset_summary").first()
    assert int(summary["rows"]) == contacts(spark, SF_SMALL).count() and summary["cols"] == "14"
    hist = spark.read.option("header", True).csv(f"{out}/histograms")
    assert hist.select("column").distinct().count() == 3
    corr = rep.correlation.collect()
    n = len(CONTACTS.features(False, "drop_pdays_clean")[1]) + 1
    assert len(corr) == n * n


def test_training_and_streaming_jobs(spark):
    rep = scratch_path(spark, "t-train-report")
    art = scratch_path(spark, "t-artifacts")
    raw = contacts(spark, SF_SMALL)
    res = TR.run_training(
        raw, CONTACTS, rep, art, pdays_features="drop_pdays_clean",
        overrides=TINY, grids=TINY_GRIDS, folds=2,
    )
    board = res.leaderboard.collect()
    assert len(board) == 5 and sum(r.tuned for r in board) == 2
    best = max(board, key=lambda r: (r.f1, r.auc))
    assert (best.model, best.tuned) == (res.best.name, res.best.tuned)
    abl = res.ablation.collect()
    assert [r.fraction for r in abl] == [1.0, 0.8, 0.6]
    assert [r.num_features for r in abl] == [10, 8, 6]
    meta = read_metadata(spark, f"{art}/metadata")
    assert meta["chosen_model"] == res.best.name and meta["pdays_features"] == "drop_pdays_clean"
    assert sum(r["count"] for r in res.confusion.collect()) > 0

    # streaming: publish the table twice, score with the saved model, read the feed
    base = scratch_path(spark, "t-infer")
    INF.publish(spark, CONTACTS, f"{base}/in", frame=raw, times=2, max_records_per_file=500)
    q = INF.start_scoring(
        spark, CONTACTS, art, f"{base}/ckpt",
        source={"fmt": "text", "path": f"{base}/in", "max_per_trigger": 2},
        sink={"fmt": "text", "path": f"{base}/out"},
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    feed = INF.feed(spark, f"{base}/out")
    assert feed.count() == 2 * raw.count()
    assert feed.filter("predicted_label IS NULL OR p1 IS NULL").count() == 0
