"""Catalogue part 2: sources/sinks, messages, streaming, models, rankings.

Imported by :mod:`labelkit.plans.catalog` (registers into the same tables).
Streaming queries run a real Structured Streaming job (file source → sink,
``availableNow``) over messages derived from the test tables and return what
the sink holds.  Model queries fit MLlib pipelines on the hash split of the
contacts table.  Fitted numbers have no SQL form, so these queries return what
SQL can tell (keys, labels, counts, passed-through fields) beside a flag that a
second way gives the same numbers: the model as a table walked by joins for
probabilities and labels, its nodes for importances, confusion cells for
metrics.  The figures themselves are in ``training_run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from labelkit.functions.local import local_table
from labelkit.functions.exprs import linear_score, linear_score_sql
from labelkit.operators import matrix as MX
from labelkit.operators import metrics as M
from labelkit.operators import model_table as MT
from labelkit.operators import models as MD
from labelkit.operators import profile as P
from labelkit.operators import split as S
from labelkit.plans.catalog import (
    BUCKET_SQL,
    CLEAN_SELECT,
    KEY,
    SPEC,
    cleaned,
    register,
    register_clean,
)
from labelkit.session import scratch_path, table_path
from labelkit.sources import files as IO
from labelkit.sources import messages as MS
from labelkit.sources.contacts import contacts
from labelkit.streaming import scoring as ST

RAW_SELECT = "SELECT * FROM contacts"
CLEAN_NO_LABEL = CLEAN_SELECT.replace(
    ",\n       CAST(CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS INT) AS label", ""
)

# ---- S2, S5: CSV round trip --------------------------------------------------


@register("csv_roundtrip", RAW_SELECT)
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    IO.write_delimited(contacts(spark, sf_dir), path, sep=";")
    return IO.read_delimited(spark, path, SPEC, sep=";")


@register("report_table_sink", """
SELECT label, CAST(count(*) AS BIGINT) AS "count",
       CASE WHEN label = 0 THEN 'no' WHEN label = 1 THEN 'yes' END AS label_name
FROM (SELECT CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label FROM contacts) GROUP BY label
""")
def q_report_table_sink(spark, sf_dir):
    path = scratch_path(spark, "report")
    IO.write_table(P.class_balance(cleaned(spark, sf_dir)), path, fmt="csv", single_file=True)
    return spark.read.schema("label int, count bigint, label_name string").option(
        "header", True
    ).csv(path)


# ---- S6, S7, T1, P11: messages ------------------------------------------------


@register("json_encode_decode", RAW_SELECT)
def q_json_encode_decode(spark, sf_dir):
    msgs = MS.to_messages(contacts(spark, sf_dir), SPEC)
    return MS.decode_messages(msgs, SPEC)


@register("json_props_decode", """
SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_props_decode(spark, sf_dir):
    events = spark.read.parquet(table_path(sf_dir, "events")).select("event_id", "event_type", "props")
    schema = StructType([StructField("k", IntegerType(), True)])
    parsed = F.from_json(F.col("props"), schema)
    return events.select("event_id", "event_type", parsed.alias("p")).select(
        "event_id", "event_type", "p.k"
    )


@register("repeat_rows", """
SELECT c.*, CAST(r.copy AS INT) AS copy FROM contacts c, (SELECT unnest(range(1, 4)) AS copy) r
""")
def q_repeat_rows(spark, sf_dir):
    return MS.repeat_rows(contacts(spark, sf_dir), 3)


@register("metadata_roundtrip", """
SELECT 'drop_pdays_clean' AS pdays_features, false AS keep_duration,
       CAST(count(*) AS BIGINT) AS "rows"
FROM contacts
""")
def q_metadata_roundtrip(spark, sf_dir):
    # Write run metadata (row count from the data), read it back, resolve settings
    n = cleaned(spark, sf_dir).count()
    path = scratch_path(spark, "metadata")
    MS.write_metadata(
        spark, path, {"keep_duration": False, "pdays_features": "drop_pdays_clean", "rows": n}
    )
    meta = MS.read_metadata(spark, path)
    keep, features = MS.stream_settings(meta, keep_duration_flag=True)
    return spark.read.json(path).select(
        F.lit(features).alias("pdays_features"),
        F.lit(keep).alias("keep_duration"),
        F.col("rows").cast("bigint").alias("rows"),
    )


# ---- T1, T3, T6: streaming cleaning -----------------------------------------


# a stream's input comes in this many batches, in files of at most so many messages
_BATCHES, _MESSAGES = 4, 100_000
# lines of text in scratch folders, each file read by one task
_PACKED = {"compression": "gzip"}


def _write_input(messages: DataFrame, path: str) -> int:
    """Write a stream's input in files of the table's own partitions, without a shuffle; returns how
    many files make a batch."""
    per_file = max(1, min(_MESSAGES, -(-messages.count() // _BATCHES)))
    MS.write_messages(messages, path, options=_PACKED, max_records_per_file=per_file)
    files = len(messages.sparkSession.read.text(path).inputFiles())
    return max(1, -(-files // _BATCHES))


def _publish(spark, sf_dir, name: str, frame: DataFrame | None = None) -> tuple[str, int]:
    """Write contact messages as JSON lines for a stream; its folder and the files of a batch."""
    base = scratch_path(spark, name)
    df = frame if frame is not None else contacts(spark, sf_dir)
    return base, _write_input(MS.to_messages(df, SPEC), f"{base}/in")


def clean_through_stream(spark, messages: DataFrame, name: str) -> DataFrame:
    """What a stream that decodes and cleans ``messages`` leaves in its sink."""
    base = scratch_path(spark, name)
    per_trigger = _write_input(messages, f"{base}/in")
    raw = ST.read_stream(spark, "text", f"{base}/in", max_per_trigger=per_trigger)
    out = ST.clean_stream(ST.add_ingest_time(MS.decode_messages(raw, SPEC)), SPEC)
    q = ST.write_stream(
        out, f"{base}/ckpt", fmt="parquet", path=f"{base}/out", trigger={"availableNow": True}
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_clean", CLEAN_NO_LABEL)
def q_stream_clean(spark, sf_dir):
    messages = MS.to_messages(contacts(spark, sf_dir), SPEC)
    return clean_through_stream(spark, messages, "stream_clean").drop("ingest_ts")


@register("stream_decode", RAW_SELECT)
def q_stream_decode(spark, sf_dir):
    # T1/P11 on a stream: JSON lines → typed columns, written by a file sink
    base, per_trigger = _publish(spark, sf_dir, "stream_decode")
    raw = ST.read_stream(spark, "text", f"{base}/in", max_per_trigger=per_trigger)
    q = ST.write_stream(
        MS.decode_messages(raw, SPEC), f"{base}/ckpt", fmt="parquet", path=f"{base}/out",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ---- models -------------------------------------------------------

CATS, NUMS = SPEC.features(False, "drop_pdays_clean")


def _split(spark, sf_dir, materialize: bool = False):
    return S.split_with_weights(cleaned(spark, sf_dir), KEY, materialize=materialize)


SCORED_TEST_SQL = f"SELECT contact_id, label, true AS consistent FROM cleaned WHERE {BUCKET_SQL} >= 8000"


def _predict(name: str):
    def fn(spark, sf_dir):
        train, test, _ = _split(spark, sf_dir, materialize=True)
        matrix = MX.training_matrix(train, test, CATS, NUMS, keep=[KEY])
        model = MD.make_estimator(name).fit(matrix.train)
        pred = MD.add_prediction_columns(model.transform(matrix.test)).select(KEY, "label", "p1", "predicted_label")
        # the same rows scored without MLlib: relational features, the model as a table
        entries = MT.feature_entries(train, test, CATS, NUMS, KEY)
        own = MT.score_entries(MT.export_model(spark, model), entries, KEY)
        own = own.select(KEY, F.col("p1").alias("own_p1"), F.col("predicted_label").alias("own_label"))
        on_edge = F.abs(F.col("p1") - 0.5) < 1e-9  # a tie of votes: the sums' last bit decides the label
        agrees = (F.abs(F.col("p1") - F.col("own_p1")) < 1e-9) & (on_edge | (F.col("predicted_label") == F.col("own_label")))
        return pred.join(own, KEY, "left").select(KEY, "label", F.coalesce(agrees, F.lit(False)).alias("consistent"))

    return fn


register_clean("lr_predict", SCORED_TEST_SQL)(_predict("LogisticRegression"))
register_clean("rf_predict", SCORED_TEST_SQL)(_predict("RandomForest"))
register_clean("gbt_predict", SCORED_TEST_SQL)(_predict("GBT"))


def _checked_runs(spark, runs) -> DataFrame:
    """One row per run: its test set as its confusion cells show it, and whether its metrics follow from them."""
    rows = []
    for run in runs:
        tp, fp, fn, tn = (run.cells[c] for c in ("tp", "fp", "fn", "tn"))
        whole = tp + fp + fn + tn
        want = {
            "accuracy": (tp + tn) / whole,
            "precision": tp / (tp + fp) if tp + fp else 0.0,
            "recall": tp / (tp + fn) if tp + fn else 0.0,
            "f1": 2 * tp / (2 * tp + fp + fn) if tp else 0.0,
        }
        follows = all(abs(run.metrics[m] - v) < 1e-12 for m, v in want.items()) and 0 <= run.metrics["auc"] <= 1
        rows.append((run.name, run.tuned, tp + fn, whole, follows))
    return local_table(spark, rows, "model string, tuned boolean, positives bigint, test_rows bigint, consistent boolean")


def _runs_sql(*runs: tuple[str, bool]) -> str:
    names = ", ".join(f"('{name}', {str(tuned).lower()})" for name, tuned in runs)
    return f"""
SELECT model, tuned, count(*) FILTER (WHERE label = 1) AS positives, count(*) AS test_rows, true AS consistent
FROM (VALUES {names}) r(model, tuned), cleaned WHERE {BUCKET_SQL} >= 8000 GROUP BY model, tuned
"""


@register_clean("model_leaderboard", _runs_sql(*[(n, False) for n in MD.MODEL_NAMES]))
def q_model_leaderboard(spark, sf_dir):
    train, test, _ = _split(spark, sf_dir, materialize=True)
    matrix = MX.training_matrix(train, test, CATS, NUMS)
    runs = MX.fit_all(MD.baselines(), matrix)
    order = {(r["model"], r["tuned"]): i for i, r in enumerate(MD.rank_runs(MD.leaderboard(spark, runs)).collect())}
    return _checked_runs(spark, sorted(runs, key=lambda r: order[r.name, r.tuned]))


@register_clean("cv_tuned", _runs_sql(("LogisticRegression", True)))
def q_cv_tuned(spark, sf_dir):
    train, test, _ = _split(spark, sf_dir, materialize=True)
    matrix = MX.training_matrix(train, test, CATS, NUMS)
    runs, _ = MX.tune_on_matrix(["LogisticRegression"], train, [KEY], CATS, NUMS, matrix)
    return _checked_runs(spark, runs)


def _gbt_run(spark, sf_dir):
    train, test, _ = _split(spark, sf_dir, materialize=True)
    matrix = MX.training_matrix(train, test, CATS, NUMS)
    return MX.fit_on_matrix("GBT", MD.make_estimator("GBT"), matrix), matrix


@register("importance_by_column", " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS is_share" for c in [*CATS, *NUMS]))
def q_importance_by_column(spark, sf_dir):
    run, matrix = _gbt_run(spark, sf_dir)
    imp = MD.base_importance(run.model, matrix.train, CATS, NUMS)
    # one row per declared column: importances are shares of one, and the model's nodes give the same
    nodes = MT.export_model(spark, run.model.stages[-1])
    own = MT.column_importances(nodes, matrix.layout).select(F.col("column").alias("feature"), F.col("importance").alias("own"))
    whole = F.sum("importance").over(Window.partitionBy())
    share = (F.col("importance") >= 0) & (F.abs(whole - 1) < 1e-9) & (F.abs(F.col("importance") - F.col("own")) < 1e-9)
    return imp.join(own, "feature", "left").select("feature", F.coalesce(share, F.lit(False)).alias("is_share"))


@register("ablation_table", f"""
SELECT CAST(f AS DOUBLE) AS fraction, CAST(ceil(f * {len(CATS) + len(NUMS)}) AS INTEGER) AS num_features,
       'GBT' AS model_name, false AS tuned, true AS consistent
FROM (VALUES (1.0), (0.8), (0.6)) v(f)
""")
def q_ablation_table(spark, sf_dir):
    run, matrix = _gbt_run(spark, sf_dir)
    imp = MD.base_importance(run.model, matrix.train, CATS, NUMS, include_missing=False)
    table = MX.sliced_ablation(run, MD.rank_features(imp, CATS, NUMS), matrix)
    p, r = F.col("precision"), F.col("recall")
    mean = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    shares = F.array(*MD.METRIC_COLS)
    follows = (F.abs(F.col("f1") - mean) < 1e-9) & F.forall(shares, lambda m: m.between(0, 1))
    return table.select("fraction", "num_features", "model_name", "tuned", follows.alias("consistent"))


@register_clean("model_roundtrip", f"SELECT contact_id, label, true AS same FROM cleaned WHERE {BUCKET_SQL} >= 8000")
def q_model_roundtrip(spark, sf_dir):
    train, test, _ = _split(spark, sf_dir)
    model = MD.build_pipeline(MD.make_estimator("LogisticRegression"), CATS, NUMS).fit(train)
    path = MD.save_model(model, scratch_path(spark, "model"))
    saved = MD.add_prediction_columns(model.transform(test)).select(*test.columns, F.col("p1").alias("_saved_p1"))
    pred = MD.add_prediction_columns(MD.load_model(path).transform(saved))
    return pred.select(KEY, "label", (F.col("p1") == F.col("_saved_p1")).alias("same"))


# ---- T2, T4, T5, T7, T8, S8: scoring stream -----------------------

_STREAM_RUNS: dict[tuple[str, str], tuple[str, list]] = {}


def _scoring_stream(spark, sf_dir) -> tuple[str, DataFrame]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STREAM_RUNS:
        base, progress = _STREAM_RUNS[key]
        return base, progress
    train, test, _ = _split(spark, sf_dir)
    model = MD.build_pipeline(MD.make_estimator("LogisticRegression"), CATS, NUMS).fit(train)
    base, per_trigger = _publish(spark, sf_dir, "stream_score", frame=contacts(spark, sf_dir))
    q = ST.score_stream(
        spark,
        model,
        SPEC,
        checkpoint=f"{base}/ckpt",
        source={"fmt": "text", "path": f"{base}/in", "max_per_trigger": per_trigger},
        sink={"fmt": "text", "path": f"{base}/out", "options": _PACKED},
        pdays_features="drop_pdays_clean",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    progress = ST.progress_table(spark, q).collect()
    _STREAM_RUNS[key] = (base, progress)
    return base, progress


_PASSED = {
    "age": "int", "job": "string", "education": "string", "balance": "int", "day": "int", "campaign": "int",
    "previous": "int", "poutcome": "string", "y": "string", "prev_contacted": "int",
}


def _is_scored():
    agrees = F.col("predicted_label") == (F.col("p1") > 0.5).cast("int")
    return F.coalesce(F.col("ingest_ts").isNotNull() & F.col("p1").between(0, 1) & agrees, F.lit(False))


@register_clean("stream_score", f"SELECT {', '.join(_PASSED)}, true AS scored FROM cleaned")
def q_stream_score(spark, sf_dir):
    base, _ = _scoring_stream(spark, sf_dir)
    fields = ", ".join(f"{c} {t}" for c, t in _PASSED.items())
    value = F.from_json("value", f"{fields}, ingest_ts timestamp, predicted_label int, p1 double")
    return spark.read.text(f"{base}/out").select(value.alias("m")).select("m.*").select(
        *_PASSED, _is_scored().alias("scored")
    )


@register_clean("prediction_feed", "SELECT age, job, true AS scored FROM cleaned")
def q_prediction_feed(spark, sf_dir):
    base, _ = _scoring_stream(spark, sf_dir)
    return ST.read_predictions(spark, f"{base}/out").select("age", "job", _is_scored().alias("scored"))


@register("stream_progress", "SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS complete FROM contacts")
def q_stream_progress(spark, sf_dir):
    _, progress = _scoring_stream(spark, sf_dir)
    batches = local_table(spark, progress, ST._PROGRESS_SCHEMA)
    every = F.count_distinct("batch_id") == F.max("batch_id") + 1  # numbered from 0 without a gap
    return batches.agg(F.sum("input_rows").alias("input_rows"), every.alias("complete"))


# ---- O2, O3, O5 over a data-derived importance table ----------------------------
# importance of a numeric feature = |Pearson r| with the label (G8 output);
# categorical features are absent from it and so count as 0 (ranked by
# declared position), as the ranking rule requires.

RANK_NUMS = list(NUMS)


def _corr_importance(spark, sf_dir) -> DataFrame:
    corr = P.correlation(cleaned(spark, sf_dir), RANK_NUMS + ["label"])
    return corr.filter((F.col("y") == "label") & (F.col("x") != "label")).select(
        F.col("x").alias("feature"), F.round(F.abs("r"), 9).alias("importance")
    )


def _importance_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(abs(corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE))), 9) AS importance FROM cleaned"
        for c in RANK_NUMS
    )


def _declared_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS position" for i, c in enumerate(list(CATS) + RANK_NUMS)
    )


RANKED_SQL = """
SELECT d.feature, CAST(d.position AS INT) AS position, coalesce(i.importance, 0.0) AS importance,
       CAST(row_number() OVER (ORDER BY coalesce(i.importance, 0.0) DESC, d.position ASC) AS INT) AS "rank"
FROM decl d LEFT JOIN imp i ON i.feature = d.feature
"""


@register_clean("rank_features", RANKED_SQL, imp=_importance_sql(), decl=_declared_sql())
def q_rank_features(spark, sf_dir):
    return MD.rank_features(_corr_importance(spark, sf_dir), CATS, RANK_NUMS)


@register_clean(
    "top_features",
    "SELECT feature, importance FROM imp ORDER BY importance DESC, feature ASC LIMIT 5",
    imp=_importance_sql(),
)
def q_top_features(spark, sf_dir):
    return MD.top_features(_corr_importance(spark, sf_dir), k=5)


@register_clean(
    "top_fraction",
    f"SELECT * FROM ranked WHERE \"rank\" <= {-(-6 * (len(CATS) + len(RANK_NUMS)) // 10)}",
    imp=_importance_sql(),
    decl=_declared_sql(),
    ranked=RANKED_SQL,
)
def q_top_fraction(spark, sf_dir):
    ranked = MD.rank_features(_corr_importance(spark, sf_dir), CATS, RANK_NUMS)
    return MD.top_fraction(ranked, 0.6, len(CATS) + len(RANK_NUMS))


# ---- O4 over metric rows of fixed scorers ------------------------------------------

# fixed values: three deterministic scorers ranked like model runs
SCORERS = {
    "age_only": ([("age", 0.05)], -2.5),
    "recency": ([("prev_contacted", 1.0), ("previous", 0.1), ("campaign", -0.2)], -0.5),
    "mixed": ([("age", 0.02), ("campaign", -0.15), ("previous", 0.05), ("prev_contacted", 0.4),
               ("balance", 0.0001), ("day", -0.01)], -0.9),
}


def _scorer_metrics(spark, sf_dir) -> DataFrame:
    base = cleaned(spark, sf_dir)
    frames = []
    for name, (weights, b) in SCORERS.items():
        s = linear_score(weights, b)
        summary = M.threshold_summary(base.select("label", s.alias("score")), "score")
        frames.append(
            summary.select(
                F.lit(name).alias("model"), F.lit(False).alias("tuned"),
                F.round("f1", 9).alias("f1"), F.round("auc", 9).alias("auc"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _scorer_sql() -> str:
    parts = []
    for name, (weights, b) in SCORERS.items():
        expr = linear_score_sql(weights, b)
        parts.append(f"""
SELECT '{name}' AS model, false AS tuned,
       round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1,
       (SELECT round(CAST(sum(pos * (neg_below + neg * 0.5)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9)
        FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
              FROM (SELECT {expr} AS score, count(*) FILTER (WHERE label = 1) AS pos,
                           count(*) FILTER (WHERE label <> 1) AS neg FROM cleaned GROUP BY 1))) AS auc
FROM (SELECT count(*) FILTER (WHERE label = 1 AND {expr} > 0) AS tp,
             count(*) FILTER (WHERE label = 0 AND {expr} > 0) AS fp,
             count(*) FILTER (WHERE label = 1 AND NOT ({expr} > 0)) AS fn FROM cleaned)""")
    return "\nUNION ALL\n".join(parts)


@register_clean(
    "leaderboard_rank",
    "SELECT * FROM runs ORDER BY f1 DESC, auc DESC, model ASC LIMIT 2",
    runs=_scorer_sql(),
)
def q_leaderboard_rank(spark, sf_dir):
    return MD.rank_runs(_scorer_metrics(spark, sf_dir), k=2)
