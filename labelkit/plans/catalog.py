"""Query catalogue behind ``__spark_entry__``: Spark queries and DuckDB twins.

Every query reads the test tables (through the derived ``contacts`` table) so
its work grows with them.  Doubles that are results of division or
floating-point accumulation are rounded on both sides (9 decimals for ratios
and correlations, 6 for larger values); counts are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.operators import clean as C
from labelkit.operators import profile as P
from labelkit.sources.contacts import contacts, with_contacts_cte
from labelkit.spec import CONTACTS

SPEC = CONTACTS
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
#: Queries of fitted figures, which have no SQL form.
FITTED: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if sql is None:
            FITTED[name] = fn
        else:
            QUERIES[name] = fn
            ORACLE[name] = with_contacts_cte(sql)
        return fn

    return deco


def cleaned(spark: SparkSession, sf_dir: str, keep_leakage: bool = False) -> DataFrame:
    return C.clean(contacts(spark, sf_dir), SPEC, keep_leakage=keep_leakage)


# ---- SQL fragments ----------------------------------------------------------

CLEAN_SELECT = """
SELECT contact_id, age, job, education, balance, day, month_no,
       least(campaign, 5) AS campaign, least(previous, 10) AS previous,
       poutcome, y,
       CAST(CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS INT) AS prev_contacted,
       CAST(CASE WHEN pdays = -1 THEN 0 ELSE pdays END AS INT) AS pdays_clean,
       CAST(CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS INT) AS label
FROM contacts
"""

CLEAN_KEEP_SELECT = """
SELECT contact_id, age, job, education, balance, day, month_no, duration,
       least(campaign, 5) AS campaign, least(previous, 10) AS previous,
       poutcome, y,
       CAST(CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS INT) AS prev_contacted,
       CAST(CASE WHEN pdays = -1 THEN 0 ELSE pdays END AS INT) AS pdays_clean,
       CAST(CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS INT) AS label
FROM contacts
"""


def cte(body: str, **extra: str) -> str:
    """``cleaned`` (and more named CTEs) before a final SELECT."""
    parts = [f"cleaned AS ({CLEAN_SELECT})"] + [f"{k} AS ({v})" for k, v in extra.items()]
    return ", " + ",\n".join(parts) + "\n" + body


def register_clean(name: str, body: str, **extra: str):
    """Register with SQL that sees a ``cleaned`` CTE after ``contacts``."""

    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        sql = with_contacts_cte("")  # "WITH contacts AS (...)\n"
        ORACLE[name] = sql.rstrip("\n") + cte(body, **extra)
        return fn

    return deco


# ---- P1–P8, P15 -------------------------------------------------------------


@register("clean_contacts", CLEAN_SELECT)
def q_clean_contacts(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("keep_leakage_column", CLEAN_KEEP_SELECT)
def q_keep_leakage(spark, sf_dir):
    return cleaned(spark, sf_dir, keep_leakage=True)


@register(
    "cap_values",
    "SELECT contact_id, least(campaign, 5) AS campaign, least(previous, 10) AS previous FROM contacts",
)
def q_cap_values(spark, sf_dir):
    df = contacts(spark, sf_dir).select("contact_id", "campaign", "previous")
    return C.cap_values(df, SPEC.caps)


@register(
    "sentinel_flag",
    "SELECT contact_id, pdays, CAST(CASE WHEN pdays = -1 THEN 0 ELSE 1 END AS INT) AS prev_contacted FROM contacts",
)
def q_sentinel_flag(spark, sf_dir):
    df = contacts(spark, sf_dir).select("contact_id", "pdays")
    return C.add_sentinel_flag(df, "pdays", -1, "prev_contacted")


@register(
    "sentinel_replace",
    "SELECT contact_id, pdays, CAST(CASE WHEN pdays = -1 THEN 0 ELSE pdays END AS INT) AS pdays_clean FROM contacts",
)
def q_sentinel_replace(spark, sf_dir):
    df = contacts(spark, sf_dir).select("contact_id", "pdays")
    return C.add_sentinel_replace(df, "pdays", -1, "pdays_clean")


@register(
    "label_encode",
    "SELECT contact_id, y, CAST(CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS INT) AS label FROM contacts",
)
def q_label_encode(spark, sf_dir):
    return C.add_label(contacts(spark, sf_dir).select("contact_id", "y"), SPEC)


def _feature_query(pdays_features: str, sql_cols: str):
    def fn(spark, sf_dir):
        return C.select_features(cleaned(spark, sf_dir), SPEC, pdays_features=pdays_features)

    return fn, f"SELECT contact_id, job, education, poutcome, {sql_cols}, label FROM cleaned"


for _name, _choice, _cols in [
    ("feature_select_both", "both", "age, balance, day, month_no, campaign, previous, pdays_clean, prev_contacted"),
    ("feature_select_drop_clean", "drop_pdays_clean", "age, balance, day, month_no, campaign, previous, prev_contacted"),
    ("feature_select_drop_flag", "drop_prev_contacted", "age, balance, day, month_no, campaign, previous, pdays_clean"),
]:
    _fn, _body = _feature_query(_choice, _cols)
    register_clean(_name, _body)(_fn)

from labelkit.streaming.scoring import PREDICTION_FIELDS  # noqa: E402


@register_clean(
    "project_available",
    "SELECT age, job, education, balance, day, campaign, pdays_clean, previous, poutcome, y, prev_contacted FROM cleaned",
)
def q_project_available(spark, sf_dir):
    return C.project_available(cleaned(spark, sf_dir), PREDICTION_FIELDS)


# ---- G1–G3, G5–G8 -----------------------------------------------------------


@register("dataset_summary", """
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(14 AS INT) AS cols, false AS keep_duration
FROM contacts
""")
def q_dataset_summary(spark, sf_dir):
    return P.dataset_summary(cleaned(spark, sf_dir), keep_leakage=False, with_timestamp=False)


@register_clean("class_balance", """
SELECT label, CAST(count(*) AS BIGINT) AS "count",
       CASE WHEN label = 0 THEN 'no' WHEN label = 1 THEN 'yes' END AS label_name
FROM cleaned GROUP BY label ORDER BY label
""")
def q_class_balance(spark, sf_dir):
    return P.class_balance(cleaned(spark, sf_dir))


def _minmax_sql(cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\", "
        f"CAST(count({c}) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM cleaned"
        for c in cols
    )


MINMAX_COLS = ["age", "balance", "day", "campaign", "previous", "pdays_clean"]


@register_clean("column_min_max", _minmax_sql(MINMAX_COLS))
def q_column_min_max(spark, sf_dir):
    return P.column_min_max(cleaned(spark, sf_dir), MINMAX_COLS)


HIST_COLS = list(SPEC.histogram_columns())


def _hist_sql(dense: bool) -> str:
    unpivot = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM cleaned" for c in HIST_COLS
    )
    stats = """
SELECT "column", min(value) AS mn, max(value) AS mx,
       CAST(count(*) - count(value) AS BIGINT) AS n_null,
       CASE WHEN min(value) = max(value) THEN 1 ELSE 20 END AS n_bins,
       CASE WHEN min(value) = max(value) THEN 1.0 ELSE (max(value) - min(value)) / 20.0 END AS width
FROM vals GROUP BY "column" HAVING min(value) IS NOT NULL
"""
    counts = """
SELECT v."column",
       CAST(CASE WHEN s.mn = s.mx THEN 0
                 WHEN v.value = s.mx THEN s.n_bins - 1
                 ELSE least(floor((v.value - s.mn) / s.width), s.n_bins - 1) END AS INT) AS bin,
       count(*) AS cnt
FROM vals v JOIN stats s ON v."column" = s."column"
WHERE v.value IS NOT NULL
GROUP BY 1, 2
"""
    if dense:
        base = """
SELECT g."column", CAST(g.bin AS INT) AS bin, coalesce(c.cnt, 0) AS cnt
FROM (SELECT "column", unnest(range(n_bins)) AS bin FROM stats) g
LEFT JOIN counts c ON c."column" = g."column" AND c.bin = g.bin
"""
    else:
        base = "SELECT \"column\", bin, cnt FROM counts"
    body = f"""
SELECT b."column", b.bin, CAST(b.cnt AS BIGINT) AS "count",
       round(s.mn + (b.bin + 0.5) * s.width, 6) AS center,
       round(s.width, 6) AS width, s.mn AS "min", s.mx AS "max", s.n_bins, s.n_null
FROM ({base}) b JOIN stats s ON b."column" = s."column"
ORDER BY 1, 2
"""
    return body, {"vals": unpivot, "stats": stats, "counts": counts}


def _rounded_hist(df: DataFrame) -> DataFrame:
    return df.withColumns({"center": F.round("center", 6), "width": F.round("width", 6)})


_b, _x = _hist_sql(False)


@register_clean("histogram_sparse", _b, **_x)
def q_histogram_sparse(spark, sf_dir):
    return _rounded_hist(P.histogram(cleaned(spark, sf_dir), HIST_COLS, bins=20))


_b, _x = _hist_sql(True)


@register_clean("histogram_dense", _b, **_x)
def q_histogram_dense(spark, sf_dir):
    return _rounded_hist(P.histogram(cleaned(spark, sf_dir), HIST_COLS, bins=20, dense=True))


CORR_COLS = list(SPEC.features(False, "both")[1]) + ["label"]


def _corr_sql() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, CAST(1.0 AS DOUBLE) AS r")
            else:
                r = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9)"
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, CAST({r} AS DOUBLE) AS r FROM cleaned")
    return "\nUNION ALL\n".join(parts)


@register_clean("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf_dir):
    df = P.correlation(cleaned(spark, sf_dir), CORR_COLS)
    return df.withColumn("r", F.round("r", 9))


# ---- A1–A3, G4, P12 ---------------------------------------------------------

from labelkit.operators import split as S  # noqa: E402

KEY = SPEC.key
BUCKET_SQL = "(('0x' || substr(md5(CAST(contact_id AS VARCHAR)), 1, 8))::BIGINT % 10000)"
TRAIN_SQL = f"SELECT * FROM cleaned WHERE {BUCKET_SQL} < 8000"
TEST_SQL = f"SELECT * FROM cleaned WHERE {BUCKET_SQL} >= 8000"


@register_clean("split_hash_train", TRAIN_SQL)
def q_split_hash_train(spark, sf_dir):
    return S.hash_split(cleaned(spark, sf_dir), KEY)[0]


@register_clean(
    "split_anti_join_test",
    "SELECT c.* FROM cleaned c WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.contact_id = c.contact_id)",
    train=TRAIN_SQL,
)
def q_split_anti_join_test(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    train, _ = S.hash_split(df, KEY)
    return S.anti_join(df, train, KEY)


@register_clean("split_counts", f"""
SELECT CAST(count(*) FILTER (WHERE {BUCKET_SQL} < 8000) AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (WHERE {BUCKET_SQL} >= 8000) AS BIGINT) AS test_rows,
       CAST(count(*) FILTER (WHERE {BUCKET_SQL} < 8000 AND label = 0) AS BIGINT) AS train_neg,
       CAST(count(*) FILTER (WHERE {BUCKET_SQL} < 8000 AND label = 1) AS BIGINT) AS train_pos,
       CAST(count(*) FILTER (WHERE {BUCKET_SQL} >= 8000 AND label = 0) AS BIGINT) AS test_neg,
       CAST(count(*) FILTER (WHERE {BUCKET_SQL} >= 8000 AND label = 1) AS BIGINT) AS test_pos
FROM cleaned
""")
def q_split_counts(spark, sf_dir):
    return S.split_counts(cleaned(spark, sf_dir), KEY)


@register_clean(
    "sample_by_label",
    'SELECT label, count(*) AS "rows", true AS plausible FROM cleaned GROUP BY label',
)
def q_sample_by_label(spark, sf_dir):
    # A1: which rows a Bernoulli sample draws depends on partitioning; their number per label
    # must lie within six standard deviations of its mean
    df = cleaned(spark, sf_dir).select(KEY, "label")
    drawn = S.stratified_sample(df, fraction=0.8, seed=42).groupBy("label").agg(F.count("*").alias("drawn"))
    counts = df.groupBy("label").agg(F.count("*").alias("rows")).join(drawn, "label", "left")
    off = F.abs(F.coalesce("drawn", F.lit(0)) - F.col("rows") * 0.8)
    return counts.select("label", "rows", (off <= F.sqrt(F.col("rows") * 0.16) * 6).alias("plausible"))


@register_clean("sample_by_label_hash", """
SELECT * FROM cleaned
WHERE label IN (0, 1) AND ('0x' || substr(md5('42:' || CAST(contact_id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 8000
""")
def q_sample_by_label_hash(spark, sf_dir):
    return S.stratified_hash_sample(cleaned(spark, sf_dir), KEY, fraction=0.8, seed=42)


@register_clean("class_weights", """
SELECT label, n, round(total / (2.0 * n), 9) AS weight FROM (
  SELECT 0 AS label, CAST(count(*) FILTER (WHERE label = 0) AS BIGINT) AS n,
         count(*) FILTER (WHERE label IN (0, 1)) AS total FROM train
  UNION ALL
  SELECT 1 AS label, CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n,
         count(*) FILTER (WHERE label IN (0, 1)) AS total FROM train)
""", train=TRAIN_SQL)
def q_class_weights(spark, sf_dir):
    train, _ = S.hash_split(cleaned(spark, sf_dir), KEY)
    return S.class_weight_table(train).withColumn("weight", F.round("weight", 9))


@register_clean("weighted_rows", f"""
SELECT c.contact_id, c.label,
       CASE WHEN {BUCKET_SQL} < 8000 THEN 'train' ELSE 'test' END AS split,
       round(CASE WHEN c.label = 0 THEN w.total / (2.0 * w.n0) ELSE w.total / (2.0 * w.n1) END, 9) AS weight
FROM cleaned c, (SELECT count(*) FILTER (WHERE label = 0) AS n0,
                        count(*) FILTER (WHERE label = 1) AS n1,
                        count(*) FILTER (WHERE label IN (0, 1)) AS total FROM train) w
""", train=TRAIN_SQL)
def q_weighted_rows(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    weights = S.check_split(S.split_counts(df, KEY).first())  # one bounded row back
    tagged = S.assign_split(df.select(KEY, "label"), KEY)
    return S.add_class_weight(tagged, weights).withColumn("weight", F.round("weight", 9))


# ---- G9–G12 over a fixed linear score ---------------------------------------

from labelkit.functions.exprs import linear_score, linear_score_sql  # noqa: E402
from labelkit.operators import metrics as M  # noqa: E402

# fixed values: the deterministic score the metric queries evaluate
SCORE_WEIGHTS = [
    ("age", 0.02),
    ("campaign", -0.15),
    ("previous", 0.05),
    ("prev_contacted", 0.4),
    ("balance", 0.0001),
    ("day", -0.01),
]
SCORE_INTERCEPT = -0.9
SCORE_SQL = linear_score_sql(SCORE_WEIGHTS, SCORE_INTERCEPT)
SCORED_SQL = f"""
SELECT contact_id, label, {SCORE_SQL} AS score,
       CASE WHEN {SCORE_SQL} > 0 THEN 1 ELSE 0 END AS prediction
FROM cleaned
"""


def scored(spark, sf_dir) -> DataFrame:
    s = linear_score(SCORE_WEIGHTS, SCORE_INTERCEPT)
    return cleaned(spark, sf_dir).select(
        KEY, "label", s.alias("score"), F.when(s > 0, 1).otherwise(0).alias("prediction")
    )


@register_clean("confusion_matrix", """
SELECT l AS label, p AS prediction,
       CAST((SELECT count(*) FROM scored s WHERE s.label = g.l AND s.prediction = g.p) AS BIGINT) AS "count"
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(l, p)
""", scored=SCORED_SQL)
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(scored(spark, sf_dir))


CELLS_SQL = """
SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
       count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn
FROM scored
"""
METRICS_SQL = """
SELECT round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 9) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 9) AS "precision",
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 9) AS recall,
       round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1,
       round(CAST(tn + fp AS DOUBLE) / (tp + fp + fn + tn) * coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0)
           + CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn) * coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 9)
         AS weighted_f1
FROM cells
"""


def _round_all(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) for c in df.columns])


@register_clean("classification_metrics", METRICS_SQL, scored=SCORED_SQL, cells=CELLS_SQL)
def q_classification_metrics(spark, sf_dir):
    return _round_all(M.classification_metrics(scored(spark, sf_dir)))


@register_clean(
    "weighted_f1",
    "SELECT weighted_f1 FROM (" + METRICS_SQL + ")",
    scored=SCORED_SQL,
    cells=CELLS_SQL,
)
def q_weighted_f1(spark, sf_dir):
    return _round_all(M.weighted_f1(scored(spark, sf_dir)))


@register_clean("roc_auc", """
SELECT round(CAST(sum(pos * (neg_below + neg * 0.5)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS auc
FROM (
  SELECT pos, neg,
         coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM scored GROUP BY score))
""", scored=SCORED_SQL)
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(scored(spark, sf_dir), "score").withColumn("auc", F.round("auc", 9))


# ---- M1–M4 relational twins -------------------------------------------------

from labelkit.operators import features as FE  # noqa: E402

CATS = list(SPEC.categorical)
NUMS = SPEC.features(False, "drop_pdays_clean")[1]


def _cat_unpivot_sql(keep: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {keep}'{c}' AS \"column\", CAST({c} AS VARCHAR) AS category FROM cleaned" for c in CATS
    )


INDEX_SQL = """
SELECT "column", category, "count",
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, category ASC) - 1 AS INT) AS "index"
FROM (SELECT "column", category, CAST(count(*) AS BIGINT) AS "count" FROM cats
      WHERE category IS NOT NULL GROUP BY 1, 2)
"""


@register_clean("category_index", "SELECT * FROM idx", cats=_cat_unpivot_sql(), idx=INDEX_SQL)
def q_category_index(spark, sf_dir):
    return FE.category_index(cleaned(spark, sf_dir), CATS)


@register_clean("one_hot_slots", """
SELECT r.contact_id, r."column",
       CAST(coalesce(i."index", s.n_labels) AS INT) AS slot, CAST(s.n_labels + 1 AS INT) AS width
FROM rows_ r
LEFT JOIN idx i ON i."column" = r."column" AND i.category = r.category
JOIN (SELECT "column", count(*) AS n_labels FROM idx GROUP BY 1) s ON s."column" = r."column"
""", cats=_cat_unpivot_sql(), idx=INDEX_SQL, rows_=_cat_unpivot_sql("contact_id, "))
def q_one_hot_slots(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return FE.one_hot_slots(df, FE.category_index(df, CATS, materialize=True), CATS, KEY)


def _scale_sql() -> str:
    cols = ", ".join(
        f"round(CASE WHEN stddev_samp(CAST({c} AS DOUBLE)) OVER () = 0 THEN 0.0 "
        f"ELSE CAST({c} AS DOUBLE) / stddev_samp(CAST({c} AS DOUBLE)) OVER () END, 6) AS {c}"
        for c in NUMS
    )
    return f"SELECT contact_id, {cols} FROM train"


@register_clean("scale_numeric", _scale_sql(), train=TRAIN_SQL)
def q_scale_numeric(spark, sf_dir):
    train, _ = S.hash_split(cleaned(spark, sf_dir), KEY)
    std = FE.numeric_std(train, NUMS)
    out = FE.scale_numeric(train, NUMS, std, keep=[KEY])
    return out.select(KEY, *[F.round(c, 6).alias(c) for c in NUMS])


def _assemble_sql() -> tuple[str, dict[str, str]]:
    # block offsets in declared order: sum of (n_labels + 1) of earlier columns
    decl = " UNION ALL ".join(f"SELECT '{c}' AS col, {i} AS pos" for i, c in enumerate(CATS))
    num_parts = "\nUNION ALL\n".join(
        f"SELECT contact_id, CAST((SELECT sum(width) FROM blocks) + {j} AS INT) AS position, "
        f"round(CAST({c} AS DOUBLE) / (SELECT sd_{j} FROM sds), 6) AS value FROM cleaned "
        f"WHERE CAST({c} AS DOUBLE) / (SELECT sd_{j} FROM sds) <> 0"
        for j, c in enumerate(NUMS)
    )
    sds = ", ".join(f"stddev_samp(CAST({c} AS DOUBLE)) AS sd_{j}" for j, c in enumerate(NUMS))
    extras = {
        "cats": _cat_unpivot_sql(),
        "idx": INDEX_SQL,
        "rows_": _cat_unpivot_sql("contact_id, "),
        "decl": decl,
        "blocks": """SELECT s."column", s.n_labels + 1 AS width, d.pos FROM
           (SELECT "column", count(*) AS n_labels FROM idx GROUP BY 1) s JOIN decl d ON d.col = s."column\"""",
        "offs": """SELECT "column", coalesce(sum(width) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM blocks""",
        "sds": f"SELECT {sds} FROM cleaned",
        "slots": """SELECT r.contact_id, r."column", coalesce(i."index", s.n_labels) AS slot
  FROM rows_ r LEFT JOIN idx i ON i."column" = r."column" AND i.category = r.category
  JOIN (SELECT "column", count(*) AS n_labels FROM idx GROUP BY 1) s ON s."column" = r."column\"""",
    }
    body = f"""
SELECT contact_id, CAST(o.off + slot AS INT) AS position, 1.0 AS value
FROM slots JOIN offs o ON o."column" = slots."column"
UNION ALL
{num_parts}
"""
    return body, extras


_b, _x = _assemble_sql()


@register_clean("assemble_entries", _b, **_x)
def q_assemble_entries(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    idx = FE.category_index(df, CATS, materialize=True)
    std = FE.numeric_std(df, NUMS)
    out = FE.assembled_entries(df, idx, CATS, NUMS, std, KEY)
    return out.withColumn("value", F.round("value", 6))


# parts 2 and 3 register sources, streaming, models, rankings and messy input into the same tables
from labelkit.plans import catalog_io, catalog_messy, catalog_runs  # noqa: E402,F401
