"""M1–M8, M11 on one assembled matrix: features are fitted once, classifiers many times.

A training run fits many classifiers on the same features: three baselines,
the grid points of two of them in every fold, their refits, and three ablations.
The feature stages depend on the training rows only, so they are fitted once for
the run and once per fold (a fold's own training rows decide them), and the
assembled vectors are written; every classifier then reads a narrow table.

* :func:`fit_features` — the stages with a *bounded* indexer: the categories
  are counted by :func:`category_index`, and a column that is too wide raises by
  name before any category reaches the driver;
* :func:`cross_validate` — hash folds; all candidates of all folds are scored in
  one aggregation of (candidate, fold, label, prediction) cells;
* :func:`sliced_ablation` — the top fractions of base columns as slices of the
  written vectors, by their positions in the layout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.functions.exprs import hash_bucket
from labelkit.functions.local import local_table
from labelkit.operators import models as MD
from labelkit.operators.features import FEATURES, category_index, preprocess_stages
from labelkit.session import stored

#: Largest number of categories of a column, and of bytes of their text, that a model takes over.
MAX_CATEGORIES = 100_000
MAX_CATEGORY_BYTES = 16 << 20

#: Rows that all fits running at once hold together (a few hundred bytes each).
FITS_ROWS = 8_000_000


def bounded_indexers(
    train: DataFrame,
    cat_cols: Sequence[str],
    max_categories: int = MAX_CATEGORIES,
    max_bytes: int = MAX_CATEGORY_BYTES,
) -> list[StringIndexerModel]:
    """M1 — a fitted indexer for each of ``cat_cols``: most frequent category first, ties alphabetical.

    Equal to what ``StringIndexer`` fits, but the categories stay on the
    executors until every column is known to lie within the bounds."""
    index = category_index(train, cat_cols, materialize=True)
    widths = index.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category")).alias("bytes")
    )
    for r in widths.orderBy("column").collect():  # one row per categorical column
        if r["n"] > max_categories or r["bytes"] > max_bytes:
            raise ValueError(
                f"column {r['column']!r} has {r['n']} categories ({r['bytes']} bytes); "
                f"a model takes at most {max_categories} ({max_bytes} bytes)"
            )
    labels = {c: [] for c in cat_cols}
    for r in index.orderBy("column", "index").select("column", "category").collect():  # within the bounds
        labels[r["column"]].append(r["category"])
    return [
        StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")
        for c in cat_cols
    ]


def fit_features(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], **bounds) -> PipelineModel:
    """M1–M4 — the fitted feature stages."""
    stages = preprocess_stages(cat_cols, num_cols)
    if not cat_cols:
        return Pipeline(stages=stages).fit(train)
    indexers = PipelineModel(stages=bounded_indexers(train, cat_cols, **bounds))
    rest = Pipeline(stages=stages[1:]).fit(indexers.transform(train))
    return PipelineModel(stages=[*indexers.stages, *rest.stages])


def assembled(features: PipelineModel, rows: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Label, weight, ``keep`` and the vector of every row, written once."""
    columns = [c for c in ("label", "weight", *keep) if c in rows.columns]
    return stored(features.transform(rows).select(*columns, FEATURES), name)


@dataclass
class TrainingMatrix:
    """Fitted feature stages and the assembled rows of both sides of a split."""

    features: PipelineModel
    layout: list[tuple[str, str]]
    train: DataFrame
    test: DataFrame

    def pipeline(self, model) -> PipelineModel:
        """A classifier fitted on the matrix, with the feature stages before it."""
        return PipelineModel(stages=[*self.features.stages, model])


def training_matrix(
    train: DataFrame, test: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], keep: Sequence[str] = ()
) -> TrainingMatrix:
    features = fit_features(train, cat_cols, num_cols)
    return TrainingMatrix(
        features,
        MD.feature_layout(features, cat_cols, num_cols),
        assembled(features, train, "matrix-train"),
        assembled(features, test, "matrix-test", keep),
    )


def fit_on_matrix(name: str, estimator, matrix: TrainingMatrix, tuned: bool = False, auc: str = "exact") -> MD.Run:
    """M12 — fit a classifier on the assembled training rows and evaluate it on the test rows."""
    model = estimator.fit(matrix.train)
    metrics, cells = MD.evaluate_with_cells(model.transform(matrix.test), auc=auc)
    return MD.Run(name, tuned, metrics, matrix.pipeline(model), cells)


def in_threads(work, items: Sequence, threads: int) -> list:
    """The results of ``work`` on every item, in order; up to ``threads`` of them run at once."""
    with ThreadPool(max(1, threads)) as pool:
        return pool.map(work, items, chunksize=1)


def fits_at_once(rows: DataFrame) -> int:
    """How many fits on ``rows`` share the cluster: on few rows a fit is many short jobs that leave
    most cores idle; on many rows it fills the cluster, and its binned rows fill the memory."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores, FITS_ROWS // max(1, rows.count())))


def fit_all(learners: Sequence[tuple], matrix: TrainingMatrix, tuned: bool = False, auc: str = "exact") -> list[MD.Run]:
    """M12 — a run of every (name, estimator), in order."""
    return in_threads(lambda one: fit_on_matrix(*one, matrix, tuned, auc), learners, fits_at_once(matrix.train))


def rounds(name: str, params: dict) -> int:
    """How many jobs a fit runs one after the other, roughly: iterations times levels."""
    settings = {**MD.LEARNERS[name].baseline, **params}
    return settings.get("maxIter", 1) * (1 if name == "LogisticRegression" else settings.get("maxDepth", 5))


def holder(candidates: Sequence[tuple[str, dict]], i: int) -> int:
    """The candidate whose fit holds the model of candidate ``i``: boosting adds its trees one by one, so
    a boosted model is the first trees of one that differs by more iterations alone; else ``i`` itself."""
    if candidates[i][0] != "GBT":
        return i
    settings = [{**MD.LEARNERS[name].baseline, **params} for name, params in candidates]

    def rest(j):
        return candidates[j][0], {name: value for name, value in settings[j].items() if name != "maxIter"}

    if "validationIndicatorCol" in settings[i]:  # ends by what the later trees gain
        return i
    alike = [j for j in range(len(candidates)) if rest(j) == rest(i)]
    longest = max(alike, key=lambda j: settings[j]["maxIter"])
    return longest if settings[longest]["maxIter"] > settings[i]["maxIter"] else i


def fold_of(keys: Sequence[str], folds: int):
    """The fold of a row: md5 bucket of its key columns, so that it never moves with partitioning."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return hash_bucket(F.concat_ws("\x1f", F.lit("fold"), *text), folds)


def weighted_f1_of_cells(cells: dict[tuple[int, int], int]) -> float:
    """Mean of the classes' F1, weighted by their rows; ``cells`` is {(label, prediction): rows}."""
    rows = sum(cells.values())
    total = 0.0
    for c in {label for label, _ in cells}:
        hit = cells.get((c, c), 0)
        actual = sum(n for (label, _), n in cells.items() if label == c)
        called = sum(n for (_, prediction), n in cells.items() if prediction == c)
        total += actual / rows * (2 * hit / (actual + called))
    return total


def grid_points(name: str, grids: dict | None = None) -> list[dict]:
    """The parameter settings of a model's grid, last parameter fastest."""
    grid = (grids or {}).get(name, MD.LEARNERS[name].grid)
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def cross_validate(
    train: DataFrame,
    keys: Sequence[str],
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    candidates: Sequence[tuple[str, dict]],
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
) -> DataFrame:
    """M7 — ``(candidate, model, params, f1)``: weighted F1 of every candidate, averaged over the folds.

    At least ``parallelism`` fits run at once, more on few rows.  Per fold the features are fitted once on the other folds' rows.  The
    validation rows of a fold are scored by all candidates in one projection,
    and the cells of all folds come from one aggregation (at most four rows per
    candidate and fold).  Boosted candidates that differ by their iterations alone are one fit
    (:func:`holder`), each scored by its own model."""
    spark = train.sparkSession
    marked = train.withColumn("_fold", fold_of(keys, folds))

    def prepare(fold):
        inside, outside = marked.filter(F.col("_fold") != fold), marked.filter(F.col("_fold") == fold)
        features = fit_features(inside, cat_cols, num_cols)
        fit_rows = assembled(features, inside, "fold-train")
        return fit_rows, assembled(features, outside, "fold-check").select("label", FEATURES)

    sides = in_threads(prepare, range(folds), parallelism)

    def fit(point):
        fold, i = point
        name, params = candidates[i]
        return MD.make_estimator(name, seed, **params).fit(sides[fold][0])

    # the fits of all folds share the cluster, those of the most rounds first: no fold waits for another's last
    holders = [holder(candidates, i) for i in range(len(candidates))]
    points = sorted(product(range(folds), sorted(set(holders))), key=lambda p: -rounds(*candidates[p[1]]))
    threads = max(parallelism, fits_at_once(sides[0][0])) if folds else 1
    fitted = dict(zip(points, in_threads(fit, points, threads)))
    scored = []
    for fold, (_, check_rows) in enumerate(sides):
        for i in range(len(candidates)):
            model = fitted[fold, holders[i]]
            if holders[i] != i:
                model = MD.first_trees(model, candidates[i][1].get("maxIter", MD.LEARNERS["GBT"].baseline["maxIter"]))
            only = model.copy().setPredictionCol(f"_p{i}").setRawPredictionCol("").setProbabilityCol("")
            check_rows = only.transform(check_rows)
        calls = F.array(
            *[F.struct(F.lit(i).alias("candidate"), F.col(f"_p{i}").alias("prediction")) for i in range(len(candidates))]
        )
        scored.append(check_rows.select(F.lit(fold).alias("fold"), "label", F.inline(calls)))
    every_fold = reduce(DataFrame.unionByName, scored)
    cells: dict[tuple[int, int], dict] = {}
    for r in every_fold.groupBy("candidate", "fold", "label", "prediction").count().collect():
        held = cells.setdefault((r["candidate"], r["fold"]), {})
        held[int(r["label"]), int(r["prediction"])] = r["count"]
    rows = []
    for i, (name, params) in enumerate(candidates):
        scores = [weighted_f1_of_cells(cells[i, f]) for f in range(folds) if (i, f) in cells]
        text = ", ".join(f"{p}={v}" for p, v in params.items())
        rows.append((i, name, text, math.fsum(scores) / len(scores) if scores else 0.0))
    return local_table(spark, rows, "candidate int, model string, params string, f1 double")


def tune_on_matrix(
    names: Sequence[str],
    train: DataFrame,
    keys: Sequence[str],
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    matrix: TrainingMatrix,
    grids: dict | None = None,
    overrides: dict | None = None,
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
    auc: str = "exact",
) -> tuple[list[MD.Run], DataFrame]:
    """M7 — the best grid point of each model refitted on all training rows, and the table of all points.

    All models' candidates share the folds' features.  The first of equal
    scores wins."""
    candidates = [
        (name, {**(overrides or {}).get(name, {}), **point}) for name in names for point in grid_points(name, grids)
    ]
    table = cross_validate(train, keys, cat_cols, num_cols, candidates, folds, parallelism, seed)
    scores = [r["f1"] for r in table.orderBy("candidate").collect()]  # one row per grid point
    learners = []
    for name in names:
        own = [i for i, (n, _) in enumerate(candidates) if n == name]
        best = max(own, key=lambda i: (scores[i], -i))
        learners.append((name, MD.make_estimator(name, seed, **candidates[best][1])))
    runs = fit_all(learners, matrix, True, auc)
    return runs, table


def sliced_ablation(
    run: MD.Run,
    ranked: DataFrame,
    matrix: TrainingMatrix,
    fractions: Sequence[float] = (1.0, 0.8, 0.6),
    seed: int = 42,
    auc: str = "exact",
) -> DataFrame:
    """M11 — the chosen model refitted on the top fractions of base columns: slices of the same vectors.

    ``ranked`` has ``(feature, rank)`` for every base column."""
    order = [r["feature"] for r in ranked.orderBy("rank").collect()]  # one row per base column

    def refit(fraction):
        selected = set(order[: math.ceil(fraction * len(order))])
        places = [i for i, (_, column) in enumerate(matrix.layout) if column in selected]
        slicer = VectorSlicer(inputCol=FEATURES, outputCol="_sliced", indices=places)
        narrow = [
            slicer.transform(side).drop(FEATURES).withColumnRenamed("_sliced", FEATURES)
            for side in (matrix.train, matrix.test)
        ]
        model = MD.ablation_estimator(run, seed).fit(narrow[0])
        m = MD.evaluate(model.transform(narrow[1]), auc=auc)
        return (float(fraction), len(selected), *[m[c] for c in MD.METRIC_COLS], run.name, run.tuned)

    rows = in_threads(refit, fractions, fits_at_once(matrix.train))
    return local_table(matrix.train.sparkSession, rows, MD._ABLATION_SCHEMA)
