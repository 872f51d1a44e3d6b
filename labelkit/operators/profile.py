"""Profiling tables, each a DataFrame (nothing collected).

* Histograms for all columns take two scans in total (min/max, then counts)
  instead of two jobs per column: the per-column min/max (one row per column,
  a bounded result) comes back once, every column is binned with literal
  bounds, and one ``groupBy(column, bin)`` counts with map-side partial
  aggregation.
* The correlation matrix is one aggregate of co-moments (``covar_samp``,
  ``stddev_samp``: numerically stable merge-able aggregates) — one pass,
  k(k−1)/2 pairs, then unpivoted into a long ``(x, y, r)`` table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from labelkit.functions.local import local_table
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_summary(
    df: DataFrame, keep_leakage: bool, with_timestamp: bool = True
) -> DataFrame:
    """G1 — rows, cols, keep_duration (and generation time)."""
    cols = [
        F.col("rows"),
        F.lit(len(df.columns)).cast("int").alias("cols"),
        F.lit(bool(keep_leakage)).alias("keep_duration"),
    ]
    if with_timestamp:
        cols.append(F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(*cols)


def class_balance(df: DataFrame, label: str = "label", names=("no", "yes")) -> DataFrame:
    """G2 — rows per label, ascending, with the label's name."""
    name = F.when(F.col(label) == 0, F.lit(names[0])).when(F.col(label) == 1, F.lit(names[1]))
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(label, "count", name.alias("label_name"))
        .orderBy(label)
    )


def _unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value double)`` rows; a narrow Generate, no shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs))


def column_min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """G3 — per column min, max, non-null and null counts (one pass)."""
    columns = [c for c in columns if c in df.columns]
    aggs = []
    for c in columns:
        aggs += [
            F.min(c).cast("double").alias(f"{c}__min"),
            F.max(c).cast("double").alias(f"{c}__max"),
            F.count(c).alias(f"{c}__n"),
        ]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__min").alias("min"),
                F.col(f"{c}__max").alias("max"),
                F.col(f"{c}__n").alias("n"),
                (F.col("__rows") - F.col(f"{c}__n")).alias("n_null"),
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(rows))


_HIST_STATS = "column string, min double, max double, n_null bigint, n_bins int, width double"


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 20, dense: bool = False
) -> DataFrame:
    """G5/G6 — equal-width histograms of several columns at once.

    width = (max − min) / bins; bin = floor((x − min) / width), x = max goes to
    the last bin (and any float round-up is clamped to it); a constant column
    gets one bin of width 1 that counts all rows, nulls included.  Columns
    with no value are skipped.  Otherwise nulls are not binned; they are
    reported in ``n_null``.  ``dense`` lists every bin (count 0 for empty
    ones).

    Two scans in all: one aggregate for every column's min/max (one row per
    column comes back), then one pass that bins all columns as literals and
    counts ``(column, bin)`` with map-side partial aggregation.
    """
    spark = df.sparkSession
    columns = [c for c in columns if c in df.columns]
    stats = []
    for r in column_min_max(df, columns).collect():  # bounded: one row per column
        if r["min"] is None:
            continue
        const = r["min"] == r["max"]
        n_bins = 1 if const else bins
        width = 1.0 if const else (r["max"] - r["min"]) / float(bins)
        stats.append((r["column"], r["min"], r["max"], r["n_null"], n_bins, width))
    stats_df = local_table(spark, stats, _HIST_STATS)
    if not stats:
        return stats_df.select("column", F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("count"),
                               F.lit(0.0).alias("center"), "width", "min", "max", "n_bins", "n_null")
    cells = []
    for c, mn, mx, _, n_bins, width in stats:
        x = F.col(c).cast("double")
        if n_bins == 1:
            # a constant column's one bin holds every row, nulls included
            b = F.lit(0)
        else:
            b = F.when(x == F.lit(mx), F.lit(n_bins - 1)).otherwise(
                F.least(F.floor((x - F.lit(mn)) / F.lit(width)), F.lit(n_bins - 1))
            )
            b = F.when(x.isNull(), F.lit(None)).otherwise(b)
        b = b.cast("int")
        cells.append(F.struct(F.lit(c).alias("column"), b.alias("bin")))
    counts = (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if dense:
        grid = stats_df.select(
            "column", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin")
        )
        counts = grid.join(counts, ["column", "bin"], "left").fillna(0, subset=["count"])
    # stats_df has one row per profiled column: broadcasting it is bounded
    out = counts.join(F.broadcast(stats_df), "column").select(
        "column",
        "bin",
        F.col("count").cast("bigint").alias("count"),
        (F.col("min") + (F.col("bin") + F.lit(0.5)) * F.col("width")).alias("center"),
        "width",
        "min",
        "max",
        "n_bins",
        "n_null",
    )
    return out.orderBy("column", "bin")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """G8 — Pearson correlation matrix as a long ``(x, y, r)`` table.

    A zero-variance column gives NaN off the diagonal and 1.0 on it (as the
    MLlib matrix does); Spark's own ``corr`` would raise DIVIDE_BY_ZERO under
    ANSI, hence the guarded division.  Needs at least two columns.

    Two scans, both inside whole-stage codegen: the column means and counts
    (one bounded row back), then the sums of *centred* products
    ``S_xy = Σ (x − x̄)(y − ȳ)`` — the stable two-pass form — and
    ``r = S_xy / sqrt(S_xx · S_yy)``.  A single pass of ``covar_samp`` per
    pair would need four buffer fields per pair, which for more than a few
    columns exceeds the field limit of whole-stage codegen and runs
    interpreted.  With nulls, each pair uses its pairwise-complete rows.
    """
    columns = [c for c in columns if c in df.columns]
    if len(columns) < 2:
        raise ValueError("correlation needs at least two columns")
    # Built as SQL expression text: one parse on the JVM side instead of
    # hundreds of Py4J column calls (k = 10 gives 45 pairs and 100 cells).
    q = {c: "`" + c.replace("`", "``") + "`" for c in columns}
    lit = {c: "'" + c.replace("'", "\\'") + "'" for c in columns}
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"count({q[c]})").alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.expr(f"avg(CAST({q[c]} AS DOUBLE))").alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.expr(f"min({q[c]}) <=> max({q[c]})").alias(f"flat_{i}") for i, c in enumerate(columns)],
    ).first()
    if all(stats[f"n_{i}"] == stats["n"] for i in range(k)) and stats["n"] > 1:
        d = {i: f"(CAST({q[c]} AS DOUBLE) - CAST('{stats[f'm_{i}']!r}' AS DOUBLE))" for i, c in enumerate(columns)}
        aggs = [f"sum({d[i]} * {d[i]}) AS `s_{i}_{i}`" for i in range(k)]
        aggs += [f"sum({d[i]} * {d[j]}) AS `s_{i}_{j}`" for i, j in pairs]
        wide = df.agg(*[F.expr(a) for a in aggs])
        ratios = [
            "double('NaN') AS `r_{0}_{1}`".format(i, j)
            if stats[f"flat_{i}"] or stats[f"flat_{j}"]  # one value only: the means may still be off by a bit
            else f"coalesce(try_divide(`s_{i}_{j}`, sqrt(`s_{i}_{i}`) * sqrt(`s_{j}_{j}`)), double('NaN')) AS `r_{i}_{j}`"
            for i, j in pairs
        ]
    else:
        # pairwise-complete rows: each pair's deviations over the rows where
        # both values are present
        x = {i: f"CAST({q[c]} AS DOUBLE)" for i, c in enumerate(columns)}
        aggs = []
        for i, j in pairs:
            both = f"{x[i]} IS NOT NULL AND {x[j]} IS NOT NULL"
            aggs += [
                f"covar_samp({x[i]}, {x[j]}) AS `cov_{i}_{j}`",
                f"stddev_samp(CASE WHEN {both} THEN {x[i]} END) AS `sx_{i}_{j}`",
                f"stddev_samp(CASE WHEN {both} THEN {x[j]} END) AS `sy_{i}_{j}`",
            ]
        wide = df.agg(*[F.expr(a) for a in aggs])
        ratios = [
            f"coalesce(CASE WHEN `sx_{i}_{j}` * `sy_{i}_{j}` = 0 THEN double('NaN') "
            f"ELSE `cov_{i}_{j}` / (`sx_{i}_{j}` * `sy_{i}_{j}`) END, double('NaN')) AS `r_{i}_{j}`"
            for i, j in pairs
        ]
    cells = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = "1.0D" if i == j else f"`r_{min(i, j)}_{max(i, j)}`"
            cells.append(f"struct({lit[a]} AS x, {lit[b]} AS y, {r} AS r)")
    return wide.selectExpr(*ratios).selectExpr(f"inline(array({', '.join(cells)}))")
