"""Row numbers and lags within groups, safe for hot groups.

``sequence_within_groups`` adds, for each *level* (a list of grouping
columns), the 1-based position of every row within its group under a common
sort order, plus ``lag(col, 1)`` columns within a level's groups.

One plan serves every size.  Rows are range-partitioned on the full sort key
(Spark samples the composite key, so a hot group is cut across many
partitions) and written with their partition number to the shared checkpoint
folder; that fixes the numbers and survives lost executors.  Plain windows
then number the rows of every (partition, group), so no task holds more than
one range.  What is left to correct is the *first group of every partition*:
its offset is the row count of the same group in earlier partitions and its
first lag is the last value of the partition before.  These corrections hold
at most one row per partition and level, a proven bound for their broadcast.

Only windows, joins and aggregates are used, so all types behave as in a
plain window (NaN and null are values of their own, nulls sort first).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.session import stored

_PID = "_seq_pid"


def sequence_within_groups(
    df: DataFrame,
    sort_cols: Sequence[str],
    levels: Mapping[str, Sequence[str]],
    lags: Mapping[str, tuple[str, str]] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add row-number columns (one per level) and lag columns.

    ``sort_cols`` is the full order (group columns first); every level's
    groups must be contiguous under it.  ``lags`` maps an output name to
    ``(source column, level name)``.
    """
    lags = dict(lags or {})
    levels = {name: list(group) for name, group in levels.items()}
    ranged = _ranged(df, sort_cols, num_partitions)
    edges = _edges(ranged, sort_cols, levels, sorted({src for src, _ in lags.values()}))
    windows = {
        name: Window.partitionBy(_PID, *group).orderBy(*[c for c in sort_cols if c not in group])
        for name, group in levels.items()
    }
    exprs = {name: F.row_number().over(w).cast("long") for name, w in windows.items()}
    for out_name, (src, level) in lags.items():
        exprs[out_name] = F.lag(src, 1).over(windows[level])
    out = ranged.withColumns(exprs)
    for name, group in levels.items():
        out = _carry(out, edges, name, group, {o: s for o, (s, lvl) in lags.items() if lvl == name})
    return out.drop(_PID)


def _ranged(df: DataFrame, sort_cols: Sequence[str], num_partitions: int | None) -> DataFrame:
    # Without an explicit count AQE may merge small neighbouring ranges; merged
    # partitions keep the range order, which is all the corrections rely on.
    count = [num_partitions] if num_partitions else []
    parts = df.repartitionByRange(*count, *sort_cols)
    return stored(parts.withColumn(_PID, F.spark_partition_id()), "sequence")


def _in_group(side: str, group: Sequence[str], of=F.col) -> Column:
    """Whether ``of(column)`` equals the edge row ``side`` in all group columns."""
    same = F.lit(True)
    for c in group:
        same = same & of(c).eqNullSafe(F.col(side)[c])
    return same


def _edges(
    ranged: DataFrame, sort_cols: Sequence[str], levels: dict[str, list[str]], sources: list[str]
) -> DataFrame:
    """One row per partition: its ``first`` and ``last`` sort key, the lag sources of its last
    row (``held``) and, for each level, the rows of its last group (``n_<level>``)."""
    key = F.struct(*sort_cols)
    held = F.struct(*sources) if sources else F.struct(F.lit(0).alias("none"))
    ends = ranged.groupBy(_PID).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.max_by(held, key).alias("held")
    )
    ends = stored(ends, "sequence-ends")
    last = F.broadcast(ends.select(_PID, F.col("last").alias("_seq_last")))  # a row per partition
    counts = ranged.join(last, _PID).groupBy(_PID).agg(
        *[F.count_if(_in_group("_seq_last", group)).alias(f"n_{name}") for name, group in levels.items()]
    )
    return stored(ends.join(counts, _PID), "sequence-edges")


def _carry(out: DataFrame, edges: DataFrame, name: str, group: list[str], lags: dict[str, str]) -> DataFrame:
    """Correct the first group of every partition by what earlier partitions hold of it."""
    whole = _in_group("last", group, of=lambda c: F.col("first")[c])  # one group fills the partition
    rows = F.col(f"n_{name}")
    opening = edges.select(
        _PID, "held", F.lit(True).alias("opens"), F.when(whole, rows).otherwise(0).alias("n"),
        *[F.col("first")[c].alias(f"_seq_{c}") for c in group],
    )
    closing = edges.where(~whole).select(
        _PID, "held", F.lit(False).alias("opens"), rows.alias("n"),
        *[F.col("last")[c].alias(f"_seq_{c}") for c in group],
    )
    run = Window.partitionBy(*[f"_seq_{c}" for c in group]).orderBy(_PID)
    fix = (
        opening.unionByName(closing)
        .withColumn("_seq_off", F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_seq_held", F.lag("held", 1).over(run))
        .where("opens and _seq_off > 0")
        .select(F.col(_PID).alias("_seq_at"), "_seq_off", "_seq_held", *[f"_seq_{c}" for c in group])
    )
    on = F.col(_PID) == F.col("_seq_at")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_seq_{c}"))
    joined = out.join(F.broadcast(fix), on, "left")  # at most a row per partition
    opens = F.col("_seq_at").isNotNull() & (F.col(name) == 1)
    updates = {name: F.col(name) + F.coalesce("_seq_off", F.lit(0))}
    for out_name, src in lags.items():
        updates[out_name] = F.when(opens, F.col("_seq_held")[src]).otherwise(F.col(out_name))
    return joined.withColumns(updates).drop(*fix.columns)
