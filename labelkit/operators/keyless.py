"""P10, A1, A2 — reproducible splits of tables without a key.

A row's identity is its content: md5 over all columns, and its occurrence
number among equal rows.  Both depend on the rows alone, not on how the table
is stored (``monotonically_increasing_id`` and ``sampleBy`` do), so the split is
the same after every rewrite.

Equal rows are counted first (map-side, so a hot row is one small group) and
then told apart again by their occurrence number: in runs of ``RUN`` that are
dealt out before they are expanded, so no task expands a hot group alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions.exprs import hash_bucket
from labelkit.operators.split import BUCKETS

#: Copies of a row that one task expands at a time.
RUN = 10_000


def content_text(columns: Sequence[str]) -> Column:
    """All columns as one text that tells null from empty: ``+value`` or ``-``, separated by a unit separator."""
    parts = [
        F.when(F.col(f"`{c}`").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(f"`{c}`").cast("string")))
        for c in columns
    ]
    return F.concat_ws("\x1f", *parts)


def with_occurrence(df: DataFrame, content: str = "content", occurrence: str = "occurrence") -> DataFrame:
    """P10 — ``df`` with its rows' content key and their number (from 1) among equal rows."""
    columns = df.columns
    for name in (content, occurrence):
        if name.lower() in (c.lower() for c in columns):
            raise ValueError(f"the table has a column {name!r} already: choose another name")
    held = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    runs = held.withColumn("_run", F.explode(F.expr(f"sequence(0, (_n - 1) div {RUN})")))
    # a hot row's runs go to different tasks before they are expanded
    runs = runs.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.col("_run"))
    last = F.least(F.col("_n"), (F.col("_run") + 1) * F.lit(RUN))
    numbered = runs.withColumn("_at", F.explode(F.sequence(F.col("_run") * F.lit(RUN) + 1, last)))
    return numbered.select(
        *[F.col(f"`{c}`") for c in columns],
        F.md5(content_text(columns)).alias(content),
        F.col("_at").cast("bigint").alias(occurrence),
    )


def keyless_bucket(content: str = "content", occurrence: str = "occurrence", seed: int = 42) -> Column:
    """The bucket (0 … 9999) of a row from its content key and occurrence."""
    return hash_bucket(F.concat_ws(":", F.lit(str(seed)), F.col(content), F.col(occurrence).cast("string")), BUCKETS)


def keyless_split(df: DataFrame, train_frac: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A2 — ``(train, test)`` with the columns of ``df``: disjoint, complete, the same in every layout."""
    limit = F.lit(int(round(train_frac * BUCKETS)))
    marked = with_occurrence(df, "_content", "_occurrence")
    drawn = keyless_bucket("_content", "_occurrence", seed) < limit
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.filter(drawn).select(*columns), marked.filter(~drawn).select(*columns)


def keyless_sample(
    df: DataFrame, label: str = "label", fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """A1 — a stratified draw of the labels 0 and 1 and the rest of the table (other labels included)."""
    limit = F.lit(int(round(fraction * BUCKETS)))
    marked = with_occurrence(df, "_content", "_occurrence")
    drawn = F.coalesce(F.col(f"`{label}`").isin(0, 1), F.lit(False))
    drawn = drawn & (keyless_bucket("_content", "_occurrence", seed) < limit)
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.filter(drawn).select(*columns), marked.filter(~drawn).select(*columns)
