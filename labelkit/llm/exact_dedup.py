"""Exact dedup by a heavy-hitter split.

A Misra-Gries sketch finds the digests that hold at least ``theta`` of all
rows; their exact counts and winners are verified in a second pass and
broadcast, so rows of huge groups are judged on the map side and never meet
in one task.  All other digests take an ordinary shuffle on the digest, where
by the sketch's guarantee no group is above ``theta`` of the rows.

Defined cases: a null text is the empty text; of equal texts the row with the
largest id stays; null ids rank below every other (a group of null ids only
keeps them); rows that repeat an id and its text are marked alike, and
:func:`deduplicate` leaves one of them.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import keep_one, named, text_hash, written


def _summaries(counters: int):
    """Per partition: at most ``counters`` (item, count) rows and the row count."""

    def summarise(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa

        held = pd.Series(dtype="int64")
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            held = held.add(batch.column(0).to_pandas().value_counts(), fill_value=0).astype("int64")
            if len(held) > counters:
                # the merge step of Misra-Gries: the (counters + 1)-th largest count goes from all
                cut = held.nlargest(counters + 1).iloc[-1]
                held = held[held > cut] - cut
        yield pa.RecordBatch.from_pydict(
            {"item": [*held.index, None], "weight": [*map(int, held), rows]},
            schema=pa.schema([("item", pa.string()), ("weight", pa.int64())]),
        )

    return summarise


def frequent_items(items: DataFrame, theta: float) -> DataFrame:
    """Items that may hold ``theta`` of all rows or more: every such item is in, and at most 2/theta in all.

    With 2/theta counters a partition of n rows undercounts an item by at most
    n * theta / 2, so an item of theta * N rows keeps a summed weight of at
    least theta * N / 2, which at most 2/theta items can reach."""
    counters = int(2 / theta)
    parts = items.mapInArrow(_summaries(counters), "item string, weight bigint")
    weights = parts.groupBy("item").agg(F.sum("weight").alias("weight"))
    weights = written(weights, "misra-gries")
    n = weights.where("item is null").agg(F.max("weight")).first()[0] or 0
    return weights.where(F.col("item").isNotNull() & (F.col("weight") >= theta * n / 2)).select("item")


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", theta: float = 0.001
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, text_hash."""
    base = named(docs, id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    digests = written(
        base.select("id", F.sha2(text, 256).alias("digest"), text_hash(F.col("text")).alias("text_hash")),
        "digests",
    )
    frequent = frequent_items(digests.select("digest"), theta).select(F.col("item").alias("digest"))
    winners = (
        digests.join(F.broadcast(frequent), "digest", "left_semi")  # at most 2/theta digests
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = written(winners, "winners")
    heavy = digests.join(F.broadcast(winners), "digest", "inner")
    group = Window.partitionBy("digest")
    light = (
        digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("keep_id", F.max("id").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return heavy.unionByName(light).select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "text_hash",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", theta: float = 0.001) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with the columns of ``docs``."""
    groups = duplicate_groups(docs, id_col, text_col, theta)
    kept = groups.where("kept").select("id", "text_hash", F.lit(1).alias("n"))
    return keep_one(docs, written(kept, "kept"), id_col, text_col)
