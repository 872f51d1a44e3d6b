"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import types
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelkit.session import scratch_path

#: ASCII white space as every word rule here sees it (Python's ``bytes.split``).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns under the operator's own names, so that further
    columns of the input can neither clash nor be read."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: lineage is
    cut and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` (a table that was written) with ``number``, its rows' places from 0 in ``order``.

    Rows are range-partitioned on the whole order and counted inside their
    partitions as they are written; the partitions' counts (one row each) are
    then added up.  The order should end in a column that tells rows apart, so
    that a value held by many rows is spread over many partitions."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            own = [pa.array(np.full(n, part), type=pa.int32()), pa.array(np.arange(before, before + n))]
            before += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "part", "before"])

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], "part int, before bigint"])
    placed = written(ranged.mapInArrow(count, schema), name)
    held = placed.groupBy("part").agg(F.count("*").alias("n"))
    # one row per partition, whatever the number of rows
    first = held.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    numbered = placed.join(F.broadcast(first), "part")
    return numbered.select(*df.columns, (F.col("first") + F.col("before")).alias("number"))


def id_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def hash_mod(col: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; null ids have no remainder."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % n


def keep_one(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` named by ``kept`` (id, text_hash), with the columns of ``docs``.

    Rows that repeat both id and text are one document; one of them stays.
    Ids may be null.  The decision side is two narrow columns; the planner
    broadcasts it only below the measured size threshold."""
    kept = kept.groupBy("id", "text_hash").agg(F.sum("n").alias("n"))
    names = {c: f"_kept_{i}" for i, c in enumerate(("id", "text_hash", "n"))}
    right = kept.select(*[F.col(c).alias(v) for c, v in names.items()])
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(names["id"])) & (
        text_hash(F.col(f"`{text_col}`")) == F.col(names["text_hash"])
    )
    out = [F.col(f"`{c}`") for c in docs.columns]
    if kept.where("n > 1").isEmpty():
        return docs.join(right, on, "left_semi").select(*out)
    once = docs.join(right.where(F.col(names["n"]) == 1), on, "left_semi").select(*out)
    more = docs.join(right.where(F.col(names["n"]) > 1), on, "inner")
    more = more.dropDuplicates([names["id"], names["text_hash"]]).select(*out)
    return once.unionByName(more)


def text_hash(col: Column) -> Column:
    return F.xxhash64(F.coalesce(col, F.lit("")))


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    import sys

    name = "_labelkit_worker_state"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    return module.__dict__.setdefault("state", {})


def arrow_batch(schema, columns: list):
    """A record batch with the given Arrow schema from Python or numpy columns."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def texts_of(batch, i: int) -> Iterator[str]:
    """The texts of a column one by one (never a whole batch as Python strings); null is empty."""
    for value in batch.column(i):
        yield value.as_py() or ""
