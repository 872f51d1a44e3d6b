"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in the order of (id, md5 of the text), which does not
depend on how the table is stored.  A keyed Feistel network permutes the
numbers: with side = ceil(sqrt(n)) a number is (left, right) in base ``side``,
and a round replaces it by (right, left + f(right) mod side).  That permutes
[0, side * side); a value outside [0, n) is permuted again until it falls
inside (cycle walking, about 2 / sqrt(n) of the values).  The permuted number p
goes to shard ``p mod shards`` at slot ``p div shards``.

So shards differ by at most one row, slots have no gaps, another seed is
another shuffle, and both directions can be computed from n and the seed alone:
:func:`address` gives a row number's shard and slot, :func:`number_at` the row
number that stands there, with no table in between.  Nothing is grouped: equal
texts are rows like all others.

Defined cases: a null text has no bytes; null ids come first in the numbering;
rows that repeat id and text take neighbouring numbers and may swap among
themselves (their results are equal); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import named, number_rows, written

ROUNDS = 8
HEADER_BYTES = 16


class Permutation:
    """A seeded permutation of 0..n-1 and its inverse, on numpy arrays."""

    def __init__(self, n: int, seed: int = 42, rounds: int = ROUNDS):
        self.n, self.side = n, isqrt(max(n - 1, 0)) + 1
        self.keys = [[self._key(seed, r, part) for part in "abcd"] for r in range(rounds)]

    @staticmethod
    def _key(seed: int, r: int, part: str) -> int:
        """An odd number below 2**31, so that products with 32-bit numbers fit into 63 bits."""
        return int(md5(f"{seed}:{r}:{part}".encode()).hexdigest()[:8], 16) >> 1 | 1

    def _mix(self, x, key):
        a, b, c, d = key
        v = x * a + b
        v = (v ^ (v >> 32)) & 0xFFFFFFFF
        v = v * c + d
        return (v ^ (v >> 29)) % self.side

    def _forth(self, x):
        left, right = x // self.side, x % self.side
        for key in self.keys:
            left, right = right, (left + self._mix(right, key)) % self.side
        return left * self.side + right

    def _back(self, x):
        left, right = x // self.side, x % self.side
        for key in reversed(self.keys):
            left, right = (right - self._mix(left, key)) % self.side, left
        return left * self.side + right

    def _walk(self, x, step):
        import numpy as np

        x = step(np.asarray(x, dtype=np.int64))
        outside = np.flatnonzero(x >= self.n)
        while len(outside):
            x[outside] = step(x[outside])
            outside = outside[x[outside] >= self.n]
        return x

    def forward(self, x):
        return self._walk(x, self._forth)

    def inverse(self, x):
        return self._walk(x, self._back)


def address(n: int, numbers, shards: int = 40, seed: int = 42):
    """(shard, slot) of row numbers in a table of n rows."""
    placed = Permutation(n, seed).forward(numbers)
    return placed % shards, placed // shards


def number_at(n: int, shard, slot, shards: int = 40, seed: int = 42):
    """Row numbers that stand at (shard, slot); the inverse of :func:`address`."""
    return Permutation(n, seed).inverse(slot * shards + shard)


def _addressed(numbered: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    """``numbered`` with shard and slot computed from its last column, ``number``."""

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        permutation = Permutation(n, seed)
        for batch in batches:
            placed = permutation.forward(batch.column(batch.num_columns - 1).to_numpy())
            own = [pa.array(placed % shards).cast(pa.int32()), pa.array(placed // shards)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "shard", "slot"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    return numbered.mapInArrow(compute, schema + ", shard int, slot bigint")


def _key(text):
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def shard_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, seed: int = 42
) -> DataFrame:
    """id, size, text_crc32, number, shard, slot: where each row of ``docs`` goes."""
    base = named(docs, id=id_col, text=text_col)
    content = F.coalesce("text", F.lit("")).cast("binary")
    rows = base.select(
        "id",
        (F.octet_length(content) + HEADER_BYTES).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
        _key(F.col("text")).alias("key"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = written(rows, "shard-rows")  # fixes the tie
    numbered = number_rows(rows, ["id", "key", "tie"], "shard-numbers").drop("key", "tie")
    return _addressed(numbered, rows.count(), shards, seed)


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 40,
    seed: int = 42,
) -> DataFrame:
    """Write whole rows to ``path`` as Parquet, a folder ``shard=K`` per shard with its rows in the order
    of ``slot``; returns the written table (columns row, slot, shard).

    The rows lie in a struct ``row``, so no name of theirs can clash.  They
    move twice, to their number and to their shard; a shard is written by as
    many tasks as its part of the partitions asks for."""
    spark = docs.sparkSession
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        _key(F.col(f"`{text_col}`")).alias("key"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = written(whole, "shard-input")
    numbered = number_rows(rows, ["id", "key", "tie"], "shard-numbers").select("row", "number")
    placed = _addressed(numbered, rows.count(), shards, seed).select("row", "slot", "shard")
    placed = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
