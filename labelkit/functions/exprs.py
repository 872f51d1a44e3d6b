"""Scalar expressions used by the operators.

Every function returns a :class:`pyspark.sql.Column`; nothing here runs Python
per row.  Spark 4 runs with ANSI on, so parsing uses ``try_cast`` and array
access uses ``get`` (null instead of an error).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: str | Column, source_type: DataType | None = None) -> Column:
    """P1 — cast to int; unparsable strings become null instead of failing."""
    return _col(c).try_cast("int")  # out-of-range numbers and NaN are null as well


def cap(c: str | Column, value: int, null_policy: str = "least") -> Column:
    """P2 — upper cap.

    ``least`` skips nulls, so by default a null becomes the cap value (N4);
    ``null_policy="keep"`` leaves nulls null.
    """
    c = _col(c)
    capped = F.least(c, F.lit(value))
    if null_policy == "least":
        return capped
    if null_policy == "keep":
        return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(capped)
    raise ValueError("null_policy must be 'least' or 'keep'")


def sentinel_flag(c: str | Column, sentinel: int) -> Column:
    """P3 — 0 at the sentinel, else 1 (null falls to 1, N5)."""
    return F.when(_col(c) == F.lit(sentinel), F.lit(0)).otherwise(F.lit(1)).cast("int")


def sentinel_replace(c: str | Column, sentinel: int, replacement: int = 0) -> Column:
    """P4 — sentinel replaced by ``replacement`` (null stays null)."""
    c = _col(c)
    return F.when(c == F.lit(sentinel), F.lit(replacement)).otherwise(c).cast("int")


def binary_label(c: str | Column, positive: str) -> Column:
    """P6 — exactly ``positive`` → 1; anything else, null included → 0."""
    return F.when(_col(c) == F.lit(positive), F.lit(1)).otherwise(F.lit(0)).cast("int")


def hash_bucket(key: str | Column, buckets: int = 10000) -> Column:
    """Layout-independent bucket of a key: first 32 bits of md5, mod ``buckets``.

    The same number is computed by DuckDB as
    ``('0x' || substr(md5(k::varchar), 1, 8))::BIGINT % buckets``, so a split
    on it can be checked outside Spark and never moves with partitioning.
    """
    hex8 = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % F.lit(buckets)).cast("bigint")


def class_one_probability(probability: str | Column) -> Column:
    """P13 — probability of class 1 from an ML vector; 0.0 if absent."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(_col(probability))
    return F.coalesce(F.get(arr, 1).cast("double"), F.lit(0.0))


def linear_score(weights: Sequence[tuple[str, float]], intercept: float = 0.0) -> Column:
    """A fixed linear expression ``intercept + w1*x1 + w2*x2 + ...``.

    Evaluated left to right so that another engine evaluating the same SQL
    text gets bit-identical doubles.
    """
    expr: Column = F.lit(float(intercept))
    for name, w in weights:
        expr = expr + F.lit(float(w)) * F.col(name).cast("double")
    return expr


def linear_score_sql(weights: Sequence[tuple[str, float]], intercept: float = 0.0) -> str:
    """The SQL text of :func:`linear_score` (same evaluation order)."""
    expr = f"CAST({float(intercept)!r} AS DOUBLE)"
    for name, w in weights:
        expr = f"({expr} + CAST({float(w)!r} AS DOUBLE) * CAST({name} AS DOUBLE))"
    return expr


def range_tile(c: str | Column, bounds: Sequence) -> Column:
    """Index of the range a value falls in, given sorted split points.

    Returns the number of bounds ``<= value`` (0 .. len(bounds)), built as a
    balanced tree of comparisons: O(log n) per row, deterministic, and fully
    inside whole-stage codegen (no UDF).  For short lists only: the tree
    grows with the list, and with thousands of bounds the generated code no
    longer compiles; tile data with :func:`labelkit.operators.prefix.with_tile`.
    """
    c = _col(c)
    bounds = list(bounds)

    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]; bounds[lo:hi] decide it
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds)).cast("int")
