"""Cleaning, as one projection.

The original chain (casts, caps, sentinel flag/replace, drops, label) is a row
of ``withColumn`` calls; here it is a single ``select`` so the plan holds one
Project that sits inside the scan's whole-stage-codegen span, and the column
order equals the chained form: kept source columns in place, then the sentinel
flag, the cleaned sentinel and the label.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.functions.exprs import (
    binary_label,
    cap,
    lenient_int,
    sentinel_flag,
    sentinel_replace,
)
from labelkit.spec import TableSpec


def cap_values(
    df: DataFrame, caps: dict[str, int], null_policy: str = "least"
) -> DataFrame:
    """P2 — winsorize columns at an upper cap."""
    return df.withColumns(
        {c: cap(c, v, null_policy) for c, v in caps.items() if c in df.columns}
    )


def add_sentinel_flag(df: DataFrame, column: str, sentinel: int, out: str) -> DataFrame:
    """P3."""
    return df.withColumn(out, sentinel_flag(column, sentinel))


def add_sentinel_replace(
    df: DataFrame, column: str, sentinel: int, out: str, replacement: int = 0
) -> DataFrame:
    """P4."""
    return df.withColumn(out, sentinel_replace(column, sentinel, replacement))


def add_label(df: DataFrame, spec: TableSpec) -> DataFrame:
    """P6."""
    return df.withColumn(spec.label, binary_label(spec.target, spec.positive))


def clean_columns(
    columns: list[tuple[str, object]],
    spec: TableSpec,
    keep_leakage: bool = False,
    include_label: bool = True,
    null_policy: str = "least",
) -> list[Column]:
    """The cleaning projection for input columns ``(name, dataType)``."""
    numeric = set(spec.numeric)
    sent = spec.sentinel
    exprs: list[Column] = []
    for name, dtype in columns:
        if sent is not None and name == sent.column:
            continue
        if spec.leakage and name == spec.leakage and not keep_leakage:
            continue
        e = lenient_int(name, dtype) if name in numeric else F.col(name)
        if name in spec.caps:
            e = cap(e, spec.caps[name], null_policy)
        exprs.append(e.alias(name))
    if sent is not None:
        types = dict(columns)
        src = lenient_int(sent.column, types.get(sent.column))
        exprs.append(sentinel_flag(src, sent.value).alias(sent.flag))
        exprs.append(sentinel_replace(src, sent.value).alias(sent.clean))
    if include_label and spec.target in dict(columns):
        exprs.append(binary_label(spec.target, spec.positive).alias(spec.label))
    return exprs


def clean(
    df: DataFrame,
    spec: TableSpec,
    keep_leakage: bool = False,
    include_label: bool = True,
    null_policy: str = "least",
) -> DataFrame:
    """P7 — the composite cleaning, identical for batch and streaming frames."""
    cols = [(f.name, f.dataType) for f in df.schema.fields]
    return df.select(*clean_columns(cols, spec, keep_leakage, include_label, null_policy))


def select_features(
    df: DataFrame,
    spec: TableSpec,
    keep_leakage: bool = False,
    pdays_features: str = "both",
    extra: Iterable[str] = (),
) -> DataFrame:
    """P8 — project the key, the chosen feature set and the label."""
    cats, nums = spec.features(keep_leakage, pdays_features)
    keep = [c for c in ([spec.key] if spec.key else []) + list(extra) + cats + nums]
    if spec.label in df.columns:
        keep.append(spec.label)
    return df.select(*[c for c in keep if c in df.columns])


def project_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """P15 — keep the wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """P10 — surrogate id for keyless tables (not stable across re-reads)."""
    return df.withColumn(name, F.monotonically_increasing_id())
