"""Column-expression builders (all JVM-side, codegen-friendly)."""

from labelkit.functions.exprs import (
    binary_label,
    cap,
    class_one_probability,
    hash_bucket,
    lenient_int,
    linear_score,
    range_tile,
    sentinel_flag,
    sentinel_replace,
)

__all__ = [
    "binary_label",
    "cap",
    "class_one_probability",
    "hash_bucket",
    "lenient_int",
    "linear_score",
    "range_tile",
    "sentinel_flag",
    "sentinel_replace",
]
