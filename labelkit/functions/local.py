"""Small driver-side tables (a few rows) without Python workers.

``spark.createDataFrame(list)`` ships the rows through a Python RDD, which
starts Python worker processes when the plan runs.  For the handful of rows
that come from bounded driver-side results (per-column statistics, metric
rows, model metadata) a SQL ``VALUES`` list is planned as a local relation
and stays inside the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType, _parse_datatype_string


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "double('NaN')"
        if math.isinf(v):
            return "double('Infinity')" if v > 0 else "double('-Infinity')"
        return f"CAST('{v!r}' AS DOUBLE)"  # Java parses the shortest repr exactly
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """A DataFrame of ``rows`` with ``schema`` (DDL string or StructType)."""
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    names = [f.name for f in schema.fields]
    casts = [
        f"CAST(`_c{i}` AS {f.dataType.simpleString()}) AS `{f.name}`"
        for i, f in enumerate(schema.fields)
    ]
    if not rows:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        return spark.sql(f"SELECT {empty}").limit(0)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"`_c{i}`" for i in range(len(names)))
    return spark.sql(f"SELECT {', '.join(casts)} FROM VALUES {values} AS t({cols})")
