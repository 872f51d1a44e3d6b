"""Table → JSON messages, bounded replay, run metadata.

Messages are the ``value`` column of a Kafka record (or a line of a text
file): one JSON object per row with the spec's fields by name.  Numeric
fields are parsed leniently (unparsable → null) and nulls are written as
``null`` — a consumer sees every field.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.functions.exprs import lenient_int
from labelkit.spec import TableSpec


def to_messages(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """S6 — one JSON ``value`` per row (plus ``keep`` columns, e.g. a key)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = set(spec.numeric)
    fields = []
    for name, _ in spec.columns:
        if name not in types:
            continue
        e = lenient_int(name, types[name]) if name in numeric else F.col(name)
        fields.append(e.alias(name))
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(*keep, value.alias("value"))


def decode_messages(
    df: DataFrame, spec: TableSpec, value_col: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """T1/P11 — parse JSON values by name with the spec's schema, expand fields.

    Wrong-typed fields become null; non-JSON or null values give a row of
    nulls (the row is kept).  Source columns other than the value (Kafka
    key, topic, offset...) are dropped unless listed in ``keep``.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), spec.schema())
    return df.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def repeat_rows(df: DataFrame, times: int, copy_col: str | None = "copy") -> DataFrame:
    """S7 — every row ``times`` times (replay loop), a narrow generate."""
    if int(times) < 0:
        raise ValueError(f"a table cannot be replayed {times} times")
    if int(times) == 0:
        df, times = df.limit(0), 1
    gen = F.explode(F.sequence(F.lit(1), F.lit(int(times))))
    if copy_col:
        return df.select("*", gen.alias(copy_col))
    return df.select("*", gen.alias("_copy")).drop("_copy")


def write_messages(
    df: DataFrame,
    path: str,
    fmt: str = "text",
    options=None,
    max_records_per_file: int | None = None,
) -> None:
    """Publish messages: ``text`` files (one JSON per line) or ``kafka``.

    For Kafka pass ``options`` with ``kafka.bootstrap.servers`` and ``topic``;
    the connector jar must be on the classpath (not in this build's tests).
    ``max_records_per_file`` cuts files by row count (no shuffle), which is
    what a file-source stream admits per trigger.
    """
    if fmt == "kafka":
        df.select("value").write.format("kafka").options(**(options or {})).save()
        return
    writer = df.select("value").write.mode("overwrite").format(fmt).options(**(options or {}))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.save(path)


# --------------------------------------------------------------------------
# S10 — run metadata
# --------------------------------------------------------------------------


def write_metadata(spark: SparkSession, path: str, meta: dict) -> str:
    """One JSON object written through Spark (one row, one file)."""
    meta = dict(meta)
    meta.setdefault("generated_at", datetime.now(timezone.utc).isoformat())
    text = F.lit(json.dumps(meta))
    df = spark.range(1).select(F.from_json(text, F.schema_of_json(text)).alias("m")).select("m.*")
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> dict | None:
    """The metadata object, or None when the path does not exist."""
    from labelkit.sources.files import path_exists

    if not path_exists(spark, path):
        return None
    row = spark.read.json(path).first()
    return row.asDict(recursive=True) if row is not None else None


def stream_settings(meta: dict | None, keep_duration_flag: bool | None = None) -> tuple[bool, str]:
    """Metadata wins; the flag is used only when metadata is missing.

    Defaults: ``keep_duration=False``, ``pdays_features="both"``.
    """
    keep, features = False, "both"
    if meta is not None:
        keep = bool(meta.get("keep_duration", False))
        features = meta.get("pdays_features", "both") or "both"
    elif keep_duration_flag is not None:
        keep = bool(keep_duration_flag)
    return keep, features
