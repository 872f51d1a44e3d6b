"""The streaming jobs: publish records as messages, score them, read the feed.

``publish``  — a table (CSV scanned as strings, or any DataFrame) → JSON
               messages → Kafka topic or text files; ``times`` repeats the
               table (the replay loop); the message rate is bounded on the
               consuming side with ``max_per_trigger``.
``start_scoring`` — loads run metadata (it decides the cleaning flags; the
               caller's flag is a fallback when metadata is missing) and the
               saved pipeline, then starts the checkpointed scoring stream.
``feed``     — the prediction feed with its five watched fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from labelkit.operators.models import load_model
from labelkit.sources.files import path_exists, read_by_header
from labelkit.sources.messages import read_metadata, repeat_rows, stream_settings, to_messages, write_messages
from labelkit.spec import TableSpec
from labelkit.streaming.scoring import read_predictions, score_stream


def publish(
    spark: SparkSession,
    spec: TableSpec,
    sink_path: str | None = None,
    csv_path: str | None = None,
    frame: DataFrame | None = None,
    times: int = 1,
    fmt: str = "text",
    options: dict | None = None,
    max_records_per_file: int | None = None,
) -> None:
    if frame is None:
        if csv_path is None:
            raise ValueError("give csv_path or frame")
        frame = read_by_header(spark, csv_path)
    if times != 1:
        frame = repeat_rows(frame, times, copy_col=None)
    write_messages(to_messages(frame, spec), sink_path, fmt, options, max_records_per_file)


def start_scoring(
    spark: SparkSession,
    spec: TableSpec,
    artifacts_dir: str,
    checkpoint: str,
    source: dict,
    sink: dict,
    keep_duration_flag: bool | None = None,
    model_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    art = artifacts_dir.rstrip("/")
    model_path = model_path or f"{art}/pipeline_model"
    if not path_exists(spark, model_path):
        raise FileNotFoundError(f"PipelineModel not found: {model_path}")
    keep, features = stream_settings(read_metadata(spark, f"{art}/metadata"), keep_duration_flag)
    return score_stream(
        spark, load_model(model_path), spec, checkpoint, source, sink, keep, features, trigger
    )


def feed(spark: SparkSession, path: str | None = None, stream: bool = False, **kw) -> DataFrame:
    return read_predictions(spark, path, stream=stream, **kw)
