"""Delimited-file scans and table sinks.

The CSV scan uses the spec's explicit schema (no inference pass over the
data).  Columns bind by position and the header line is skipped, not checked
(Spark's default ``enforceSchema``); unparsable values become null and short
rows get trailing nulls (PERMISSIVE mode), the row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelkit.spec import TableSpec


def read_delimited(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    sep: str = ";",
    quote: str = '"',
    header: bool = True,
    as_strings: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """S2 — scan a delimited file with the spec's schema (or all strings)."""
    schema = spec.string_schema() if as_strings else spec.schema()
    return (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", quote)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .schema(schema)
        .csv(path)
    )


#: Nulls are written as nothing, empty strings quoted, spaces kept and quotes doubled, so that
#: :func:`read_delimited` gives the rows back; values with line breaks need ``multi_line`` there.
_AS_IS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
}


def read_by_header(spark: SparkSession, path: str, sep: str = ";", quote: str = '"') -> DataFrame:
    """Scan a delimited file with its header's names, every column a string."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    return reader.option("escape", '"').csv(path)


def write_delimited(
    df: DataFrame, path: str, sep: str = ";", header: bool = True, mode: str = "overwrite"
) -> str:
    """Write a delimited file set (one file per task; no single-file funnel)."""
    df.write.mode(mode).options(**_AS_IS).option("header", header).option("sep", sep).csv(path)
    return path


def write_table(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", single_file: bool = False
) -> str:
    """S5 — a report table sink (CSV with header, or parquet/json).

    ``single_file`` coalesces to one task; use it only for report-sized tables
    (profiling and metric tables are a handful of rows).
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**_AS_IS).option("header", True)
    writer.format(fmt).save(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))
