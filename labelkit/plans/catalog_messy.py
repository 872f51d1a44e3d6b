"""Catalogue part 3: cleaning, decoding and indexing of messy input.

The raw rows are derived from ``orders`` by fixed expressions that both
engines read alike: unparsable, padded, fractional and out-of-range numbers,
empty strings, nulls, odd targets, wrong-typed JSON fields and lines that are
no JSON at all.  Imported by :mod:`labelkit.plans.catalog`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkit.operators import clean as C
from labelkit.operators import features as FE
from labelkit.plans.catalog import CLEAN_SELECT, KEY, SPEC
from labelkit.plans.catalog_io import CLEAN_NO_LABEL, clean_through_stream
from labelkit.session import table_path

#: one SQL text for Spark and DuckDB: every column but the key as raw text
RAW_TEXT = """
SELECT o_orderkey AS contact_id,
       CASE o_orderkey % 9 WHEN 0 THEN 'abc' WHEN 1 THEN '99999999999' WHEN 2 THEN NULL WHEN 3 THEN ''
            WHEN 4 THEN ' 42 ' WHEN 5 THEN '3.7' WHEN 6 THEN '-5' ELSE CAST(18 + o_custkey % 70 AS VARCHAR(20)) END AS age,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN '' ELSE o_orderstatus END AS job,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS education,
       CAST(o_custkey AS VARCHAR(20)) AS balance,
       CASE WHEN o_orderkey % 4 = 0 THEN '1e2' ELSE CAST(o_custkey % 28 AS VARCHAR(20)) END AS day,
       CAST(o_custkey % 12 AS VARCHAR(20)) AS month_no,
       CAST(NULL AS VARCHAR(20)) AS duration,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 9 AS VARCHAR(20)) END AS campaign,
       CASE WHEN o_orderkey % 8 = 0 THEN 'x' ELSE CAST(o_custkey % 30 AS VARCHAR(20)) END AS previous,
       CASE o_orderkey % 5 WHEN 0 THEN '-1' WHEN 1 THEN NULL WHEN 2 THEN 'never' ELSE CAST(o_custkey % 99 AS VARCHAR(20)) END AS pdays,
       o_orderstatus AS poutcome,
       CASE o_orderkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'YES' WHEN 2 THEN NULL ELSE 'no' END AS y
FROM orders
"""


def _typed_sql() -> str:
    """The rows with their numbers parsed: whole numbers in the int range, padded or not; else null."""
    number = "CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS INTEGER) END AS {c}"
    columns = [number.format(c=c) if c in SPEC.numeric else c for c, _ in SPEC.columns]
    return f"SELECT {', '.join(columns)} FROM ({RAW_TEXT})"


def _on_raw(sql: str, contacts: str) -> str:
    """``sql`` over the messy rows in place of the contacts table."""
    return f"WITH messy AS ({contacts})\n{sql.replace('FROM contacts', 'FROM messy')}"


def raw_text(spark, sf_dir):
    spark.read.parquet(table_path(sf_dir, "orders")).createOrReplaceTempView("labelkit_orders")
    return spark.sql(RAW_TEXT.replace("FROM orders", "FROM labelkit_orders"))


def _register(name: str, sql: str):
    from labelkit.plans.catalog import ORACLE, QUERIES

    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return deco


@_register("clean_messy", _on_raw(CLEAN_SELECT, _typed_sql()))
def q_clean_messy(spark, sf_dir):
    return C.clean(raw_text(spark, sf_dir), SPEC)


# ---- JSON lines: a tenth is no JSON, ages have wrong types ---------------------

#: the JSON text of an age, in both engines; only the last two kinds are ints
AGE_JSON = """CASE o_orderkey % 6 WHEN 0 THEN '"12"' WHEN 1 THEN '3.5' WHEN 2 THEN '99999999999' WHEN 3 THEN 'null'
       WHEN 4 THEN '-7' ELSE CAST(o_custkey % 70 AS VARCHAR(20)) END"""
LINES = f"""
SELECT CASE o_orderkey % 10 WHEN 0 THEN 'not json' WHEN 1 THEN '{{"contact_id": ' ELSE
       concat('{{"contact_id":', CAST(o_orderkey AS VARCHAR(20)), ',"age":', {AGE_JSON},
              ',"campaign":', CAST(o_custkey % 9 AS VARCHAR(20)), ',"pdays":-1,"unknown":[1],"y":"yes"}}') END AS value
FROM orders
"""
LINES_TYPED = f"""
SELECT CASE WHEN ok THEN o_orderkey END AS contact_id,
       CASE WHEN ok AND o_orderkey % 6 IN (4, 5) THEN CAST({AGE_JSON} AS INTEGER) END AS age,
       CAST(NULL AS VARCHAR) AS job, CAST(NULL AS VARCHAR) AS education, CAST(NULL AS INTEGER) AS balance,
       CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS month_no, CAST(NULL AS INTEGER) AS duration,
       CASE WHEN ok THEN CAST(o_custkey % 9 AS INTEGER) END AS campaign, CAST(NULL AS INTEGER) AS previous,
       CASE WHEN ok THEN -1 END AS pdays, CAST(NULL AS VARCHAR) AS poutcome, CASE WHEN ok THEN 'yes' END AS y
FROM (SELECT *, o_orderkey % 10 > 1 AS ok FROM orders)
"""


@_register("stream_clean_messy", _on_raw(CLEAN_NO_LABEL, LINES_TYPED))
def q_stream_clean_messy(spark, sf_dir):
    spark.read.parquet(table_path(sf_dir, "orders")).createOrReplaceTempView("labelkit_orders")
    lines = spark.sql(LINES.replace("FROM orders", "FROM labelkit_orders"))
    return clean_through_stream(spark, lines, "stream_clean_messy").drop("ingest_ts")


# ---- nulls and empty strings as categories --------------------------------------


@_register(
    "category_index_nulls",
    f"""
WITH raw AS ({RAW_TEXT}), cats AS (
  SELECT 'job' AS "column", job AS category FROM raw UNION ALL SELECT 'education', education FROM raw
)
SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, category) - 1 AS INT) AS "index"
FROM (SELECT "column", category, count(*) AS "count" FROM cats WHERE category IS NOT NULL GROUP BY "column", category)
""",
)
def q_category_index_nulls(spark, sf_dir):
    return FE.category_index(raw_text(spark, sf_dir).select(KEY, "job", "education"), ["job", "education"])
