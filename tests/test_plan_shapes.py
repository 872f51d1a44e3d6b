"""Plan checks: no Python in SQL-twinned plans, pruned scans, few shuffles.

The physical plan is read before execution (AQE's initial plan), which is
what the planner commits to from the query itself.
"""

import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from labelkit.operators import metrics as M
from labelkit.operators import split as S
from labelkit.plans.catalog import KEY, cleaned
from labelkit.sources.contacts import derive_contacts

from conftest import SF_SMALL

PYTHON_NODES = re.compile(
    r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas"
)
SHUFFLE = re.compile(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_no_python_in_sql_twinned_plans(spark):
    queries, oracle = E.queries(), E.oracle_sql()
    with_python = [n for n in oracle if PYTHON_NODES.search(plan_text(queries[n](spark, SF_SMALL)))]
    assert with_python == []


def test_scans_read_only_needed_columns(spark):
    queries = E.queries()
    balance = read_schemas(plan_text(queries["class_balance"](spark, SF_SMALL)))
    assert balance == ["struct<y:string>"]
    caps = read_schemas(plan_text(queries["cap_values"](spark, SF_SMALL)))
    assert caps == ["struct<contact_id:bigint,campaign:int,previous:int>"]


def test_contacts_numbering_shuffles_the_ranges_once_and_sorts_once(spark):
    plan = plan_text(derive_contacts(spark, SF_SMALL))
    # the rows of a range and customer meet once, and both windows share that sort; the
    # numbering is plain windows, without Python workers, at every size
    assert len(re.findall(r"Exchange hashpartitioning\(_seq_pid#\d+, o_custkey#\d+L?, \d+\)", plan)) == 1
    assert len(re.findall(r"\bSort \[_seq_pid#\d+ ASC NULLS FIRST, o_custkey", plan)) == 1
    assert not PYTHON_NODES.search(plan)


def test_one_hot_lookup_does_not_shuffle_the_rows(spark):
    queries = E.queries()
    for name in ("one_hot_slots", "assemble_entries"):
        plan = plan_text(queries[name](spark, SF_SMALL))
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        # only the per-column sizes of the index are shuffled
        assert set(re.findall(r"Exchange hashpartitioning\((\w+)#[^)]*\)", plan)) <= {"column"}


def test_hash_split_is_a_filter(spark):
    train, test = S.hash_split(cleaned(spark, SF_SMALL), KEY)
    for side in (train, test):
        plan = plan_text(side)
        assert not SHUFFLE.search(plan) and "BroadcastExchange" not in plan


def test_score_metrics_reads_predictions_twice(spark, tmp_dir):
    path = f"{tmp_dir}/preds"
    spark.range(2000).select(
        (F.col("id") % 97).cast("double").alias("score"),
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        (F.col("id") % 97 > 40).cast("int").alias("prediction"),
    ).write.parquet(path)
    plan = plan_text(M.score_metrics(spark.read.parquet(path), "score", tiles=4))
    # totals (cells and tile offsets together) and distinct scores; no third pass
    assert len(re.findall(r"FileScan parquet", plan)) == 2
