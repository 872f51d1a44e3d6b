"""The driver contract: entry() runs, and every SQL twin agrees with Spark."""

import __spark_entry__ as entry
from labelkit.plans.catalog import ORACLE, QUERIES

from conftest import SF_SMALL
from oracle_compare import compare


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "count", "label_name"]
    assert {r.label_name for r in rows} <= {"no", "yes"} and len(rows) >= 1


def test_catalogue_shape():
    assert set(QUERIES) == set(ORACLE)
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q)


def test_sql_twins_agree_in_rows_and_types(spark):
    names = sorted(ORACLE)
    res = compare(spark, SF_SMALL, names, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
