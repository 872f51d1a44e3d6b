"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

import corpus_pipeline
from labelkit.llm.common import documents
from tests.conftest import SF_CHECK
from tests.llm.test_dedup import brute_components


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = documents(spark, SF_CHECK)
    columns, before = docs.columns, None
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF_CHECK), "test-stage")
        assert docs.columns == columns
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        if name == "exact dedup":
            texts = {}
            for i, t, _ in before:
                texts[t] = max(i, texts.get(t, i))
            assert sorted((i, t) for i, t, _ in rows) == sorted((i, t) for t, i in texts.items())
        if name == "simhash near-dedup":
            want = {c for _, _, c in brute_components([(i, t) for i, t, _ in before])}
            assert sorted(i for i, _, _ in rows) == sorted(want)
        if name == "temperature mixing":
            assert set(rows) <= set(before)
        kept[name] = len(rows)
        before = rows
    assert kept["quality classifier"] < documents(spark, SF_CHECK).count()
    assert kept["exact dedup"] < kept["quality classifier"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_CHECK).collect()
    assert sum(r.start == 0 for r in packed) == kept["temperature mixing"]


def test_every_dealt_operator_is_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and "op1_exact_dedup" in entry.oracle_sql()
    empty = documents(spark, SF_CHECK).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_CHECK).count() == 0
