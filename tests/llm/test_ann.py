"""Multi-index hashing against exact search."""

import numpy as np
import pytest

from labelkit.llm import ann
from labelkit.llm.common import table
from tests.conftest import SF_CHECK


def exact(rows, every, k):
    """{query: [(rank, id, distance)]} by brute force; rows: (id, vector)."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in range(len(rows)):
        if ids[q] % every == 0:
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
            best = sorted((d[j], ids[j]) for j in range(len(rows)) if ids[j] != ids[q])[:k]
            out[ids[q]] = best
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in best}) for q, best in want.items())
    return hits / sum(len(b) for b in want.values())


@pytest.mark.parametrize("part_rows", [64, 8192])
def test_recall_on_the_test_table(spark, part_rows):
    df = table(spark, SF_CHECK, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = lists(ann.nearest_neighbours(df, part_rows=part_rows))
    want = exact(rows, 100, 10)
    assert recall(got, want) >= 0.9
    assert all(len(b) == 10 for b in got.values()) and got.keys() == want.keys()
    by = dict(rows)
    for q, best in got.items():
        for d, i in best:
            real = np.sqrt(((np.array(by[q], np.float64) - np.array(by[i], np.float64)) ** 2).sum())
            assert abs(d - real) < 1e-12


def test_probing_finds_every_code_within_the_radius(spark):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 62, 400, dtype=np.int64)
    for i in range(200, 400):
        flips = rng.choice(62, rng.integers(0, 9), replace=False)
        codes[i] = codes[i - 200] ^ sum(1 << int(f) for f in flips)
    vec = rng.normal(size=(400, 3))
    rows = [(i, vec[i].tolist(), int(codes[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "vkey bigint, vec array<double>, code bigint")
    unsigned = codes.view(np.uint64)
    for radius, part_rows in ((5, 8), (9, 50), (16, 1000), (64, 100)):
        found = ann.probe_tables(df, df.where("vkey < 40"), radius, 1000, 4, part_rows).collect()
        got = sorted((r["query"], r.vkey) for r in found)
        want = sorted(
            (q, j) for q in range(40) for j in range(400) if int(unsigned[q] ^ unsigned[j]).bit_count() <= radius
        )
        assert got == want  # each once


def test_messy_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 5), (100, [1.0, 0.0], 5), (1, [1.0, 0.0], 5), (2, [0.0, 1.0], 5), (3, None, 5), (4, [], 5),
        (5, [0.0, 0.0], 5), (6, [None, 1.0], 5), (7, [nan, 1.0], 5), (8, [inf, 1.0], 5), (None, [1.0, 1.0], 5),
        (9, [1.0, 2.0, 3.0], 5), (2, [0.0, 1.0], 5), (200, None, 5),
    ] + [(i, [1.0, 0.0], 5) for i in range(10, 30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, code int")
    got = lists(ann.nearest_neighbours(df))
    assert got[0] == [(0.0, i) for i in (1, 10, 11, 12, 13, 14, 15, 16, 17, 18)]
    assert got[100][:3] == [(0.0, 0), (0.0, 1), (0.0, 10)] and set(got) == {0, 100}
    few = lists(ann.nearest_neighbours(df.where("vec_id in (0, 2)")))
    assert [i for _, i in few[0]] == [2]
    assert ann.nearest_neighbours(df.limit(0)).count() == 0
    assert ann.nearest_neighbours(df.where("vec_id = 0")).count() == 0


def test_short_lists_are_completed(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 16)) * 0.01
    x[0] += 9  # far from everything: nothing within the learned radius
    x[:, 0] += np.sign(x[:, 0])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = lists(ann.nearest_neighbours(df, every=30, coverage=0.0))
    assert {q: len(b) for q, b in got.items()} == {0: 10, 30: 10}
