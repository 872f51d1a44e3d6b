"""Feistel sharding: a true permutation both ways, shard law, layout independence, messy rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

from labelkit.llm.sharding import Permutation, address, number_at, shard_rows, write_shards

DOCS = "doc_id bigint, text string, shard string, row string, slot int"


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 65_536, 99_991])
def test_permutation_is_one_to_one_and_inverts(n):
    p = Permutation(n)
    x = np.arange(n)
    y = p.forward(x)
    assert sorted(y.tolist()) == x.tolist()
    assert (p.inverse(y) == x).all()
    if n > 100:
        assert (y != Permutation(n, seed=7).forward(x)).mean() > 0.9
        assert abs(np.corrcoef(x, y)[0, 1]) < 0.1


def test_large_numbers_stay_exact():
    n = 3 * 10**18 + 1
    p = Permutation(n)
    x = np.array([0, 1, 2**31, 2**32 + 1, 10**15, n - 1])
    y = p.forward(x)
    assert ((y >= 0) & (y < n)).all() and (p.inverse(y) == x).all()


def test_address_is_computable_both_ways():
    shard, slot = address(10_007, np.arange(10_007))
    assert (number_at(10_007, shard, slot) == np.arange(10_007)).all()


def brute(rows, shards=40):
    """Numbers in (id, md5) order, then a plain loop of the network."""
    from hashlib import md5

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, md5((r[1] or "").encode()).hexdigest()))
    shard, slot = address(len(rows), np.arange(len(rows)), shards)
    return Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), int(a), int(b))
        for (i, t, *_), a, b in zip(order, shard, slot)
    )


MESSY = [
    *[(i, f"text {i % 5}", "s", None, i) for i in range(200)],
    *[(7, "the same row", "s", "r", 1)] * 90,
    *[(None, None, None, None, None)] * 3,
    (None, "", "x", None, 0),
    (1_000, "größe " * 30_000, "x", None, 0),
    (-5, "\u0000퟿𝄞", "x", None, 0),
]


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_match_brute_force_in_any_layout(spark, parts):
    docs = spark.createDataFrame(MESSY, DOCS).repartition(parts)
    got = shard_rows(docs).collect()
    assert Counter((r.id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == brute(MESSY)
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in held.values())
    sizes = [len(s) for s in held.values()]
    assert len(held) == 40 and max(sizes) - min(sizes) <= 1


def test_fewer_rows_than_shards_and_empty_table(spark):
    docs = spark.createDataFrame(MESSY[:3], DOCS)
    assert len({(r.shard, r.slot) for r in shard_rows(docs).collect()}) == 3
    empty = shard_rows(docs.limit(0))
    assert empty.collect() == [] and empty.columns == ["id", "size", "text_crc32", "number", "shard", "slot"]


def test_text_ids_are_numbered_too(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "z")], "doc_id string, text string")
    assert {r.id: r.number for r in shard_rows(docs).collect()} == {None: 0, "a": 1, "b": 2}


def test_written_shards_hold_whole_rows_in_slot_order(spark, tmp_dir):
    docs = spark.createDataFrame(MESSY, DOCS)
    out = write_shards(docs, f"{tmp_dir}/shards", shards=6)
    rows = out.collect()
    assert Counter(tuple(r.row) for r in rows) == Counter(MESSY)
    # a row stands where the plan of the same table says, whatever further columns it has
    plan = Counter((r.id, r.shard, r.slot) for r in shard_rows(docs, shards=6).collect())
    assert Counter((r.row.doc_id, r.shard, r.slot) for r in rows) == plan
    one = spark.read.parquet(f"{tmp_dir}/shards/shard=3").coalesce(1).collect()
    assert sorted(r.slot for r in one) == list(range(len(one)))
