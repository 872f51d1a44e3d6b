"""Exact dedup and SimHash against brute force, with the messy cases."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from labelkit.llm.exact_dedup import deduplicate, duplicate_groups, frequent_items
from labelkit.llm.simhash import (
    components,
    drop_near_duplicates,
    fingerprint,
    near_duplicates,
    subtree_links,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, id string"
MESSY = [
    (1, "a b c d", "en", "s", 7, True, "x"),
    (2, "a b c d", None, None, None, None, None),
    (2, "a b c d", None, None, None, None, None),
    (3, None, "en", "s", 0, False, "y"),
    (4, "", "en", "s", 0, False, "y"),
    (None, "only here", "en", "s", 0, False, "y"),
    (None, "and here", "en", "s", 0, False, "y"),
    (None, None, "en", "s", 0, False, "y"),
    (7, "w " * 300_000, "en", "s", 0, False, "y"),
    (8, "A b c \x0b d é", "en", "s", 0, False, "y"),
    (9, "two texts", "en", "s", 0, False, "y"),
    (9, "one id", "en", "s", 0, False, "y"),
]


def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA)


def brute_groups(rows):
    by = {}
    for i, text in rows:
        by.setdefault(text or "", []).append(i)
    out = []
    for text, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_exact_groups_on_messy_rows(spark):
    got = duplicate_groups(messy(spark)).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups([(r[0], r[1]) for r in MESSY])


@pytest.mark.parametrize("theta", [0.5, 0.05, 0.001])
def test_exact_groups_with_a_hot_text(spark, theta):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(60)}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = duplicate_groups(df, theta=theta).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(rows)


def test_frequent_items_are_all_found_and_bounded(spark):
    rng = random.Random(2)
    rows = [("a",)] * 300 + [("b",)] * 150 + [(f"x{rng.randrange(400)}",) for _ in range(550)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "item string").repartition(9)
    found = {r.item for r in frequent_items(df, 0.1).collect()}
    assert {"a", "b"} <= found and len(found) <= 20


def test_deduplicate_keeps_columns_and_one_row_a_text(spark):
    kept = deduplicate(messy(spark))
    assert kept.columns == messy(spark).columns
    rows = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert len({t for _, t in rows}) == len(rows) == 8
    assert (2, "a b c d") in rows and (4, "") in rows


def test_empty_tables(spark):
    empty = messy(spark).limit(0)
    assert duplicate_groups(empty).count() == 0 and deduplicate(empty).count() == 0
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, budget=2):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted([(doc, f"{fps[i]:016x}", least.get(root(i))) for i, (doc, _) in enumerate(rows)], key=repr)


def test_fingerprint_is_sparks_xxhash64(spark):
    import numpy as np

    text = "The quick\tbrown fox é jumps\n over the lazy dog " * 5
    assert fingerprint(text) == brute_fingerprint(text)
    one = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert int(np.int64(one).view(np.uint64)) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_near_duplicates_on_messy_rows(spark):
    got = near_duplicates(messy(spark)).select("id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components([(r[0], r[1]) for r in MESSY])
    kept = drop_near_duplicates(messy(spark))
    assert kept.columns == messy(spark).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 7), (False, 8), (False, 9), (False, 9), (True, 0), (True, 0)
    ]


def near_texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows, seeds = [], [[rng.choice(words) for _ in range(120)] for _ in range(6)]
    for i in range(n):
        text = list(rng.choice(seeds)) if rng.random() < 0.8 else [rng.choice(words) for _ in range(80)]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("leaf_rows", [4, 64, 32768])
def test_components_match_brute_force_at_any_leaf_size(spark, leaf_rows):
    rows = near_texts(300, 3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = near_duplicates(df, leaf_rows=leaf_rows).select("id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_trie_walk_finds_every_close_pair():
    import numpy as np

    rng = np.random.default_rng(5)
    for budget in (0, 1, 2, 3):
        base = rng.integers(0, 1 << 63, 40, dtype=np.uint64) << np.uint64(1)
        near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 4), replace=False))) for b in base]
        values = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64), np.arange(20, dtype=np.uint64)]))
        _, label = subtree_links(values, values, 0, 0, budget)
        want = np.arange(len(values))
        close = np.bitwise_count(values[:, None] ^ values[None]) <= budget
        for _ in range(len(values)):
            want = np.where(close, want[None], len(values)).min(1)
        assert (label == want).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "u bigint, v bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, 501: 500}
