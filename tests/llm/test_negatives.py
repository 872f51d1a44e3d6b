"""Hard negatives: the SQL twin's rule in plain Python on messy rows, chunks, waves, and bounds that prune."""

import math

import numpy as np
import pytest

from labelkit.llm import negatives as N

ROWS = "vec_id bigint, embedding array<float>, label int, score bigint, cell string"


def brute(rows, every=100, k=5, ratio=(80, 100), scale=256):
    """{(anchor, positive, rank, negative, positive score, negative score)} from (id, vector, label) rows."""
    sound = {
        (i, tuple(0.0 + x for x in v), y)
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    rows = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in sound]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, q, y in rows:
        if i % every:
            continue
        others = [(-dot(q, r), j, z == y) for j, r, z in rows if j != i]
        for score, p, _ in sorted(o for o in others if o[2])[:k]:
            fits = sorted(o for o in others if not o[2] and ratio[0] * -score <= ratio[1] * -o[0] <= ratio[1] * -score)
            out += [(i, p, n + 1, j, -score, -s) for n, (s, j, _) in enumerate(fits[:k])]
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, y, 0, "x") for i, v, y in rows], ROWS)
    found = N.mine_hard_negatives(df, **settings).collect()
    return sorted(
        (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found
    )


def clouds(n, width=8, seed=3, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    x = middle[rng.integers(0, centres, n)] + 0.2 * rng.normal(size=(n, width))
    x *= rng.uniform(0.2, 3, size=(n, 1))
    return [(i, [float(np.float32(c)) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 32 * 16, "wave_bytes": 8 * 28 * 2, "sample_rows": 10}])
def test_clouds_match_brute_force_in_any_chunk_and_wave_size(spark, settings):
    rows = clouds(600)
    assert mined(spark, rows, **settings) == brute(rows)


def test_messy_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = clouds(120, width=4) + [
        (200, None, 1), (201, [None, 1.0], 1), (202, [inf, 1.0], 1), (203, [nan], 1), (None, [1.0, 2.0], 1),
        (300, [1.0, 2.0, 3.0, 4.0], None), (400, [0.0] * 4, 1), (401, [-0.0] * 4, 2), (402, [], 2), (500, [], 0),
        (600, [1.0], 0), (601, [1.0, 0.0], 0), (602, [0.9], 1), (602, [0.95], 1), (602, [0.95], 1), (700, [-1.0], 2),
        (800, [1.0, 1.0], 1), (800, [1.0, 0.5], 1), (801, [1.0, 1.0], 1), (802, [1.0, 0.9], 0),
    ]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 3) for i in range(300)]  # one common vector: ties by id
    want = brute(rows)
    assert any(a == 1000 for a, *_ in want) and any(a == 800 for a, *_ in want)
    assert mined(spark, rows) == want
    assert mined(spark, rows, chunk_bytes=16 * 50, wave_bytes=8 * 24 * 3, sample_rows=20, directions=3) == want


def test_empty_tables_and_lonely_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 0)]) == []
    assert mined(spark, [(100, [1.0], 0), (1, [1.0], 0), (2, [1.0], 1)]) == [(100, 1, 1, 2, 65536, 65536)]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(1e5 * math.sin(i * j + 1))) for j in range(64)], i % 2) for i in range(220)]
    assert mined(spark, rows) == brute(rows)
    huge = [(0, [3e38, 1.0], 0), (1, [3e38, 2.0], 0), (2, [2e38, 1.0], 1)]
    assert len(mined(spark, huge)) == 1  # clipped, and equal then


def test_windows_prune_and_never_lose(spark):
    """On clustered rows most scores are never computed, and those that count always are."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 16))
    x = np.floor(256 * (middle[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 16))))
    space = N.Space(16, 1 << 28, N.choose_directions(x[:500], 16))
    norm, angles = N.norms_and_angles(x, space.directions)
    cell = angles.argmin(axis=1)
    wave = {
        "q": x[:50], "id": np.arange(50), "label": np.zeros(50, int), "number": np.arange(50),
        "open": np.ones((50, 1), bool), "asked": (0.9 * norm[:50, None] ** 2).astype(np.int64),
        "ceiling": np.full((50, 1), N.MOST),
    }
    task, scored = N.Search(space, wave, True, 10_000), 0
    for c in np.unique(cell):
        rows = np.flatnonzero(cell == c)
        rows = rows[np.argsort(angles[rows, c])]
        scored += task.add(
            rows, np.zeros(len(rows), int), c, x[rows].astype("<i4").tobytes(), angles[rows, c],
            angles[rows].min(axis=0), angles[rows].max(axis=0), norm[rows].min(), norm[rows].max(),
        )
    assert scored < 0.5 * 50 * 4000
    scores = (x @ x[:50].T).astype(np.int64)
    for a in range(50):
        want = {i for i in np.flatnonzero(scores[:, a] >= wave["asked"][a, 0]) if i != a}
        assert set(task.found.get((a, 0), (0, []))[1]) == want
