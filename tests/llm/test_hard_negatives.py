"""Hard negatives against all inner products."""

import math

import numpy as np

from rastro.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string, block string"


def plain(rows, every=100, positives=5, negatives=5, percent=80):
    whole = [
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y)
        for i, v, y, *_ in rows
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a in sorted({i for i, _, _ in whole if i % every == 0}):
        _, v, y = min((r for r in whole if r[0] == a), key=lambda r: (r[2], r[1]))
        scored = sorted(
            (-sum(p * q for p, q in zip(v, w)), i, z) for i, w, z in whole if i != a and len(w) == len(v)
        )
        for s, i, _ in [r for r in scored if r[2] == y][:positives]:
            fits = [r for r in scored if r[2] != y and percent * -s <= 100 * -r[0] <= 100 * -s]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **given):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(table, **given).collect()))


def test_equals_all_pairs(spark, monkeypatch):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 16))
    rows = [
        (i, [float(x) for x in centres[i % 6] + 0.8 * draw.normal(size=16)], int(draw.integers(0, 3)))
        for i in range(900)
    ]
    expected = plain(rows, every=20)
    assert len(expected) > 500
    assert mined(spark, rows, every=20) == expected
    # Many slices, blocks that split clusters, and more centres.
    monkeypatch.setattr(hn, "SLICE_NUMBERS", 16 * 200)
    monkeypatch.setattr(hn, "BLOCK_NUMBERS", 16 * 7)
    monkeypatch.setattr(hn, "MEMBERS", 5)
    assert mined(spark, rows, every=20) == expected


def test_ties_copies_and_small_numbers(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(-1, 2, 3) / 256], int(i % 4)) for i in range(400)]
    rows += [(i, [1 / 256, 1 / 256, 1 / 256], 1) for i in range(1000, 1150)]
    assert mined(spark, rows, every=50) == plain(rows, every=50)
    assert mined(spark, rows, every=50, positives=2, negatives=9, percent=100) == plain(
        rows, every=50, positives=2, negatives=9, percent=100
    )


def test_odd_rows(spark):
    good = [(i, [0.5 + i / 1000, 0.25], i % 2) for i in range(40)]
    odd = [
        (0, [0.5, 0.25], 1),
        (7, [0.9, 0.9], 0),
        (7, [0.9, 0.9], 1),
        (None, [0.5, 0.5], 0),
        (50, None, 0),
        (51, [0.5, 0.5], None),
        (52, [0.5, None], 0),
        (53, [float("nan"), 0.5], 0),
        (54, [float("inf"), 0.5], 1),
        (60, [], 0),
        (61, [], 1),
        (62, [0.5], 0),
        (70, [0.0, 0.0], 0),
        (71, [0.0, 0.0], 1),
        (80, [-1.0, -1.0], 0),
    ]
    assert mined(spark, good + odd, every=10) == plain(good + odd, every=10)
    assert mined(spark, [], every=10) == []
    assert mined(spark, [(1, [0.5], 0)], every=10) == []


def test_a_walk_stops_early(spark):
    """Most candidates are never scored, and the result is whole."""
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(20_000, 8)).astype(np.float64)
    vectors[:200] = np.array([40.0] * 8) + draw.normal(size=(200, 8))
    anchor = np.array([[40.0] * 8])
    sizes = np.linalg.norm(vectors, axis=1)
    unit = anchor[0] / np.linalg.norm(anchor[0])
    bounds = sizes * (vectors @ unit / sizes)
    order = np.argsort(-bounds)
    ids, labels = np.arange(20_000), np.zeros(20_000, np.int64)
    best = hn._Best(np.array([-hn.TOP]), 5)
    looked = hn.walk(
        bounds[order], ids[order], labels, np.round(vectors[order]), np.linalg.norm(anchor, axis=1),
        np.array([0]), np.array([-1]), np.array([0]), anchor, np.array([hn.TOP]), best, True,
    )
    assert looked <= hn.FIRST_STEP * 3
    scores = (np.round(vectors) @ anchor[0]).astype(int)
    assert best.ids[0].tolist() == sorted(range(20_000), key=lambda i: (-scores[i], i))[:5]
