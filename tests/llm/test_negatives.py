import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id int, part string, dim long"


def plain(rows, is_anchor, k_pos=5, k_neg=10):
    held = []
    for at, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((at, i, [math.floor(256 * x) for x in v], label))
    last = lambda i: (i is None, i or 0)
    out = []
    for at, i, v, label in held:
        if i is None or not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, l) for bt, j, w, l in held if bt != at and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for p, pid, _ in [s for s in scored if s[2] == label][:k_pos]:
            far = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:k_neg]
            out += [(i, pid, r + 1, j, p, s) for r, (s, j, _) in enumerate(far)]
    return sorted(out, key=str)


def rows_of(seed, n, dim, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(labels, dim))
    return [(int(i), [float(x) for x in at[i % labels] + spread * rng.normal(size=dim)], int(i % labels)) for i in range(n)]


def run(spark, rows, **given):
    frame = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], SCHEMA)
    found = negatives.mine(frame, F.col("id") % 10 == 0, **given)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("n,dim,spread", [(300, 8, 0.7), (250, 2, 2.0)])
def test_negatives_equal_brute_force(spark, monkeypatch, n, dim, spread):
    monkeypatch.setattr(negatives, "PART_ROWS", 60)
    monkeypatch.setattr(negatives, "GROUP_ROWS", 9)
    monkeypatch.setattr(negatives, "CLUSTER_ROWS", 4)
    monkeypatch.setattr(negatives, "STEP", 8)
    rows = rows_of(n, n, dim, spread=spread)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 300 and run(spark, rows) == want


def test_nulls_ties_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.5, 0.2], 2), (3, [0.5, 0.2], 2), (3, [0.5, 0.2], 2),
            (None, [0.5, 0.2], 2), (9007199254740993, [0.6, 0.2], 2), (4, None, 1), (5, [1.0, None], 2), (6, [nan, 1.0], 2),
            (7, [inf, 1.0], 2), (8, [1.0, 1.0], None), (10, [0.0, 0.0], 1), (20, [-1.0, 0.0], 1), (30, [1.0, 2.0, 3.0], 1),
            (31, [1.0, 2.0, 2.5], 1), (32, [0.5, 1.0, 1.0], 2), (40, [], 1), (41, [], 1), (42, [], 2), (50, [0.9, 0.0], 3)]
    want = plain(rows, lambda i: i % 10 == 0)
    assert any(r[3] is None for r in want) and any(r[3] == 9007199254740993 for r in want) and any(r[0] == 40 for r in want)
    assert run(spark, rows) == want
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) * 2 ** 20 for _ in range(4)], i % 2) for i in range(60)]
    assert run(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_walk_stops_before_the_end():
    rows = rows_of(1, 4000, 8, labels=40, spread=0.2)
    part = {"v": np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64), "row": np.arange(4000),
            "order": np.arange(4000), "label": np.array([label for *_, label in rows])}
    anchors = part["v"][::40]  # all of label 0
    x, _ = negatives.unit(anchors.astype(float))
    centre, _ = negatives.unit(x.sum(axis=0)[None])
    width = float(np.arccos(np.clip(x @ centre[0], -1, 1)).max())
    shared = negatives.SharedList(part, centre[0], width)
    assert (np.diff(shared.bound) <= 0).all()
    exact = negatives.products(anchors, shared.rows["v"])
    lengths = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    assert (exact <= lengths[:, None] * shared.bound[None] + 1e-6).all()
    seekers = [negatives.Positives(40 * i, 0, 5) for i in range(len(anchors))]
    assert shared.walk(anchors, seekers) < 0.5 * exact.size
