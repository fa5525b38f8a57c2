"""Hard negatives against brute force; the vertical scan against whole products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import hard_negatives, queries

from ..oracle import connect, differences
from .tables import ROOT

SCHEMA = "vec_id long, embedding array<double>, label string, row string, tile string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def takes_part(row):
    return None not in row and all(x is not None and math.isfinite(x) for x in row[1])


def brute(rows, mod, positives=5, negatives=10):
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if takes_part((i, v, label))]
    out = []
    for i, v, label in rows:
        if i % mod:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows)
        for s, j, _ in [x for x in scored if x[2] == label and x[1] != i][:positives]:
            inside = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(inside)]
    return sorted(out)


def mined(frame_, mod, **other):
    return sorted(map(tuple, hard_negatives.mine(frame_, F.col("vec_id") % mod == 0, **other).collect()))


@pytest.mark.parametrize("tile_rows", [64, 100_000])
def test_equal_brute_force(spark, tile_rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 7)
    draw = random.Random(3)
    rows = []
    for i in range(400):
        near = draw.choice("abc")
        rows.append((i, [round(draw.gauss(0.2, 0.3), 2 if draw.random() < 0.3 else 9) for _ in range(20)], near))
    rows += [(1000 + i, rows[5][1], draw.choice("ab")) for i in range(120)]  # a hot vector: ties
    assert mined(frame(spark, rows), 20, tile_rows=tile_rows) == brute(rows, 20)


def test_awkward_rows(spark):
    good = [(i, [math.sin(i), math.cos(i), 0.5], "ab"[i % 2]) for i in range(60)]
    bad = [(100, None, "a"), (110, [1.0, None, 2.0], "a"), (120, [1.0, float("nan"), 2.0], "a"), (130, [float("inf")] * 3, "b"),
           (140, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], "a")]
    odd = [(200, [], "a"), (210, [0.0, 0.0, 0.0], "b"), (220, [0.5], "a"), (231, [1.0, 0.5, 0.25, 9.0], "b")]
    want = brute(good + odd, 10)
    assert mined(frame(spark, good + bad + odd), 10) == want and want
    assert mined(frame(spark, bad), 10) == []
    assert mined(frame(spark, []), 10) == []
    assert mined(frame(spark, [(0, [1.0], "a")]), 10) == []
    twice = [(0, [1.0, 1.0], "a"), (0, [1.0, 1.0], "a"), (1, [1.0, 0.9], "a"), (2, [0.5, 0.5], "b"), (2, [0.5, 0.5], "b")]
    got = mined(frame(spark, twice), 10)
    assert got == sorted([(0, 1, r, 2, 256 * 256 + 256 * 230, 256 * 256) for r in (1, 2)] * 2)


def test_values_beyond_the_bound(spark):
    rows = [(0, [1e300, -1e300], "a"), (1, [1e308, 0.0], "a"), (2, [0.5, 0.0], "b"), (3, [40_000.25, 3.0], "b")]
    most = 1 << hard_negatives.LIMIT_BITS
    whole = {0: (most, -most), 1: (most, 0), 2: (128, 0), 3: (math.floor(40_000.25 * 256), 768)}
    score = lambda a, b: sum(x * y for x, y in zip(whole[a], whole[b]))
    low, high = 30 * score(0, 1), 90 * score(0, 1)
    want = [(0, 1, 1, n, score(0, 1), score(0, n)) for n in (2, 3) if low <= 100 * score(0, n) <= high]
    assert mined(frame(spark, rows), 10) == want


@pytest.mark.parametrize("kind", [np.float32, np.float64, np.int64])
def test_scan_is_exact_and_shrinks(kind):
    draw = np.random.default_rng(5)
    columns = draw.integers(-60, 60, (32, 3000)).astype(kind)
    query = np.trunc(draw.integers(-60, 60, 32) * np.linspace(1, 0, 32) ** 3).astype(kind)
    tile, scores = hard_negatives.Tile(np.arange(3000), columns), query.astype(np.int64) @ columns.astype(np.int64)
    rows, found = hard_negatives.nearest(tile, query, 7)
    want = sorted(range(3000), key=lambda r: (-scores[r], r))[:7]
    assert rows.tolist() == want and found.astype(int).tolist() == scores[want].tolist()
    seen = []

    def alive(lower, upper):
        seen.append(len(lower))
        return upper >= np.sort(lower)[-7]

    tile.scan(query, alive)
    assert seen[-1] < 300 and all(a >= b for a, b in zip(seen, seen[1:]))
    top = int(scores.max())
    windows = [(top // 4, top // 2), (0, 10), (top + 1, top + 9)]
    for (least, greatest), (rows, _) in zip(windows, hard_negatives.in_windows(tile, query, windows, 4)):
        inside = [r for r in range(3000) if least <= scores[r] <= greatest]
        assert rows.tolist() == sorted(inside, key=lambda r: (-scores[r], r))[:4]


def test_query_equals_its_sql(spark):
    class Query:
        run, sql = staticmethod(queries.op11_hard_negatives), queries.SQL["op11_hard_negatives"]

    assert differences(spark, connect(ROOT), ROOT, Query)[0] is None
