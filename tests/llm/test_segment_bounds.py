"""Hard negatives by segment bounds against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedwatch.llm.queries import QUERIES
from bedwatch.llm.segment_bounds import FEW, Rows, _left, _levels, any_score, best, mine_negatives, summaries

SCHEMA = "vec_id long, embedding array<float>, label int, block string, score double, key int"


def usable(r):
    return r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])


def brute(rows, positives=5, top=10, share=(30, 90), every=100):
    """Every anchor row against every row, with whole numbers of Python."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label, *_ in filter(usable, rows)]
    out = []
    for anchor, v, label in rows:
        if anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in rows if len(w) == len(v)]
        near = sorted((-s, i) for s, i, other in scored if other == label and i != anchor)[:positives]
        for minus, positive in near:
            hard = sorted((-s, i) for s, i, other in scored
                          if other != label and share[0] * -minus <= 100 * s <= share[1] * -minus)[:top]
            out += [(anchor, positive, k, i, -minus, -s) for k, (s, i) in enumerate(hard, 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in mine_negatives(df, **options).collect())


def random_rows(n, length, seed, clusters=0, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, clusters), length))
    v = rng.normal(size=(n, length)) * (0.15 if clusters else 1) + (centres[rng.integers(0, clusters, n)] if clusters else 0)
    return [(i, [float(x) for x in r], int(rng.integers(0, labels)), "x", 1.0, 2) for i, r in enumerate(v)]


@pytest.mark.parametrize("length, clusters, blocks", [(64, 0, 4096), (16, 6, 150), (3, 3, 70), (1, 0, 100)])
def test_equals_brute_force(spark, length, clusters, blocks):
    rows = random_rows(600, length, length, clusters)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, rows_per_block=blocks, anchors_per_block=3) == brute(rows)


def test_query_equals_brute_force_on_the_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    turned = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, sf).collect())
    assert got == brute(turned) and got


def test_odd_rows(spark):
    """Nulls, odd components, ties, repeated rows and anchors, mixed lengths, one label with most rows, taken names."""
    rng = random.Random(2)
    rows = random_rows(300, 8, 5, clusters=4, labels=3)
    rows = [(i, v, 0 if i % 3 else label, *rest) for i, v, label, *rest in rows]
    rows += rows[:40] + rows[200:201] * 3 + [(700, rows[3][1], 1, None, None, None)]  # repeated rows, anchors 0 and 200 too
    rows += [(400, None, 1, "x", 1.0, 1), (401, [1.0, None] + [0.0] * 6, 1, "x", 1.0, 1), (None, [0.1] * 8, 1, "x", 1.0, 1),
             (402, [float("nan")] + [0.0] * 7, 1, "x", 1.0, 1), (403, [float("inf")] + [0.0] * 7, 1, "x", 1.0, 1),
             (500, [0.5] * 8, None, "x", 1.0, 1), (600, [0.0] * 8, 1, None, None, None), (800, [], 1, "x", 1.0, 1), (801, [], 1, "x", 1.0, 1),
             (802, [], 2, "x", 1.0, 1), (900, [0.25, 0.5], 1, "x", 1.0, 1), (901, [0.5, 0.5], 1, "x", 1.0, 1), (902, [0.25, 0.25], 2, "x", 1.0, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert mined(df) == want
    assert mined(df, rows_per_block=60, anchors_per_block=2) == want
    assert {800, 900} <= {r[0] for r in want}


def test_empty_and_no_anchor(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [0.5], 1, "x", 1.0, 1), (2, [0.5], 2, "x", 1.0, 1)], SCHEMA)) == []
    one = [(100, [0.5, 0.5], 1, "x", 1.0, 1)]
    assert mined(spark.createDataFrame(one, SCHEMA)) == []


def test_own_anchors_and_parameters(spark):
    rows = random_rows(200, 12, 8, clusters=3, labels=2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = mined(df, anchors=F.col("vec_id") % 50 == 0, positives=2, top=3, share=(10, 80))
    assert got == brute(rows, 2, 3, (10, 80), 50)


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-200, 200, (20, 37)).astype(float), rng.integers(-90, 300, (50, 37)).astype(float)
    exact, widths = a @ b.T, []
    for n in _levels(37):
        (m, d), (k, e) = summaries(a, n), summaries(b, n)
        low, high = m @ k.T - d @ e.T, m @ k.T + d @ e.T
        assert (low <= exact + 1e-6).all() and (high >= exact - 1e-6).all()
        widths.append((high - low).mean())
    assert _levels(37) == [1, 2, 4, 8] and widths == sorted(widths, reverse=True)


def test_refinement_leaves_few_rows_of_clustered_vectors():
    """Where vectors differ in the means of their segments, most rows leave before they are scored, level by level."""
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(20, 8)), 8, axis=1)
    v = np.floor((centres[np.arange(2000) % 20] + 0.05 * rng.normal(size=(2000, 64))) * 256).astype(np.int64)
    rows = Rows.read(64, np.arange(2000).tobytes(), (np.arange(2000) % 20).tobytes(), v.tobytes())
    mine = slice(0, 1)
    able = np.ones((1, 2000), bool)

    def needed(able, low, high):
        return high >= np.sort(low[0])[-10]

    at, _, left = _left(rows, mine, rows, able, needed)
    assert left == sorted(left, reverse=True) and left[-1] <= 200 < 2000
    exact = (v[:1] @ v.T)[0]
    assert set(np.argsort(-exact, kind="stable")[:10]) <= set(at.tolist())


def test_large_numbers_are_scored_exactly(spark):
    rows = [(0, [3e5, 1.0], 1, "x", 1.0, 1), (1, [3e5, 2.0], 1, "x", 1.0, 1), (2, [2.0e5, -1.0], 2, "x", 1.0, 1)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []


def test_blocks_of_anchors_are_not_broadcast(spark, capsys):
    """A copy of all anchors for each block of rows does not fit the driver; more blocks than groups, results as before."""
    rows = random_rows(600, 12, 4, clusters=5, labels=3)
    hard = mine_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), rows_per_block=10, anchors_per_block=2)
    hard.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert sorted(tuple(r) for r in hard.collect()) == brute(rows)


def test_results_of_many_blocks_are_no_more_than_those_of_one():
    """What anchors find in block after block is kept together: as many as wanted, ties by id, whatever the order of blocks."""
    rng = np.random.default_rng(7)
    v = rng.integers(-4, 5, (3 * FEW, 6))  # few different scores, so many ties
    labels = rng.integers(0, 3, len(v))

    def block(at):
        return Rows.read(6, at.astype(np.int64).tobytes(), labels[at].astype(np.int64).tobytes(), v[at].astype(np.int64).tobytes())

    anchors, parts = block(np.arange(0, len(v), 100)), np.array_split(np.arange(len(v)), 9) + [np.arange(0)]
    for order in (parts, parts[::-1], [np.arange(len(v))]):
        found = any_score(len(anchors.keys), 5)
        for part in order:
            best(found, anchors, block(part))
        a, _, key, score = found.results()
        assert len(a) == 5 * len(anchors.keys)
        for k, anchor in enumerate(anchors.keys):
            scores = v @ v[anchor]
            others = [i for i in range(len(v)) if i != anchor and labels[i] == labels[anchor]]
            want = sorted(others, key=lambda i: (-scores[i], i))[:5]
            assert key[a == k].tolist() == want and score[a == k].tolist() == scores[want].tolist()
