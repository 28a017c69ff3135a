from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.ann import search_neighbours
from millrace.llm.embedding_dedup import near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, rep int, row string, vector int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "r", 2) for i, v in rows], SCHEMA)


def clusters(draw, n, length=8):
    out = []
    while len(out) < n:
        centre = draw.normal(size=length)
        for _ in range(draw.integers(1, 12)):
            out.append((centre + draw.normal(size=length) * draw.choice([0, 0.02, 0.1, 0.2])) * draw.choice([1, 1, 1e-200, 1e150]))
    return [(i, [float(x) for x in v]) for i, v in enumerate(out[:n])]


def brute(rows, threshold):
    unit = [np.array(v) / np.abs(v).max() for _, v in rows]
    unit = np.array([v / np.sqrt((v * v).sum()) for v in unit])
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    ids = np.array([i for i, _ in rows])
    label = ids.copy()
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(rows))])
        if (new == label).all():
            return near.sum(axis=1), label
        label = new


@pytest.mark.parametrize(("home", "pivots"), [(4096, 1024), (16, 1024), (16, 3)])
def test_links_and_components(spark, home, pivots):
    rows = clusters(np.random.default_rng(home + pivots), 300)
    links, label = brute(rows, 0.95)
    assert links.max() > 3
    found = {r.vec_id: r for r in near_vectors(table(spark, rows), home=home, max_pivots=pivots).collect()}
    for (i, _), n, c in zip(rows, links, label, strict=True):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (n, c, i == c)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]),
            (9, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0]), (None, [1.0, 2.0]), (None, [5.0, -3.0]), (10, [-1.0, -2.0])]
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(table(spark, rows)).collect()]
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10)] + [(9, 3, 8, False)] * 2 + [(8, 3, 8, True), (None, 3, 8, False), (None, 0, None, True)]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert near_vectors(table(spark, [])).collect() == []
    assert near_vectors(table(spark, [(1, [0.0]), (1, None)])).count() == 2


def test_one_large_group_of_copies_and_near_copies(spark):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=6)
    rows = [(i, [float(x) for x in centre]) for i in range(200)]
    rows += [(200 + i, [float(x) for x in centre + draw.normal(size=6) * 0.01]) for i in range(200)]
    found = near_vectors(table(spark, rows), home=32).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(399, 0)}


def nearest(rows, query, k):
    own, q = query
    gaps = [(float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), i) for at, (i, v) in enumerate(rows) if at != own]
    return sorted(gaps)[:k]


@pytest.mark.parametrize("shard", [4096, 120])
def test_recall_against_brute_force(spark, shard):
    draw = np.random.default_rng(shard)
    rows = [(i, [float(x) for x in draw.normal(size=16)]) for i in range(700)]
    rows += [(700 + i, [float(x) for x in np.array(rows[0][1]) + draw.normal(size=16) * 0.01]) for i in range(200)]
    found = search_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, shard=shard).collect()
    hits = total = 0
    for at in range(0, 900, 20):
        own = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == at)
        assert [r[0] for r in own] == list(range(1, 11)) and [r[2] for r in own] == sorted(r[2] for r in own)
        want = nearest(rows, (at, rows[at][1]), 10)
        hits += len({i for _, i in want} & {r[1] for r in own})
        total += 10
        for _, i, score in own:
            assert abs(score - np.sqrt(((np.array(rows[i][1]) - np.array(rows[at][1])) ** 2).sum())) < 1e-12
    assert hits >= 0.95 * total


def test_odd_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (100, [1.0, 1e-3]), (7, None), (8, [0.0, 0.0]), (200, [NAN, 1.0]), (9, [1.0])]
    rows += [(None, [3.0, 0.0]), (100, [1.0, 1e-3])]
    found = search_neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, k=3).collect()
    own = lambda q: [(r["rank"], r.vec_id, r.score) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])]
    assert own(0) == [(1, 3, 0.0), (2, 5, 0.0), (3, 100, 1e-3)]
    assert sorted(own(100)) == [(1, 100, 0.0), (1, 100, 0.0), (2, 0, 1e-3), (2, 0, 1e-3), (3, 3, 1e-3), (3, 3, 1e-3)]
    few = search_neighbours(table(spark, rows[:2]), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 5)]
    assert search_neighbours(table(spark, rows[:1]), F.col("vec_id") == 0).collect() == []
    assert search_neighbours(table(spark, []), F.lit(True)).collect() == []
    assert search_neighbours(table(spark, rows), F.lit(False)).collect() == []


@pytest.mark.parametrize(("kind", "shard"), [("far row", 4096), ("tight", 4096), ("tighter", 4096), ("huge", 4096), ("several shards", 1024)])
def test_recall_on_hard_rows(spark, kind, shard):
    """4 096 vectors of 64 dimensions, of which some would cost a search its digits."""
    draw = np.random.default_rng(11)
    x = draw.normal(size=(4096, 64))
    if kind == "far row":
        x[77] = 1e30
    elif kind == "tight":
        x[:200] = x[0] + draw.normal(size=(200, 64)) * 1e-6
    elif kind == "tighter":
        x[:1000] = x[0] + draw.normal(size=(1000, 64)) * 1e-9
    elif kind == "huge":
        x[100], x[5] = 1e200, -1e160
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    found = search_neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, shard=shard).collect()
    hits = 0
    for at in range(0, 4096, 100):
        with np.errstate(over="ignore"):
            far = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        far[at] = np.inf
        want = set(np.lexsort((np.arange(4096), far))[:10].tolist())
        hits += len(want & {r.vec_id for r in found if r.query_id == at})
    assert hits >= 0.95 * 410
