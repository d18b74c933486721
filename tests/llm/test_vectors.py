import math
import random

import numpy as np
import pytest

from faremill.llm import grid_join, posting_lists
from faremill.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, rep string, n_links string"


def clouds(count, size, seed, spread=0.1):
    """Vectors in tight clouds, with copies."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(max(count // 12, 1), size))
    rows = centres[draw.integers(0, len(centres), count)] + spread * draw.normal(size=(count, size))
    rows[::9] = rows[0]
    return rows.astype(np.float32)


def brute_links(vectors, least):
    """n_links and component of every id, from all pairs."""
    ids = sorted(vectors)
    links = {i: set() for i in ids}
    for a in range(len(ids)):
        for b in range(a):
            (x, lx), (y, ly) = vectors[ids[a]], vectors[ids[b]]
            if lx is not None and lx == ly and _good(x) and _good(y) and len(x) == len(y) and _cosine(x, y) >= least:
                links[ids[a]].add(ids[b])
                links[ids[b]].add(ids[a])
    found = {}
    for start in ids:
        if start not in found:
            group, todo = {start}, [start]
            while todo:
                new = links[todo.pop()] - group
                group |= new
                todo += new
            found |= {i: min(group) for i in group}
    return {i: (len(links[i]), found[i]) for i in ids}


def _good(x):
    return bool(x) and all(v is not None and math.isfinite(v) for v in x) and any(x)


def _cosine(x, y):
    x, y = np.array(x, float), np.array(y, float)
    return float(x @ y / math.sqrt((x @ x) * (y @ y)))


ODD = [None, [], [0.0, 0.0], [1.0, None], [1.0, NAN], [1.0, INF], [1e-30, 0.0], [3e30, 0.0], [2.0], [1.0, 1e-6], [-1.0, 0.0], [1.0, -0.0]]


@pytest.mark.parametrize("block", [512, 5])
@pytest.mark.parametrize("size", [2, 20])
def test_links_equal_those_of_all_pairs(spark, block, size):
    rows = clouds(150, size, size)
    vectors = {i * 3: (r.tolist(), [0, 0, 1, None][i % 4]) for i, r in enumerate(rows)}
    frame = spark.createDataFrame([(i, v, label, "x", "y") for i, (v, label) in vectors.items()], SCHEMA)
    found = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_vectors(frame, 0.98, block).collect()}
    assert found == brute_links(vectors, 0.98)
    assert sum(n for n, _ in found.values()) > 0


def test_odd_vectors_link_with_nothing(spark):
    vectors = {i: (v, 1) for i, v in enumerate(ODD)} | {100 + i: (v, None) for i, v in enumerate(ODD)}
    rows = [(i, v, label, "", "") for i, (v, label) in vectors.items()]
    frame = spark.createDataFrame(rows + rows[-3:] + [(None, [1.0, 0.0], 1, "", "")], SCHEMA)
    found = grid_join.near_vectors(frame).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found if r.vec_id is not None} == brute_links(vectors, 0.98)
    assert len(found) == len(rows) + 1
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None] == [(0, None, None)]
    assert grid_join.near_vectors(frame.limit(0)).collect() == []


def test_cosines_at_the_limit():
    x = np.array([[1.0, 0.0]])
    exact = np.array([[0.98, math.sqrt(1 - 0.98 ** 2)], [0.98, 0.2], [0.9799, math.sqrt(1 - 0.9799 ** 2)]])
    assert grid_join.linked(x, exact, 0.98).tolist()[0][1:] == [_cosine(x[0], exact[1]) >= 0.98, False]


def test_grid_query_against_all_pairs(spark):
    path = "/root/testdata/sf0.01"
    vectors = {r.vec_id: (r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()}
    found = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op2_grid_order_join"](spark, path).collect()}
    assert found == brute_links(vectors, 0.98)


def brute_nearest(vectors, queries, top):
    found = []
    for q in queries:
        scored = sorted(((-_cosine(vectors[q], v), i) for i, v in vectors.items() if i != q and _good(v) and len(v) == len(vectors[q])))
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:top], 1)]
    return found


def recall(found, expected):
    sets = lambda rows: {(r[0], r[2]) for r in rows}
    return len(sets(found) & sets(expected)) / max(len(expected), 1)


def test_all_lists_of_a_small_table_give_the_exact_order(spark):
    rows = clouds(120, 8, 3)
    vectors = {i: r.tolist() for i, r in enumerate(rows)}
    frame = spark.createDataFrame([(i, v, 0, "", "") for i, v in vectors.items()] + [(0, vectors[0], 0, "", "")], SCHEMA)
    queries = frame.filter("vec_id % 5 = 0").selectExpr("vec_id AS query_id", "embedding")
    found = sorted(map(tuple, posting_lists.nearest(frame, queries).collect()))
    expected = brute_nearest(vectors, sorted(i for i in vectors if i % 5 == 0), 5)
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], atol=1e-12)


def test_recall_with_many_lists_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST", 20)
    monkeypatch.setattr(posting_lists, "BLOCK", 7)
    monkeypatch.setattr(posting_lists, "QUERY_BLOCK", 3)
    rows = clouds(900, 16, 7, 0.4)
    vectors = {i: r.tolist() for i, r in enumerate(rows)}
    frame = spark.createDataFrame([(i, v, 0, "", "") for i, v in vectors.items()], SCHEMA)
    queries = frame.filter("vec_id % 10 = 0").selectExpr("vec_id AS query_id", "embedding")
    found = posting_lists.nearest(frame, queries).collect()
    assert recall(found, brute_nearest(vectors, range(0, 900, 10), 5)) >= 0.9


def test_recall_where_lists_greatly_outnumber_a_walk(spark, monkeypatch):
    """Vectors without clusters: what is near a query lies in far more lists than a beam holds."""
    monkeypatch.setattr(posting_lists, "LIST", 8)
    rows = np.random.default_rng(11).normal(size=(12_000, 24)).astype(np.float32)
    frame = spark.createDataFrame([(i, r.tolist(), 0, "", "") for i, r in enumerate(rows)], SCHEMA)
    queries = frame.filter("vec_id % 40 = 0").selectExpr("vec_id AS query_id", "embedding")
    found = posting_lists.nearest(frame, queries).collect()
    long = posting_lists.unit(rows.astype(float))
    likeness = long[::40] @ long.T
    likeness[np.arange(300), np.arange(0, 12_000, 40)] = -1
    expected = [(q * 40, 0, int(v)) for q, row in enumerate(likeness) for v in np.argsort(-row)[:5]]
    assert recall(found, expected) >= 0.97


def test_all_lists_within_the_ratio_are_read():
    rows = posting_lists.unit(np.random.default_rng(3).normal(size=(4000, 12)))
    graph = posting_lists.CentroidGraph(posting_lists.balanced_centroids(rows, 1024))
    gaps = graph.distances(rows[:20])
    for ratio in (1.0, 1.3, 2.0, float("inf")):
        expected = [np.flatnonzero(g <= np.sort(g)[posting_lists.LEAST_LISTS - 1] * ratio + 1e-6).tolist() for g in gaps]
        read = [sorted(x) for x in posting_lists.probes(graph, rows[:20], ratio)]
        assert ratio > 1.9 and min(map(len, read)) > posting_lists.BEAM or ratio < 1.9
        assert np.mean([len(set(a) & set(b)) / len(b) for a, b in zip(read, expected)]) > 0.95
        if ratio > 1.9:
            assert read == expected


def test_boundary_vectors_are_in_several_lists():
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(2000, 6))
    graph = posting_lists.CentroidGraph(posting_lists.balanced_centroids(posting_lists.unit(rows), 32))
    lists = posting_lists.closures(graph, posting_lists.unit(rows))
    assert {len(x) for x in lists} >= {1, 2} and max(map(len, lists)) <= posting_lists.REPLICAS
    nearest, _ = graph.search(posting_lists.unit(rows))
    assert (nearest[:, 0] == (posting_lists.unit(rows) @ graph.centroids.T).argmax(axis=1)).mean() > 0.99


def test_odd_vectors_take_no_part(spark):
    rows = [(i, v, 0, "", "") for i, v in enumerate(ODD)] + [(50, [1.0, 1.0], 0, "", ""), (None, [1.0, 0.0], 0, "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    queries = frame.selectExpr("vec_id AS query_id", "embedding")
    vectors = {r[0]: r[1] for r in rows if r[0] is not None and _good(r[1]) and len(r[1]) == 2}
    found = sorted(map(tuple, posting_lists.nearest(frame, queries).collect()))
    assert [r[:2] for r in found] == [r[:2] for r in brute_nearest(vectors, sorted(vectors), 5)]
    assert {r[2] for r in found} <= set(vectors)
    assert posting_lists.nearest(frame.limit(0), queries).collect() == []


def test_posting_query_recall(spark):
    path = "/root/testdata/sf0.01"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()}
    found = QUERIES["op3_posting_lists"](spark, path).collect()
    queries = sorted(i for i in vectors if i % 50 == 0)
    assert sorted((r.query_id, r["rank"]) for r in found) == [(q, n) for q in queries for n in range(1, 6)]
    assert recall(found, brute_nearest(vectors, queries, 5)) >= 0.9
    assert all(math.isclose(r.score, _cosine(vectors[r.query_id], vectors[r.vec_id]), abs_tol=1e-12) for r in random.sample(found, 20))
