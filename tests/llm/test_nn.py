"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from comparing import SMALL
from hostgrain.llm import nn_descent as nn


def brute(ids, vectors, q, k):
    x = np.asarray(vectors, np.float64)
    scores = x @ x[ids.index(q)]
    order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(ids[i], scores[i]) for i in order]


def test_recall_over_the_whole_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].tolist(), table["embedding"].tolist()
    found = nn.op5(spark, SMALL).toPandas()
    assert set(found["query_id"]) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, own in found.sort_values("rank").groupby("query_id"):
        wanted = brute(ids, vectors, q, 20)
        assert own["rank"].tolist() == list(range(1, 21)) and q not in set(own["vec_id"])
        exact = {i: np.dot(np.asarray(vectors[ids.index(i)], np.float64), np.asarray(vectors[ids.index(q)], np.float64)) for i in own["vec_id"]}
        assert np.allclose(own["score"], [exact[i] for i in own["vec_id"]], atol=1e-12)
        assert own["score"].is_monotonic_decreasing
        hits += len(set(own["vec_id"]) & {i for i, _ in wanted})
    assert hits / (20 * found["query_id"].nunique()) >= 0.97


def test_larger_graph_with_unequal_norms_and_copies(spark, monkeypatch):
    monkeypatch.setattr(nn, "CELL_SIZE", 60)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 12)) * rng.uniform(0.3, 3, size=(700, 1))
    x[100:160] = x[100]  # many equal vectors: ties go to the smaller id
    ids = list(range(700))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = nn.nearest(df, lambda c: c % 20 == 0).toPandas()
    hits = ties = 0
    for q, own in found.groupby("query_id"):
        wanted = [i for i, _ in brute(ids, x.tolist(), q, 20)]
        hits += len(set(own["vec_id"]) & set(wanted))
        if q in range(100, 160):
            ties += 1
            assert len(own) == 20
    assert ties == 3 and hits / (20 * found["query_id"].nunique()) >= 0.9


@pytest.mark.parametrize("n", [0, 1, 2, 9])
def test_few_and_unusable_vectors(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(v) for v in rng.normal(size=4)], "clash") for i in range(n)]
    odd = [(20, None, ""), (40, [0.0] * 4, ""), (60, [1.0, None, 2.0, 3.0], ""), (80, [1.0, float("nan"), 0.0, 0.0], ""), (100, [float("inf")] * 4, ""), (None, [1.0] * 4, "")]
    odd += [rows[0]] if rows else []  # a repeated row
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, node string")
    found = nn.nearest(df, lambda c: c % 20 == 0).collect()
    if n < 2:
        assert not found
    else:
        wanted = brute(list(range(n)), [v for _, v, _ in rows], 0, 20)
        assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(0, k + 1, i) for k, (i, _) in enumerate(wanted)]


@pytest.mark.parametrize("n", [1_000, 4_000])
def test_first_graph_where_pivots_are_capped(spark, monkeypatch, n):
    # cells of many times CELL_SIZE, divided by several tasks (GROUP_SIZE) and within one
    for name, value in (("PIVOTS", 4), ("CELLS", 3), ("CELL_SIZE", 60), ("GROUP_SIZE", 400), ("FAN", 8)):
        monkeypatch.setattr(nn, name, value, raising=False)
    x = np.random.default_rng(5).normal(size=(n, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, bytearray(nn._packed(v))) for i, v in enumerate(x)], "node long, packed binary")
    found = nn.first_graph(nodes, n, 20).select("node", "v").distinct().toPandas().groupby("node")["v"].agg(set)
    near = np.argsort(-(x @ x.T), axis=1)[:, 1:11]
    assert sum(len(found[i] & set(near[i])) for i in range(n)) / (10 * n) >= 0.75


def recall(found, x, queries, k=20):
    hits = 0
    for q in queries:
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(found.get(q, ())) & set(np.argpartition(-s, k)[:k].tolist()))
    return hits / (k * len(queries))


def test_recall_where_cells_are_cut(spark, monkeypatch):
    # as many vectors as the first graph of the default settings compares in parts, and fewer pivots than it asks for
    monkeypatch.setattr(nn, "PIVOTS", 32)
    x = np.random.default_rng(6).normal(size=(20_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = nn.nearest(df, lambda c: c % 20 == 0).toPandas().groupby("query_id")["vec_id"].agg(list)
    assert recall(found, x.astype(np.float64), range(0, len(x), 20)) >= 0.9


def test_each_dimension_has_neighbours_of_its_own(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=(6, 6, 6, 3, 9)[i % 5]).tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nn.nearest(df, lambda c: c % 4 == 0).toPandas()
    for q in range(0, 100, 4):
        same = [i for i, v in rows if len(v) == len(rows[q][1])]
        wanted = brute(same, [rows[i][1] for i in same], q, 20)
        assert found[found["query_id"] == q].sort_values("rank")["vec_id"].tolist() == [i for i, _ in wanted]
