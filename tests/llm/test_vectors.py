import math
import random

import numpy as np
import pandas as pd
import pytest

from cartlane.llm import vectors


def plain(rows, queries, nearest):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, q in usable:
        if queries(i):
            best = sorted({(-float(np.dot(q, v)), j) for j, v in usable if j != i and len(v) == len(q)})
            out[i] = [(j, -s) for s, j in best[:nearest]]
    return out


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for v in got.values():
        v.sort()
        assert [k for k, _, _ in v] == list(range(1, len(v) + 1))
    return {q: [(j, s) for _, j, s in v] for q, v in got.items()}


def test_small_shards_are_exact_with_copies_and_odd_rows(spark):
    draw = random.Random(2)
    hot = [1.0, 2.0, -1.0]
    rows = [(i, [draw.gauss(0, 1) * draw.choice([1, 10]) for _ in range(3)]) for i in range(60)]
    rows += [(100 + i, hot) for i in range(40)] + [(5, rows[5][1]), (None, hot), (161, None), (162, []), (163, [0.0, 0.0, 0.0])]
    rows += [(164, [1.0, None, 2.0]), (165, [1.0, float("nan"), 2.0]), (180, [float("inf"), 1.0, 1.0]), (200, [1.0, 2.0]), (201, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = plain(stored, lambda i: i % 20 == 0, 20)
    for options in ({}, {"shard_rows": 20, "block_rows": 2}):
        got = answers(vectors.search_every(df, **options))
        assert set(got) == set(want)
        for q, found in got.items():
            assert [j for j, _ in found] == [j for j, _ in want[q]], q
            assert [s for _, s in found] == pytest.approx([s for _, s in want[q]], rel=1e-12)
    assert vectors.search_every(df.limit(0)).collect() == []


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = answers(vectors.search_every(df, shard_rows=700))
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    shares = []
    for q, found in got.items():
        worth = x @ x[ids == q][0]
        worth[ids == q] = -np.inf
        best = set(ids[np.argsort(-worth)[:20]].tolist())
        shares.append(len(best & {j for j, _ in found}) / 20)
    assert len(got) == (ids % 20 == 0).sum()
    assert np.mean(shares) >= 0.95


def of_kind(kind, n=2 * vectors.SHARD_ROWS - 100, dim=64):
    """More vectors than a shard of default size holds."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(n, dim))
    if kind == "clustered":
        x = 0.6 * x + 3 * draw.normal(size=(40, dim))[draw.integers(0, 40, n)]
    if kind == "lognormal":
        x *= draw.lognormal(0, 0.5, (n, 1))
    return x


@pytest.mark.parametrize("kind", ["gaussian", "lognormal", "clustered"])
def test_recall_of_products_at_default_size(spark, kind):
    x = of_kind(kind)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = answers(vectors.search_every(df, step=160))
    shares = []
    for q, found in got.items():
        worth = x @ x[q]
        worth[q] = -np.inf
        shares.append(len(set(np.argsort(-worth)[:20].tolist()) & {j for j, _ in found}) / 20)
    assert len(got) == len(range(0, len(x), 160)) and np.mean(shares) >= 0.95


def test_bands_of_lengths():
    lengths = np.sort(np.random.default_rng(2).lognormal(0, 1, 3000))[::-1]
    found = vectors.bands_of(lengths)
    assert [a for a, _ in found] == [0, *(b for _, b in found[:-1])] and found[-1][1] == 3000
    for a, b in found[:-1]:
        assert b - a >= vectors.QUERY_BEAM and (b - a == vectors.QUERY_BEAM or lengths[a] <= vectors.BAND * lengths[b - 1] + 1e-9)
    assert vectors.bands_of(lengths[:0]) == [] and vectors.bands_of(np.full(500, 2.0)) == [(0, 500)]
    assert vectors.lengths_of(np.array([[3e200, 4e200], [0, 0], [3e-200, -4e-200]])).tolist() == pytest.approx([5e200, 0, 5e-200])


def test_graph_is_bounded_and_reaches():
    x = np.random.default_rng(1).normal(size=(600, 8))
    x /= vectors.lengths_of(x)[:, None]
    graph = vectors.build_graph(x, vectors.lengths_of(x))
    degrees = (graph.edges >= 0).sum(axis=1)
    assert degrees.max() <= vectors.ROOM and degrees.min() >= 1
    found, _ = vectors.beam_search(graph, x.astype(np.float32), 32)
    near = np.argsort(-(x @ x.T), axis=1)[:, 1]
    assert np.mean([i in row for i, row in zip(near, found)]) > 0.97


def plain_search(graph, query, beam):
    """The beam search of one query, node by node."""
    worth = {graph.entry: float(query @ graph.points[graph.entry])}
    held, done = [graph.entry], set()
    while todo := [i for i in held if i not in done][: vectors.FOLLOWED]:
        done |= set(todo)
        new = {j for i in todo for j in graph.edges[i].tolist() if j >= 0 and j not in worth}
        worth |= {j: float(query @ graph.points[j]) for j in new}
        held = sorted({*held, *new}, key=lambda j: -worth[j])[:beam]
    return held, done


def test_search_is_the_plain_one():
    x = np.random.default_rng(4).normal(size=(900, 12))
    x /= vectors.lengths_of(x)[:, None]
    graph = vectors.build_graph(x[:800], vectors.lengths_of(x[:800]))
    queries = x[700:].astype(np.float32)
    for beam in (1, 7, 40, 1000):
        found, followed = vectors.beam_search(graph, queries, beam)
        for query, ids, steps in zip(queries, found.tolist(), followed.tolist()):
            held, done = plain_search(graph, query, beam)
            assert [i for i in ids if i >= 0] == held and {i for i in steps if i >= 0} == done


def test_only_what_can_be_an_answer_is_ranked(monkeypatch):
    x = np.random.default_rng(5).normal(size=(2050, 16))
    x /= vectors.lengths_of(x)[:, None]
    nodes, queries, n = x[:2000], x[2000:], 2000
    graph = vectors.build_graph(nodes, vectors.lengths_of(nodes))
    row = {"dim": 16, "n": n, "vectors": nodes.tobytes(), "members": np.arange(n).tobytes(), "ends": np.arange(1, n + 1).tobytes()}
    row |= {"points": graph.points.tobytes(), "edges": graph.edges.tobytes(), "bands": np.array([n]).tobytes()}
    row |= {"entries": np.array([graph.entry]).tobytes(), "longest": np.ones(1).tobytes()}
    row |= {"ids": np.arange(n, n + 50).tobytes(), "queries": queries.tobytes()}
    dot, argsort, dots, widths = np.dot, np.argsort, [], []
    monkeypatch.setattr(np, "dot", lambda a, b: dots.append(1) or dot(a, b))
    monkeypatch.setattr(np, "argsort", lambda a, *args, **kw: widths.append(np.isfinite(a).sum()) or argsort(a, *args, **kw))
    found = next(vectors._searched(20, 128)(iter([pd.DataFrame([row])])))
    best = argsort(-(queries @ nodes.T), axis=1)[:, :20]
    assert np.mean([set(found.vec_id[found.query_id == n + i]) == set(b) for i, b in enumerate(best.tolist())]) > 0.9
    # Of the 128 nodes in a beam 21 can be in an answer; what is worse than a full beam is not sorted into it.
    assert len(dots) == 50 * 21 and sum(widths) < 200_000
