import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartlane.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(documents, items, top=10):
    """The contract, document by document: (id, text) and (item, text) rows."""
    terms = lambda text: [t.translate(LOWER) for t in TERM.findall(text or "")]
    docs = [(key, Counter(terms(text)), len(terms(text))) for key, text in documents]
    docs = [d for d in docs if d[2]]
    n, words = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms(text) if df[t]}
        scores = []
        for key, tf, length in docs:
            m = 10 + 90 * length * n // words
            scores.append((sum(w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, w in asked.items() if tf[t]), key))
        found = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], -math.inf if s[1] is None else s[1]))
        out += [(item, rank, key, score) for rank, (score, key) in enumerate(found[:top], 1)]
    return sorted(out, key=repr)


def run(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    docs = docs.withColumns({"rank": docs.doc_id, "score": docs.text, "item_id": docs.doc_id, "m": docs.doc_id, "n": docs.doc_id})
    asked = spark.createDataFrame(items, "item_id int, text string")
    found = ranked.best_documents(docs, asked.withColumn("doc_id", asked.text), **options)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def sample(n, seed):
    draw = random.Random(seed)
    bag = [f"t{int(draw.paretovariate(0.7)) % 400}" for _ in range(900)] + ["É9", "日本", "Longerthaneight", "longerthaneighu", "longerthaneightbytes"]
    text = lambda k: draw.choice([" ", ". "]).join(draw.choice(bag) for _ in range(draw.randrange(k)))
    rows = [(i, text(40)) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(n // 3)]  # copies: equal scores
    rows += [(None, None), (3, ""), (None, rows[7][1]), (7, rows[7][1]), (9_000_000_000, text(20_000)), (-4, rows[5][1])]
    items = [(i, text(25)) for i in range(12)] + [(1, "t1 t1 t2"), (None, "t1"), (50, None), (51, " ... "), (52, "unheardof"), (53, rows[7][1] or "t3")]
    draw.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("options", [{}, {"tree_documents": 40, "leaf": 2}, {"tree_entries": 64, "leaf": 1}, {"items_bytes": 300}, {"top": 3}])
def test_equals_brute_force(spark, options):
    documents, items = sample(200, 1)
    assert run(spark, documents, items, **options) == brute(documents, items, options.get("top", 10))


def test_empty_tables(spark):
    documents, items = sample(9, 2)
    assert run(spark, [], items) == run(spark, documents, []) == run(spark, [(1, None)], items) == []
    assert run(spark, documents, [(1, "...")]) == []


def test_a_term_of_all_documents_weighs_little(spark):
    documents = [(i, "all " + "x " * i) for i in range(30)]
    assert run(spark, documents, [(1, "all x")]) == brute(documents, [(1, "all x")])


def _random_tree(draw, leaf):
    size, docs = 30, [sorted(draw.sample(range(30), draw.randrange(1, 12))) for _ in range(300)]
    docs = [[t for t in d if t < 4 or draw.random() < 0.5] or [0] for d in docs]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    tfs = np.array([draw.randrange(1, 9) for d in docs for _ in d])
    m = np.array([draw.randrange(10, 400) for _ in docs])
    return docs, ranked.make_tree(starts, np.concatenate(docs), tfs, m, size, leaf), size


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_nodes_share_paths_and_bound_their_documents(leaf):
    docs, tree, size = _random_tree(random.Random(leaf), leaf)
    paths = [docs[i] for i in tree.order]
    assert paths == sorted(docs)
    for node, children in enumerate(tree.children):
        a, b = tree.begin[node], tree.end[node]
        if children:
            assert [tree.begin[c] for c in children] == [a, *(tree.end[c] for c in children[:-1])] and tree.end[children[-1]] == b
        elif b - a > leaf:  # copies of one path only
            assert all(p == paths[a] for p in paths[a:b])
        for term in range(size):
            some = slice(tree.stops[term], tree.stops[term + 1])
            bound = dict(zip(tree.nodes[some].tolist(), tree.most[some].tolist())).get(node, 0)
            for i in range(a, b):
                entry = tree.starts[i] + paths[i].index(term) if term in paths[i] else None
                assert bound >= (0 if entry is None else tree.values[entry])


def test_branches_are_left_out(spark):
    docs, tree, size = _random_tree(random.Random(5), 4)
    weights, best = np.full(size, 10), ranked.Best(3)
    weights[20:] = 5000
    seen = ranked.search(tree, np.array([1, 25]), weights, list(range(len(docs))), best, np.zeros(size, np.int64))
    assert 0 < seen < sum(not c for c in tree.children)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(ranked, "RangeHash", lambda data: lambda begins, ends: (ends - begins).astype(np.uint64))
    vocabulary = ranked.Vocabulary(pa.array(["abcdefghijk"]))
    data = np.frombuffer(b"abcdefghijk abcdefghijx abcdefghijk", np.uint8)
    assert vocabulary.find(data, np.array([0, 12, 24]), np.array([11, 23, 35])).tolist() == [0, -1, 0]
