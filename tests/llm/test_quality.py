import math
import random
from collections import Counter, defaultdict

import pytest

from cartlane.llm import quality


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney, by dictionaries."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        padded = "\x02" * (order - 1) + t + "\x03"
        counts[order].update(padded[i : i + order] for i in range(len(t) + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts, totals, left = {}, {}, {}
    for k in range(1, order + 1):
        n = Counter(min(c, 5) for c in counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else None
        raw = [j - (j + 1) * y * n[j + 1] / n[j] if n[j] else 0.5 for j in (1, 2, 3)] if y else [0.5] * 3
        discounts[k] = [min(max(d, 0.05), j - 0.05) if y else d for j, d in zip((1, 2, 3), raw)]
        totals[k], left[k] = defaultdict(float), defaultdict(float)
        for g, c in counts[k].items():
            totals[k][g[:-1]] += c
            left[k][g[:-1]] += discounts[k][min(c, 3) - 1]

    def probability(gram):
        k = len(gram)
        lower = probability(gram[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        context = gram[:-1]
        if context not in totals[k]:
            return lower
        c = counts[k][gram]
        own = max(c - discounts[k][min(c, 3) - 1], 0) if c else 0
        return own / totals[k][context] + left[k][context] / totals[k][context] * lower

    def perplexity(t):
        padded = "\x02" * (order - 1) + t + "\x03"
        logs = [math.log(probability(padded[i : i + order])) for i in range(len(t) + 1)]
        return math.exp(-sum(logs) / len(logs))

    return probability, perplexity


def texts(seed, n=40):
    draw = random.Random(seed)
    syllables = ["ka", "to", "mi", "ré", "日", "no "]
    return ["".join(draw.choices(syllables, k=draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 5])
def test_perplexity_equals_the_definition(documents, hard, parts):
    trained = texts(1)
    model = quality.train(documents(list(enumerate(trained))))
    model_bytes = model.entries() * quality.ENTRY_BYTES // parts + 1
    probability, perplexity = plain_model(trained, quality.ORDER)
    letters = {c for t in trained for c in t} | {"\x03"}
    assert sum(probability("kato" + c) for c in letters) < 1 + 1e-9
    scored = [(100 + i, t) for i, t in enumerate(texts(2, 15) + ["", "ZZZ", "unseen zz"])]
    got = quality.perplexities(documents(scored), model, ["doc_id"], model_bytes).collect()
    assert len(got) == len(scored)
    want = {i: perplexity(t) for i, t in scored}
    assert {r["doc_id"]: r["perplexity"] for r in got} == pytest.approx(want, rel=1e-4)
    assert quality.perplexities(hard, model, ["doc_id"], model_bytes).count() == hard.count()


def test_classify(spark, documents, hard):
    good = list(enumerate(texts(3, 200)))
    bad = [(500 + i, "#%&$!" * 20) for i in range(5)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(500, 0), (0, 1), (1, None), (None, 1)], "doc_id long, quality int")
    rows = documents(good + bad + [(900, None, None), (901, max((t for _, t in good), key=len), "xx")])
    got = {r["doc_id"]: r["keep"] for r in quality.classify(rows, labels).collect()}
    assert not any(got[i] for i, _ in bad)
    assert sum(got[i] for i, _ in good) >= 190
    scored = {r["doc_id"]: r for r in quality.classify(rows, labels).collect()}
    # Too few of any language are left out, so that all have one threshold: the largest but few of those.
    assert len({r["threshold"] for r in scored.values()}) == 1
    assert quality.classify(rows.limit(0), labels).collect() == []
    nothing = quality.classify(hard, labels.limit(0)).collect()
    assert len(nothing) == hard.count() and all(r["keep"] and r["perplexity"] is None for r in nothing)


def test_both_ways_find_the_trusted(spark, documents):
    rows = documents([(i, f"t{i}") for i in range(50)] + [(None, "x"), (3, "again")])
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "id long")
    want = sorted((r["doc_id"], r["text"]) for r in rows.filter("doc_id % 3 = 0").collect())
    for sent in (0, 100):
        assert sorted(map(tuple, quality.only_trusted(rows, ids, sent=sent).collect())) == want


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learned = labels.filter("doc_id % 2 = 0")
    got = {r["doc_id"]: r["keep"] for r in quality.classify(documents, learned).collect()}
    held = [(r["doc_id"], r["quality"]) for r in labels.filter("doc_id % 2 = 1").collect()]
    kept = [got[i] for i, q in held if q == 1]
    dropped = [not got[i] for i, q in held if q == 0]
    assert sum(kept) / len(kept) > 0.93 and sum(dropped) / len(dropped) > 0.85
