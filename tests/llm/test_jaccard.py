import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartlane.llm import jaccard
from cartlane.llm.components import connected
from cartlane.plans.scratch import _application_folder, children


def plain_set(text, size=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def linked(a, b, percent=90):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_copies(seed, groups=6, copies=14):
    """Groups of texts that drift apart: chains in which the ends no longer link."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcde", k=3))
    texts = ["", None, " \n ", "one", "ONE", "one two", "one  two", "a b c", "a b c"]
    passage = [word() for _ in range(25)]
    for _ in range(groups):
        words = [word() for _ in range(draw.choice([12, 40, 80]))]
        if draw.random() < 0.5:
            words += passage
        for _ in range(copies):
            words = list(words)
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                words[draw.randrange(len(words))] = word()
            texts.append(draw.choice([" ", "\n"]).join(w.upper() if draw.random() < 0.1 else w for w in words))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_links_equal_brute_force(documents, seed):
    rows = near_copies(seed)
    sets = {i: plain_set(t) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b])]
    want = roots(sets, pairs)
    assert any(want[a] == want[b] and not linked(sets[a], sets[b]) and sets[a] for a in sets for b in sets if a < b)
    df = documents(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.components(df).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    links, members = jaccard.similar_classes(df)
    ids = {}
    for r in members.collect():
        ids.setdefault(r["cls"], []).append(r["id"])
    found = {frozenset((x, y)) for r in links.collect() for x in ids[r["a"]] for y in ids[r["b"]]}
    assert found == {frozenset(p) for p in pairs if sets[p[0]] != sets[p[1]]}


def edited_copies(seed):
    """One text with up to eight edits here and there, cut short, and added to; some edits in common."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    base = [word() for _ in range(110)]
    family = list(base)
    family[30:33] = [word(), word(), word()]
    texts = [" ".join(base)]
    for i in range(120):
        words = list(draw.choice([base, base, family]))
        for _ in range(i % 9):
            words[draw.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [" ".join(base[: 110 - i]) for i in range(1, 30)]
    texts += [" ".join(base[i:] + [word() for _ in range(draw.randrange(4))]) for i in range(0, 24, 2)]
    texts += [" ".join(base + [word() for _ in range(i)]) for i in range(1, 20, 3)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, size, percent", [(5, 3, 90), (6, 3, 90), (5, 5, 80), (7, 5, 80)])
def test_one_group_of_copies_edited_more_or_less(documents, seed, size, percent):
    rows = edited_copies(seed)
    sets = {i: plain_set(t, size) for i, t in rows}
    want = roots(sets, [(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b], percent)])
    assert 10 < len(set(want.values())) < len(rows) - 20
    got = {r["doc_id"]: r["component_id"] for r in jaccard.components(documents(rows), "doc_id", size, percent).collect()}
    assert got == want


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_two_thousand_copies_in_one_group(documents, size, percent):
    """Also copies of copies, cut in pieces as line dedup leaves them: homes of homes."""
    draw = random.Random(size)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    base = [word() for _ in range(90)]
    texts = []
    for i in range(2000):
        words = base[draw.choice([0, 0, 0, 25]) : draw.choice([90, 90, 90, 60])]
        for _ in range(i % 9):
            words[draw.randrange(len(words))] = word() if draw.random() < 0.9 else "same"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    sets = {i: plain_set(t, size) for i, t in rows}
    vocabulary = {s: n for n, s in enumerate(set().union(*sets.values()))}
    table = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, found in sets.items():
        table[i, [vocabulary[s] for s in found]] = 1
    sizes, common = table.sum(axis=1), table @ table.T
    pairs = np.argwhere(100 * common >= percent * (sizes[:, None] + sizes - common) - 1e-3)
    want = roots(sets, pairs.tolist())
    got = {r["doc_id"]: r["component_id"] for r in jaccard.components(documents(rows), "doc_id", size, percent).collect()}
    assert got == want and 100 < len(set(want.values())) < 1900


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_a_class_has_no_entry_per_size_of_its_group(documents, monkeypatch, size, percent):
    """Copies of many sizes around one home: a class is listed under its items once, not once for each size."""
    draw = random.Random(size)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    base = [word() for _ in range(200)]
    texts = [" ".join(base)]
    for i in range(400):
        words = base[draw.randrange(25) : 200 - draw.randrange(25)] + [word() for _ in range(draw.randrange(20))]
        for _ in range(i % 12):
            words[draw.randrange(len(words))] = word() if draw.random() < 0.7 else "same"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    entries = []
    prefixes = jaccard._prefixes_at_home

    def counted(near, *rest):
        out = prefixes(near, *rest)
        entries.append((out.count(), near.agg(F.sum("d")).first()[0] or 0))
        return out

    monkeypatch.setattr(jaccard, "_prefixes_at_home", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.components(documents(rows), "doc_id", size, percent).collect()}
    sets = {i: plain_set(t, size) for i, t in rows}
    assert got == roots(sets, [(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b], percent)])
    assert sum(n for n, _ in entries) > 0 and all(n <= items for n, items in entries)


def test_one_of_each_keeps_columns(documents):
    rows = near_copies(3, groups=2)
    df = documents(rows, {"cls": F.lit("mine"), "n": F.lit(1), "id": F.lit(5)})
    left = jaccard.one_of_each(df)
    sets = {i: plain_set(t) for i, t in rows}
    want = roots(sets, [(a, b) for a in sets for b in sets if a < b and linked(sets[a], sets[b])])
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))
    assert {r["cls"] for r in left.collect()} == {"mine"}


def test_hard_rows(hard):
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.components(hard).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (7, 7), (None, None), (8, 8)], key=str)
    assert jaccard.components(hard.limit(0)).collect() == []
    assert jaccard.one_of_each(hard).count() == 9


def test_prefix_sizes_are_exact():
    for n in range(1, 300):
        p = jaccard.prefix_size(n)
        least = min(k for k in range(1, n + 1) if 100 * k >= 90 * n)  # of sets at least as large
        assert p == n - least + 1


def test_sets_ignore_chunk_borders():
    texts = ["a b c d", "b c d", "", "a b c d e"]
    whole = jaccard.shingle_sets(pa.array(texts))
    for text, got in zip(texts, whole):
        assert got.tolist() == jaccard.shingle_sets(pa.array([text]))[0].tolist()
        assert len(got) == len(plain_set(text))


def test_connected(spark):
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(200, 260)]
    loose = [(draw.randrange(300, 340), draw.randrange(300, 340)) for _ in range(25)]
    pairs = chain + star + loose + [(7, 7)]
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    want = roots(nodes, [p for p in pairs if p[0] != p[1]])
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_buckets_hold_what_may_link_and_no_more(documents, size, percent):
    """Copies, and texts of all lengths that share passages: at most of these shingles no two of them can link."""
    draw = random.Random(size)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    said = [" ".join(word() for _ in range(60)) for _ in range(400)]
    loose = [" ".join(draw.sample(said, draw.randrange(1, 7))) for _ in range(300)]
    rows = list(enumerate([t for _, t in edited_copies(size)] + loose))
    df = documents(rows).repartition(3)
    join = jaccard._Join(df, "doc_id", size, percent)
    counters = jaccard._counters(jaccard._described(df, "doc_id", size))
    held = {}
    for r in jaccard._prefixes(df, counters, size, percent).distinct().collect():
        held.setdefault(r["token"], set()).add((r["cls"], r["n"], r["pos"]))
    may, shared = set(), 0
    for token, classes in held.items():
        shared += len(classes) if len(classes) > 1 else 0
        for cls, n, pos in classes:
            for other, m, at in classes:
                fits = 100 * min(n, m) >= percent * max(n, m)
                if other != cls and fits and (100 + percent) * (min(n - pos, m - at) + 1) >= percent * (n + m):
                    may.add((token, cls, n, pos))
    got = join.buckets.collect()
    found = {(r["token"], r["cls"], r["n"], r["pos"]) for r in got}
    assert len(got) == len(found) and may <= found and all(r["size"] == len(held[r["token"]]) for r in got)
    pairs = {t for t, classes in held.items() if len(classes) == 2}
    assert {f for f in found if f[0] in pairs} == {f for f in may if f[0] in pairs}
    assert may and len(found) < 0.8 * shared


def test_the_driver_fetches_the_counters_in_few_jobs(spark, documents):
    """Also of many parts; and the counters are those of all documents."""
    said = [f"one two three {i % 7} five six {i}" for i in range(300)]
    described = jaccard._described(documents(list(enumerate(said))).repartition(3), "doc_id", 3)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("counters", "counters")
    try:
        counters = jaccard._counters(described)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("counters")) < 30
    want = np.zeros(jaccard.COUNTERS, np.int64)
    for shingles in jaccard.shingle_sets(pa.array(said), 3):
        np.add.at(want, (shingles % np.uint64(jaccard.COUNTERS)).astype(np.int64), 1)
    assert np.array_equal(np.frombuffer(b"".join(map(zlib.decompress, counters)), np.uint16), want)


def test_the_join_keeps_the_tables_of_its_result_only(spark, documents):
    """What the driver has to list, and the folder to hold, does not add up over a job's steps."""
    folder = _application_folder(spark)
    before = set(children(spark, folder))
    df = documents(list(enumerate([t for _, t in edited_copies(3)])))
    assert jaccard.components(df).count() == df.count()
    left = {c.rpartition("-")[0] for c in set(children(spark, folder)) - before}
    assert "shingled" in left and not left & {"buckets", "centred", "degrees", "asked", "classes"}
