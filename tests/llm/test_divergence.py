import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartlane.llm import divergence
from cartlane.llm.texts import flat, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least):
    """The contract, word by word: rows are (text, lang, source)."""
    docs, langs = defaultdict(lambda: defaultdict(set)), defaultdict(Counter)
    counts = defaultdict(Counter)
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        counts[lang, source].update({})
        for term in (t.translate(LOWER) for t in TERM.findall(text or "")):
            docs[lang][term].add(k)
            counts[lang, source][term] += 1
            langs[lang][term] += 1
    out = []
    share = lambda n, size: 1 + 1_000_000_000 * (n + 2) // size
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {lang for lang, _ in counts}:
        terms = [t for t, d in docs[lang].items() if len(d) >= least]
        size = {s: sum(c[t] for t in terms) + 2 * len(terms) for (g, s), c in counts.items() if g == lang}
        whole = sum(langs[lang][t] for t in terms) + 2 * len(terms)
        p = {s: {t: share(counts[lang, s][t], size[s]) for t in terms} for s in size}
        for s in size:
            pairs = [(sum(apart(p[s][t], p[o][t]) for t in terms), o) for o in size if o != s]
            telling = [(t, share(langs[lang][t], whole)) for t in terms if counts[lang, s][t]]
            best = [(apart(p[s][t], q), t) for t, q in telling if p[s][t] > q]
            for part, found in (("pair", pairs), ("term", best)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= 10]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    df = df.withColumns({"term": df.lang, "value": df.source, "n": df.doc_id})
    return sorted(map(tuple, divergence.source_divergence(df, **options).collect()))


def sample(n, seed=1):
    draw = random.Random(seed)
    bag = ["a", "Ab", "ABC", "abcdefgh", "abcdefghi", "abcdefgh" * 2, "abcdefgh" * 2 + "x", "é", "Éa", "日本", "ñandú", "z9z", "x_y", "it's", "\x7f"]
    text = lambda: draw.choice([" ", ". ", "1"]).join(draw.choice(bag) for _ in range(draw.randrange(30)))
    return [(draw.choice([text(), None, ""]) if draw.random() < 0.2 else text(), draw.choice(["en", "es", None, ""]), draw.choice(["s1", "s2", "s10", "é", None])) for _ in range(n)]


@pytest.mark.parametrize("least", [1, 3, 10, 1000])
def test_equals_brute_force(spark, least):
    rows = sample(120)
    assert run(spark, rows, least_docs=least) == brute(rows, least)


def test_small_shards_slices_and_blocks(spark, monkeypatch):
    rows = sample(150, 2) + sample(30, 3) * 2
    for name, value in (("TERMS", 2), ("CELLS", 3), ("SLICE", 4), ("TEXT_BYTES", 200)):
        monkeypatch.setattr(divergence, name, value)
    # The tasks import the module anew, so the pointer sort is called here as well.
    assert run(spark, rows, least_docs=2) == brute(rows, 2)
    batch = pa.RecordBatch.from_pydict({c: [r[k] or "" for r in rows] for k, c in enumerate(("text", "lang", "source"))})
    got = divergence.count_runs(batch).to_pylist()
    wanted, docs = Counter(), defaultdict(set)
    for k, (text, lang, source) in enumerate(rows):
        for t in TERM.findall(text or ""):
            wanted[lang or "", source or "", t.translate(LOWER)] += 1
            docs[lang or "", source or "", t.translate(LOWER)].add(k)
    assert {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in got} == {k: (n, len(docs[k])) for k, n in wanted.items()}
    assert len(got) == len(wanted)


def test_pointers_are_sorted_and_stable(monkeypatch):
    draw = random.Random(7)
    text = " ".join("".join(draw.choice("ab") for _ in range(draw.randrange(1, 24))) for _ in range(5000)) + " ab" * 3000
    data, offsets = flat(pa.array([text]))
    begins, ends, _ = words(data, offsets, divergence._INSIDE)
    for size in (1, 7, 1000, 1 << 15):
        monkeypatch.setattr(divergence, "SLICE", max(size, 99))
        order, fresh = divergence.sort_pointers(data, begins, ends)
        got = [text[a:b] for a, b in zip(begins[order], ends[order])]
        assert got == sorted(text.split())
        assert fresh.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]
        same = ~fresh[1:]
        assert np.all(np.diff(order)[same] > 0)


def test_hard_and_empty_tables(spark, hard):
    rows = [(r.text, r.lang, r.source) for r in hard.collect()]
    assert sorted(map(tuple, divergence.source_divergence(hard, least_docs=2).collect())) == brute(rows, 2)
    assert divergence.source_divergence(hard.filter("false")).collect() == []
