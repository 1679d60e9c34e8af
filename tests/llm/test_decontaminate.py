import random
import re
import time

import pytest

from cartlane.llm import decontaminate as d

VOCABULARY = ["the", "a", "cat", "Dog", "ran", "é", "7", "日本"]


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text, items, size=10):
    words, hit, found = plain_words(text), set(), set()
    for key, item in items:
        own = plain_words(item)
        n = min(size, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(key) if key is not None else "")
    return len(words), len(hit), sorted(found)


def cases(seed):
    draw = random.Random(seed)
    text = lambda n: draw.choice(["", " ", "--"]) + draw.choice([" ", ", ", "\n"]).join(draw.choices(VOCABULARY, k=n))
    items = [(i, text(draw.choice([0, 1, 3, 9, 10, 11, 14, 25, 40]))) for i in range(12)]
    items += [(1, items[5][1]), (None, "null item words"), (20, None)]
    docs = []
    for i in range(60):
        parts = [text(draw.randint(0, 12))]
        for _ in range(draw.randint(0, 3)):
            source = draw.choice(items)[1] or ""
            words = source.split(" ")
            a = draw.randint(0, len(words))
            parts += [" ".join(words[a : a + draw.randint(5, 20)]).upper(), text(draw.randint(0, 3))]
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed", range(4))
def test_finder_equals_brute_force(seed):
    docs, items = cases(seed)
    finder = d.Finder([("" if k is None else str(k), d.words_of(t)) for k, t in items])
    for _, text in docs:
        words = d.words_of(text)
        ranges, ids = finder.find(words)
        merged = d.merged_ranges(ranges)
        assert (len(words), sum(e - b for b, e in merged), sorted(ids)) == plain(text, items)


@pytest.mark.parametrize("options", [{}, {"automaton_bytes": 60, "scan_bytes": 500}, {"items_bytes": 200}])
def test_all_ways_give_the_same(spark, documents, hard, options):
    docs, items = cases(9)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = documents(docs).union(hard)
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], tuple(r["items"])) for r in d.find_items(rows, benchmark, **options).collect())
    want = []
    for r in rows.collect():
        n, hit, found = plain(r["text"], items)
        want.append((r["doc_id"] or -1, n, hit, tuple(found)))
    assert got == sorted(want)


def test_spans_point_at_the_original(spark, documents):
    item = "One two three, four five six seven eight nine ten"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = d.find_items(documents([(1, f"é -- {item.upper()}! end")]), benchmark).first()
    assert [(s["begin"], s["end"]) for s in row["spans"]] == [(5, 5 + len(item))]


def test_questions_and_answers_are_one_item(spark, documents):
    benchmark = spark.createDataFrame([(1, "a b c d e f", "g h i j")], "item_id long, question string, answer string")
    found = d.find_items(documents([(1, "a b c d e f g h i j")]), benchmark, columns=("question", "answer"))
    assert found.first()["n_hit"] == 10


def test_clean_documents_keep_their_columns(spark, documents):
    from pyspark.sql import functions as F

    benchmark = spark.createDataFrame([(1, " ".join("abcdefghij"))], "item_id long, text string")
    rows = documents([(1, "x " + " ".join("abcdefghij")), (2, "clean"), (3, None)], {"n_words": F.lit("mine"), "items": F.lit(1)})
    left = d.clean_documents(rows, benchmark)
    assert left.columns == rows.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    assert {r["n_words"] for r in left.collect()} == {"mine"}
    empty = d.clean_documents(rows, benchmark.limit(0))
    assert empty.count() == 3 and d.find_items(rows.limit(0), benchmark).collect() == []


def _covered(ranges):
    return {i for a, b in ranges for i in range(a, b)}


@pytest.mark.parametrize("seed", range(60))
def test_words_said_over_and_over(seed):
    """Periods of all kinds in items and documents, window by window."""
    draw = random.Random(seed)
    window = draw.choice([4, 6, 10])

    def said():
        out = []
        for _ in range(draw.randrange(1, 5)):
            part = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.choice([1, 1, 2, 3, 5, 7]))]
            out += part * draw.randrange(1, 40 // len(part) + 2)
        return out

    items = [(f"i{n}", said()) for n in range(4)]
    finder = d.Finder(items, window)
    for _ in range(6):
        words = said() + draw.choice([[], items[0][1], items[1][1][3:]])
        want, ids = set(), set()
        for name, item in items:
            size = min(window, len(item))
            there = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)}
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in there:
                    want |= set(range(i, i + size))
                    ids.add(name)
        got, found = finder.find(words)
        assert _covered(got) == want and found == ids


def test_long_repeats_take_time_in_proportion():
    finder = d.Finder([("x", [b"w"] * 4000), ("y", [b"v", b"w"] * 2000)])
    begin = time.process_time()
    ranges, ids = finder.find([b"w"] * 100_000 + [b"v", b"w"] * 50_000)
    assert ids == {"x", "y"} and len(_covered(ranges)) == 200_000
    assert time.process_time() - begin < 5
