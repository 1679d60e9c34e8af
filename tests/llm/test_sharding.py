import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartlane.llm import sharding


def placed(df, shards=8):
    rows = sharding.shard_documents(df, shards).collect()
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts.get(s, 0)))
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)
    return rows


def test_law_sizes_and_groups(documents):
    draw = random.Random(1)
    texts = [f"text {i} é" for i in range(150)] + [f"pair {i}" for i in range(30) for _ in range(2)] + ["group"] * 20 + ["five"] * 5
    draw.shuffle(texts)
    rows = placed(documents(list(enumerate(texts)), {"shard": F.lit("clash"), "node": F.lit(1)}))
    shards = defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


@pytest.mark.parametrize("n", [0, 1, 3, 7, 9])
def test_few_rows(documents, n):
    placed(documents([(i, "same") for i in range(n)]))


def test_a_third_in_one_group(documents):
    rows = placed(documents([(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(480)]))
    hot = Counter(r["shard"] for r in rows if r["doc_id"] % 3 == 0)
    assert max(hot.values()) == 60 and len(hot) <= 4  # one shard holds as much of it as fits, and few the rest


def test_groups_that_fit_stay_whole(documents):
    """Six groups of a tenth each and pairs, though two of the groups cannot share a shard."""
    texts = [f"group {i % 6}" if i < 1200 else f"pair {i // 2}" if i < 1300 else f"text {i}" for i in range(2000)]
    random.Random(2).shuffle(texts)
    shards = defaultdict(set)
    for r in placed(documents(list(enumerate(texts)))):
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


@pytest.mark.parametrize("seed", range(3))
def test_cuts_of_small_graphs(spark, seed):
    """Brute force over all ways to deal the groups: where all fit as wholes, no link is cut."""
    draw = random.Random(seed)
    sizes = [draw.randrange(2, 5) for _ in range(4)]
    pairs, at = [], 0
    for size in sizes:
        pairs += [(at + draw.randrange(i), at + i) for i in range(1, size)] + [(at, at + size - 1)]
        at += size
    total = at + 10
    nodes, links = spark.range(total).withColumnRenamed("id", "node"), spark.createDataFrame(pairs, "a long, b long")
    labels = sharding.propagate(nodes, links, shards=3)
    counts = sorted(r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect())
    assert counts[-1] - counts[0] <= 1 and sum(counts) == total
    whole = any(
        all(sum(s for s, d in zip(sizes, dealt) if d == shard) <= total // 3 for shard in range(3))
        for dealt in itertools.product(range(3), repeat=len(sizes))
    )
    assert whole and sharding.cut_links(labels, links).first()["cut"] == 0


def test_a_group_above_the_quota_lies_over_few_shards(spark):
    nodes = spark.range(800).withColumnRenamed("id", "node")
    links = spark.range(1, 250).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    labels = {r["node"]: r["shard"] for r in sharding.propagate(nodes, links).collect()}
    pieces = Counter(labels[n] for n in range(250))
    assert len(pieces) <= 4 and max(pieces.values()) == 100 and pieces[labels[0]] == 100


def test_hard_rows(hard):
    rows = placed(hard)
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}
    assert sizes[1] == sizes[2] == (1, 0)
    together = [len({r["shard"] for r in rows if r["doc_id"] in ids}) == 1 for ids in ((1, 2), (4, 5), (7,))]
    assert any(together)  # ten rows in eight shards: two shards at most have room for a pair


def test_links_of_any_kind_are_cut_less_than_by_hash(spark):
    draw = random.Random(3)
    # Communities of twelve with random links inside.
    pairs = [(12 * c + draw.randrange(12), 12 * c + draw.randrange(12)) for c in range(40) for _ in range(40)]
    nodes, links = spark.range(480).withColumnRenamed("id", "node"), spark.createDataFrame(pairs, "a long, b long").filter("a <> b")
    by_hash = nodes.select("node", F.pmod(F.xxhash64("node"), F.lit(4)).cast("int").alias("shard"))
    labels = sharding.propagate(nodes, links, shards=4, rounds=6)
    counts = [r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert counts == [120] * 4
    before, after = (sharding.cut_links(x, links).first() for x in (by_hash, labels))
    assert after["links"] == before["links"] and after["cut"] < 0.5 * before["cut"]


def test_ranks_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 5)
    rows = spark.range(200).select("id", (F.col("id") % 3).alias("by"), (F.col("id") % 2).alias("kind"))
    got = sharding._before(rows, "by", F.col("kind"), F.xxhash64("id"), [F.xxhash64("id"), "id"], F.lit(1), 200).collect()
    for by in range(3):
        mine = sorted(((r["before"], r["kind"]) for r in got if r["by"] == by))
        assert [b for b, _ in mine] == list(range(len(mine)))
        assert [k for _, k in mine] == sorted(k for _, k in mine)
