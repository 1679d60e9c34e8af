import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cartlane.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))
        return k if len(k) >= 20 else None

    holders = {}
    for n, (i, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")} - {None}:
            holders.setdefault(k, []).append((n, i))
    out = []
    for i, text in rows:
        cut = (text or "").split("\n")
        stay = []
        for line in cut:
            of = holders.get(key(line), [])
            largest = max((x for _, x in of if x is not None), default=None)
            if len(of) < 3 or i == largest:
                stay.append(line)
        out.append((i, len(cut), len(cut) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def cases(seed, n=80):
    draw = random.Random(seed)
    pool = [f"this is a common line number {i}" for i in range(12)] + ["short", "", "exactly twenty chars", "é" * 19, "é" * 20]
    rows = []
    for i in range(n):
        picked = [draw.choice(pool) for _ in range(draw.randint(0, 6))] + [f"own line of the document {i}"] * draw.randint(0, 2)
        if draw.random() < 0.6:
            picked.append("A HOT line that stands in most of them")
        draw.shuffle(picked)
        rows.append((i, "\n".join(draw.choice(["", " ", "\t"]) + (p.upper() if draw.random() < 0.2 else p) + draw.choice(["", "\r"]) for p in picked)))
    return rows + [(200, None), (201, ""), (200, rows[0][1]), (None, rows[1][1]), (None, "only nulls hold this line\n" * 3)]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(documents):
    rows = cases(1)
    assert collected(lines.line_digests(documents(rows))) == plain(rows)


@pytest.mark.parametrize("shard_keys,probes", [(3, 7), (2, 1000)])
def test_many_shards_and_copies(documents, shard_keys, probes):
    rows = cases(2)
    hashes = lines.line_hashes(documents(rows), "doc_id")
    index = lines.line_index(hashes, shard_keys=shard_keys)
    assert index.count() > 1
    many = collected(lines.lines_to_drop(hashes, index, probes=probes))
    one = collected(lines.lines_to_drop(hashes, lines.line_index(hashes)))
    assert many == one and many


def test_keys_that_share_half_a_hash(spark):
    hashes = spark.createDataFrame([(i, 7, low) for low in (1, 2) for i in range(3 + low)], "id long, high long, low long")
    got = collected(lines.lines_to_drop(hashes, lines.line_index(hashes)))
    assert got == [(i, 7, low) for i in range(5) for low in (1, 2) if i < 2 + low]


def test_a_list_is_never_longer_than_its_document(documents):
    """Rows without an id, and rows that share one: each loses lines of its own only, copies of a text as one."""
    common = [f"a common line that many rows hold, number {i}" for i in range(30)]
    rows = [(None, "\n".join(common[i : i + 3])) for i in range(28)] + [(7, common[i]) for i in range(30)] + [(None, common[0])] * 20
    df = documents(rows)
    assert collected(lines.line_digests(df)) == plain(rows)
    hashes = lines.line_hashes(df, "doc_id")
    lost = lines.lines_to_drop(hashes, lines.line_index(hashes)).groupBy("id", "body").agg(F.countDistinct("high", "low").alias("n"))
    assert {r["n"] for r in lost.collect()} <= {1, 2, 3}
    assert lost.filter("id IS NULL").count() > 20


def test_columns_stay(documents):
    rows = cases(3)
    df = documents(rows, {"n_dropped": F.lit("mine"), "high": F.lit(1), "id": F.lit(2)})
    left = lines.drop_repeated_lines(df, length="n_chars")
    assert left.columns == df.columns and left.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert {r["n_dropped"] for r in left.collect()} == {"mine"}
    assert collected(left.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256))) == sorted(((r[0], r[3]) for r in plain(rows)), key=str)
    assert lines.drop_repeated_lines(df.limit(0)).collect() == []


def test_hard_rows(hard):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert collected(lines.line_digests(hard)) == plain(rows)
