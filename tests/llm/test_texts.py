import random
import re

import numpy as np
import pyarrow as pa

from cartlane.llm.perfect import PerfectHash
from cartlane.llm.texts import RangeHash, byte_table, chunks, flat, lowered, words


def test_words_and_hashes_of_ranges():
    texts = ["the Cat the cat", "", "a", " x ", "the", "cät cät"]
    data, offsets = flat(pa.array(texts))
    begins, ends, before = words(lowered(data), offsets, byte_table(lambda b: b != 32))
    got = [bytes(lowered(data)[a:b]).decode() for a, b in zip(begins, ends)]
    assert got == [w for t in texts for w in re.findall(r"[^ ]+", t.replace("C", "c"))]
    assert np.diff(before).tolist() == [4, 0, 1, 1, 1, 2]
    hashes = RangeHash(lowered(data))(begins, ends).tolist()
    assert len(set(zip(got, hashes))) == len(set(got)) == len(set(hashes))


def test_slices_keep_their_offsets():
    data, offsets = flat(pa.array(["abc", "de", "f"]).slice(1))
    assert bytes(data) == b"def" and offsets.tolist() == [0, 2, 3]


def test_chunks_are_bounded_and_whole():
    texts = ["x" * n for n in (5, 5, 50, 1, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["id", "text"])
    got = [c.column(1).to_pylist() for c in chunks(iter([batch]), limit=10)]
    assert sum(got, []) == [t or "" for t in texts]
    assert [len(c) for c in got] == [2, 1, 3]


def test_perfect_hash_is_minimal():
    draw = random.Random(1)
    keys = np.array(sorted({draw.getrandbits(64) for _ in range(5000)}), np.uint64)
    found = PerfectHash.build(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(5000))
    assert len(found.bits) * 8 / 5000 < 8
    others = np.array([draw.getrandbits(64) for _ in range(1000)], np.uint64)
    assert set(found.slots(others).tolist()) <= set(range(-1, 5000))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3
