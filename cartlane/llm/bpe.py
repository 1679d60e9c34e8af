"""Byte-level BPE: encoding by a replay of the merges over many words at once, and decoding.

A text is cut into the pattern's matches, its words. The distinct words of many documents are
one array of symbols with links to the left and right neighbour. An inverted index holds for
each pair that can merge the positions where it stands. Merges are applied in order of rank:
each takes its positions from the index, joins the two symbols there, and enters the pairs with
the new neighbours. Nothing else is touched. A document's ids are those of its words.

A task replays each distinct word once while its dictionary of words is below ``WORDS`` entries;
then it starts a new one, so memory is bounded for any input. The results do not depend on that.

Defined results: null and empty texts have no ids; equal rows have equal results; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cartlane.llm.shared import bounded
from cartlane.llm.texts import chunks

#: Distinct words that a task remembers.
WORDS = 500_000

#: Bytes of text whose words are merged together.
REPLAY_BYTES = 4 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Which pairs of ids merge, and into what: all splits of all tokens, looked up by arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self._width = max(ranks.values()) + 1
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                x, y = ranks.get(token[:cut]), ranks.get(token[cut:])
                if x is not None and y is not None:
                    found[x * self._width + y] = rank
        self._codes = np.array(sorted(found), np.int64)
        self._ranks = np.array([found[c] for c in self._codes.tolist()], np.int64)

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge."""
        code = x * self._width + y
        at = np.minimum(np.searchsorted(self._codes, code), len(self._codes) - 1)
        return np.where(self._codes[at] == code, self._ranks[at], -1)


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """The ids of every word, all words merged together in order of rank."""
    symbols = merges.single[np.frombuffer(b"".join(words), np.uint8)]
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    n = len(symbols)
    left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
    left[(ends - sizes)[sizes > 0]] = -1
    right[ends[sizes > 0] - 1] = -1
    # The rank of the pair that begins at each symbol; it changes when the pair does.
    rank_at = np.full(n, -1, np.int64)
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray) -> None:
        ranks = merges.of(symbols[places], symbols[right[places]])
        rank_at[places] = ranks
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        first = int(np.searchsorted(ranks, 0))
        cuts = [first, *(np.flatnonzero(ranks[first + 1 :] != ranks[first:-1]) + first + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist() if first < len(ranks) else (), cuts, cuts[1:]):
            if rank in index:
                index[rank].append(places[a:b])
            else:
                index[rank] = [places[a:b]]
                heapq.heappush(queue, rank)

    enter(np.flatnonzero(right >= 0))
    while queue:
        rank = heapq.heappop(queue)
        places = np.concatenate(index.pop(rank))
        places = places[rank_at[places] == rank]  # else an earlier merge took a side
        if len(places) > 1:
            places.sort()
            touching = np.flatnonzero(right[places[:-1]] == places[1:])
            if len(touching):  # of overlapping places every second one merges, from the left
                order = np.arange(len(places))
                begins = np.ones(len(places), bool)
                begins[touching + 1] = False
                places = places[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
        taken = right[places]
        after = right[taken]
        symbols[places], symbols[taken], rank_at[taken], rank_at[places] = rank, -1, -1, -1
        right[places] = after
        followed = after >= 0
        left[after[followed]] = places[followed]
        before = left[places]
        touched = np.concatenate([places[followed], before[before >= 0]])
        if len(touched):
            enter(np.unique(touched))
    kept = symbols >= 0
    ids = symbols[kept].tolist()
    stops = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])].tolist()
    return [ids[a:b] for a, b in zip(stops, stops[1:])]


class Codec:
    """Encodes and decodes with one vocabulary; remembers words up to a bound."""

    def __init__(self, path: str, pattern: str, words: int = WORDS):
        self.ranks = load_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._merges = Merges(self.ranks)
        self._names = {rank: str(rank) for rank in self.tokens}
        self._split = regex.compile(pattern).findall
        self._limit = words
        # What is asked for is remembered, not both: the ids, or their digits and bytes.
        self._ids: dict[str, list[int]] = {}
        self._listed: dict[str, str] = {}
        self._decoded: dict[str, bytes] = {}

    def _new(self, cut: list[list[str]], known: dict, *others: dict) -> Iterator[tuple[str, list[int]]]:
        """The words that are not known, with their ids."""
        new = {w for ws in cut for w in ws if w not in known}
        if len(known) + len(new) > self._limit:
            for memory in (known, *others):
                memory.clear()
            new = {w for ws in cut for w in ws}
        ordered = list(new)
        return zip(ordered, replay([w.encode() for w in ordered], self._merges))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        cut = [self._split(text) for text in texts]
        self._ids.update(self._new(cut, self._ids))
        return [[i for w in ws for i in self._ids[w]] for ws in cut]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, digest of the ids in decimal, digest of the decoded bytes, for each text."""
        cut = [self._split(text) for text in texts]
        for word, ids in self._new(cut, self._listed, self._decoded):
            self._listed[word] = " ".join(map(self._names.__getitem__, ids))
            self._decoded[word] = self.decode(ids)
        out = []
        for ws in cut:
            listed = " ".join(map(self._listed.__getitem__, ws)).encode()
            decoded = b"".join(map(self._decoded.__getitem__, ws))
            out.append(
                (listed.count(b" ") + 1 if listed else 0, hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest())
            )
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_documents(documents: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Documents with ``ids``, an array of token ids. No shuffle."""
    rows = bounded(documents).select(key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern)
        for chunk in chunks(batches, limit=REPLAY_BYTES):
            ids = codec.encode_all(chunk.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The bytes of ``ids`` as ``decoded``; no ids for null. An id outside the vocabulary is an error."""
    rows = encoded.select(key, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in load_ranks(path).items()}
        for batch in batches:
            decoded = [b"".join(map(tokens.__getitem__, ids or [])) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], [key, "decoded"])

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, decoded binary")


def token_digests(documents: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Number of ids and digests of ids and decoded bytes, one row per document. No shuffle."""
    rows = bounded(documents).select(key, "text")
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern)
        for chunk in chunks(batches, limit=REPLAY_BYTES):
            columns = zip(*codec.digests(chunk.column(1).to_pylist()))
            types = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([chunk.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names)

    return rows.mapInArrow(
        run, f"{key} {rows.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
