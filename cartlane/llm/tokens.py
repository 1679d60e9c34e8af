"""Token counts: what a tokenizer of the ``tokenizers`` library makes of every whole text.

A huge document is never one call of the library. It is encoded in chunks that overlap, with the
place of every token. Two neighbouring chunks are spliced where both have a token beginning, where
both agree on the tokens around it, and where the text proves that no token can reach over the
place, whatever stands before or after (``proven``). If the overlap holds no such place it is
doubled and both chunks are encoded again, at worst up to the end of the document.

Other documents are cut at white space of ASCII, which is such a place everywhere. A task encodes
each piece once while it remembers at most ``PIECES`` of them; then it forgets all. So memory is
bounded for any input, and the counts do not depend on it.

The proof is for tokenizers that drop white space and have a token of its own for every digit
before they merge, as ``word_bpe_49k.json`` does; ``Counter`` refuses any other.

Defined results: null and empty texts have no bytes and no tokens; equal rows have equal results;
other columns are ignored. No shuffle.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartlane.llm.shared import bounded
from cartlane.llm.texts import chunks

#: Code points from which on a document is huge, of a chunk, and of the first overlap.
HUGE, CHUNK, OVERLAP = 1 << 16, 1 << 15, 1 << 8

#: Pieces that a task remembers, and letters-only pieces that are encoded as one text.
PIECES, JOINED = 500_000, 1000

#: Bytes of text whose new pieces are encoded together.
TEXT_BYTES = 4 << 20

#: Tokens up to which a document fits.
LIMIT = 2048

_PIECE = re.compile(rb"[^\x20\t-\r]+")
_SPACE, _DIGIT = frozenset(" \t\n\x0b\x0c\r"), frozenset("0123456789")
_PLAIN_END = frozenset(b"abcdefghijklmnopqrstuvwxyz")

# The pattern and the steps of the vocabulary's file that the proof is about.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = ["NFC", "Replace", "Lowercase"]
_WORD_END = "</w>"


def proven(text: str, at: int) -> bool:
    """Whether tokens end at ``at`` in every text that has these two characters there.

    White space is dropped, a digit is a match of its own, and neither takes part in a composition
    or stands in a special token.
    """
    return text[at - 1] in _SPACE or text[at - 1] in _DIGIT or text[at] in _DIGIT


class Chunk:
    """A part of a text from ``begin`` on, its ids and the place in the text where each begins."""

    def __init__(self, tokenizer: Tokenizer, text: str, begin: int, end: int):
        found = tokenizer.encode(text[begin:end], add_special_tokens=False)
        self.end = min(end, len(text))
        self.ids = np.array(found.ids, np.int64)
        self.places = np.array([a for a, _ in found.offsets], np.int64) + begin

    def before(self, place: int) -> int:
        return int(np.searchsorted(self.places, place))


def splice(text: str, left: Chunk, right: Chunk, begin: int, end: int) -> int | None:
    """A proven place between ``begin`` and ``end`` from which on both chunks have the same tokens."""
    common = np.intersect1d(left.places, right.places)
    places = [at for at in common[(common > begin) & (common < end)].tolist() if proven(text, at)]
    # Between two such places the chunks have to agree; the nearest to the middle goes first.
    for at, after in sorted(zip(places, places[1:]), key=lambda p: abs(2 * p[0] - begin - end)):
        mine, other = left.ids[left.before(at) : left.before(after)], right.ids[right.before(at) : right.before(after)]
        if np.array_equal(mine, other):
            return at
    return None


def count_huge(tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of a text, by chunks of ``chunk`` code points and an overlap."""
    total, first, begin = 0, 0, 0
    left = Chunk(tokenizer, text, 0, chunk + overlap)
    while left.end < len(text):
        wide = overlap
        start = begin + chunk
        while True:
            right = Chunk(tokenizer, text, start, start + max(chunk, wide) + overlap)
            at = splice(text, left, right, start, left.end)
            if at is not None:
                break
            wide *= 2
            left = Chunk(tokenizer, text, begin, start + wide)
            if left.end == len(text):
                return total + len(left.ids) - left.before(first)
        total += left.before(at) - left.before(first)
        left, begin, first = right, start, at
    return total + len(left.ids) - left.before(first)


class Counter:
    """Counts tokens with one vocabulary file; remembers pieces up to a bound."""

    def __init__(self, path: str, pieces: int = PIECES, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP):
        # One task, one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as lines:
            _check(json.load(lines))
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._special = tuple(t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values())
        ends = np.zeros(max(self._tokenizer.get_vocab().values()) + 1, bool)
        ends[[i for t, i in self._tokenizer.get_vocab().items() if t.endswith(_WORD_END)]] = True
        self._ends = ends
        self._limit, self._huge, self._chunk, self._overlap = pieces, huge, chunk, overlap
        self._known: dict[bytes, int] = {}

    def count_all(self, texts: list[str]) -> list[int]:
        cut = [[] if len(text) > self._huge else self._pieces(text) for text in texts]
        self._learn(cut)
        count = self._known.__getitem__
        return [
            count_huge(self._tokenizer, text, self._chunk, self._overlap) if len(text) > self._huge else sum(map(count, pieces))
            for text, pieces in zip(texts, cut)
        ]

    def _pieces(self, text: str) -> list[bytes]:
        data = text.encode()
        # The tokenizer lowers letters too, but only after it has found special tokens.
        return _PIECE.findall(data if b"<" in data else data.lower())

    def _learn(self, cut: list[list[bytes]]) -> None:
        known = self._known
        new = {p for pieces in cut for p in pieces if p not in known}
        if len(known) + len(new) > self._limit:
            known.clear()
            new = set().union(*cut)
        # A full stop or comma after a letter is a token of its own at the end of a piece.
        cores = {p: p[:-1] for p in new if len(p) > 1 and p[-1] in b".," and p[-2] in _PLAIN_END and not p.startswith(self._special)}
        wanted = {cores.get(p, p) for p in new} - known.keys()
        words = [p for p in wanted if p.decode().isalpha()]
        counts = self._words(words)
        counts.update(self._each([p for p in wanted if p not in counts]))
        one = len(self._tokenizer.encode(".", add_special_tokens=False).ids)
        for piece in new:
            core = cores.get(piece)
            if core is None:
                known[piece] = counts[piece]
            else:
                known[piece] = one + (counts[core] if core in counts else known[core])

    def _each(self, pieces: list[bytes]) -> dict[bytes, int]:
        found = self._tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return {p: len(e.ids) for p, e in zip(pieces, found)}

    def _words(self, words: list[bytes]) -> dict[bytes, int]:
        """The counts of pieces of letters: many as one text, cut again after each token that ends a word."""
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        found = self._tokenizer.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)
        out: dict[bytes, int] = {}
        for part, encoded in zip(parts, found):
            ends = np.flatnonzero(self._ends[np.array(encoded.ids, np.int64)])
            # A piece has one such token at least, so as many as pieces means one each.
            out.update(zip(part, np.diff(ends, prepend=-1).tolist()) if len(ends) == len(part) else self._each(part))
        return out


def _check(file: dict) -> None:
    steps = [s["type"] for s in (file.get("normalizer") or {}).get("normalizers", [])]
    cuts = [s.get("pattern", {}).get("Regex") for s in (file.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    ends = file["model"].get("end_of_word_suffix")
    plain = all(set(t["content"]).isdisjoint(_SPACE | _DIGIT | set(".,")) and "<" in t["content"] for t in file.get("added_tokens", []))
    if steps != _STEPS or cuts[:1] != [_SPLIT] or ends != _WORD_END or not plain:
        raise ValueError("no place is proven to be stable for this tokenizer")


def count_tokens(
    documents: DataFrame,
    path: str,
    key: str = "doc_id",
    limit: int = LIMIT,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: ``n_bytes`` of UTF-8, ``n_tokens``, and ``over_limit``. No shuffle."""
    rows = bounded(documents).select(key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, huge=huge, chunk=chunk, overlap=overlap)
        for part in chunks(batches, limit=TEXT_BYTES):
            texts = part.column(1)
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            counts = pa.array(counter.count_all(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), sizes, counts], [key, "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
