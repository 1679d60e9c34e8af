"""Benchmark decontamination: which words of a document stand in a window of a test item.

Texts become lower-case words. A window is ``WINDOW`` consecutive words of an item, or all words
of a shorter item. Every window holds a whole block of ``WINDOW // 2`` words that begins at a
multiple of that in its item. So the automaton holds each item once, cut into blocks, not
every window. A document is scanned once; where a block occurs, item and document are
followed to both sides as far as they agree, and a run of a window or more is a hit.

The items go to the tasks as text, ``ITEMS_BYTES`` at most; a larger benchmark is dealt into
groups, one pass each. A task makes its automata from ``AUTOMATON_BYTES`` of items at a time.

Defined results: null and empty texts have no words and no hits; an item without words is in no
document; repeated items count by distinct id, a null id as an empty one; repeated documents
have equal results; extra columns are ignored, but kept by ``clean_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.llm.shared import bounded, kept
from cartlane.llm.texts import chunks

#: Words in a window.
WINDOW = 10

#: Bytes of items that are sent to every task, and that are in one automaton.
ITEMS_BYTES = 16 << 20
AUTOMATON_BYTES = 4 << 20

#: Bytes of text that are scanned with one automaton before the next one is made.
SCAN_BYTES = 16 << 20

# Word characters: digits, letters in lower case, and all that is not ASCII.
_WORD_BYTES = frozenset(range(0x30, 0x3A)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
_TABLE = bytes(b if b in _WORD_BYTES else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

Item = tuple[str, list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    """The words in lower case, as bytes. Only A-Z change case."""
    return (text or "").encode().lower().translate(_TABLE).split()


class Run(NamedTuple):
    """``count`` equal blocks of item ``n``, the first from word ``begin`` to ``end``, each ``step`` words after
    the one before; what lies between is equal too, so the item has the period ``step`` there."""

    n: int
    begin: int
    end: int
    count: int
    step: int


def runs_of(n: int, words: list[bytes], places: list[int], size: int) -> list[Run]:
    """The runs of equal blocks of ``size`` words that begin at ``places`` of an item."""
    out: list[Run] = []
    i = 0
    while i < len(places):
        j, step = i + 1, places[i + 1] - places[i] if i + 1 < len(places) else 0
        while j < len(places) and places[j] - places[j - 1] == step and words[places[j - 1] : places[j]] == words[places[i] : places[i] + step]:
            j += 1
        out.append(Run(n, places[i], places[i] + size, j - i, step))
        i = j
    return out


class Finder:
    """One automaton over the blocks of some items.

    A block that repeats in an item, as in a word said over and over, meets every one of its kind in a
    document. Such blocks are runs with a period on both sides. Of all ways to lay one run over the other only
    those are followed that differ in what comes before or behind: where the runs begin or end together,
    and one period beside that. All others find the same words.
    """

    def __init__(self, items: list[Item], window: int = WINDOW):
        self._items, self._window = items, window
        block = window // 2
        short: dict[str, list[int]] = {}
        places: dict[str, dict[int, list[int]]] = {}
        name = lambda ws: f" {b' '.join(ws).decode('latin-1')} "
        for n, (_, words) in enumerate(items):
            if words and len(words) < window:
                short.setdefault(name(words), []).append(n)
            elif words:
                for i in range(0, len(words) - block + 1, block):
                    places.setdefault(name(words[i : i + block]), {}).setdefault(n, []).append(i)
        self._patterns: list[tuple[list[int], list[Run]]] = []
        self._automaton = ahocorasick.Automaton()
        for pattern in short.keys() | places.keys():
            runs = [r for n, at in places.get(pattern, {}).items() for r in runs_of(n, items[n][1], at, block)]
            self._automaton.add_word(pattern, (len(pattern), len(self._patterns)))
            self._patterns.append((short.get(pattern, []), runs))
        self._empty = not self._patterns
        if not self._empty:
            self._automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges that lie in occurrences of windows, and the ids of the items."""
        if self._empty or not words:
            return [], set()
        text = f" {b' '.join(words).decode('latin-1')} "
        met = [(pattern, end - length + 1) for end, (length, pattern) in self._automaton.iter(text)]
        if not met:
            return [], set()
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        begins = np.searchsorted(spaces, [at for _, at in met]).tolist()
        hits: dict[int, list[int]] = {}
        for (pattern, _), at in zip(met, begins):
            hits.setdefault(pattern, []).append(at)
        ranges: list[tuple[int, int]] = []
        ids: set[str] = set()
        laid: set[tuple[int, int, int, int]] = set()
        for pattern, places in hits.items():
            short, runs = self._patterns[pattern]
            for n in short:
                ids.add(self._items[n][0])
                ranges += [(at, at + len(self._items[n][1])) for at in places]
            by_step: dict[int, list[tuple[int, int]]] = {}
            for run in runs:
                if run.step not in by_step:
                    by_step[run.step] = _in_document(words, places, run.step)
                for at, count in by_step[run.step]:
                    self._lay(words, run, at, count, ranges, ids, laid)
        seen: dict[tuple[int, int], int] = {}  # how far an item has been followed at this shift
        for at, n, a, size in sorted(laid):
            self._follow(words, n, at, a, size, ranges, ids, seen)
        return ranges, ids

    def _lay(self, words: list[bytes], run: Run, at: int, count: int, ranges, ids, laid) -> None:
        """Adds the ways to lay a run of an item over one of a document, ``count`` blocks from ``at`` on."""
        n, step, size = run.n, run.step, run.end - run.begin
        between = self._items[n][1][run.end : run.begin + step]
        if count > 1 and words[at + size : at + step] != between:
            for k in range(count):
                self._lay(words, run, at + k * step, 1, ranges, ids, laid)
            return
        longest = min((run.count - 1) * step + size, (count - 1) * step + size)
        if run.count > 1 and count > 1 and longest >= self._window:
            ranges.append((at, at + (count - 1) * step + size))
            ids.add(self._items[n][0])
        ends = run.count - count
        for shift in {s for s in (-1, 0, 1, ends - 1, ends, ends + 1) if -count < s < run.count}:
            # The first block of the document's run lies on block ``shift`` of the item's.
            laid.add((at + max(0, -shift) * step, n, run.begin + max(0, shift) * step, size))

    def _follow(self, words: list[bytes], n: int, at: int, a: int, size: int, ranges, ids, seen) -> None:
        """What agrees around equal blocks at ``at`` of the document and ``a`` of the item."""
        if seen.get((n, at - a), -1) >= at + size:
            return
        name, item = self._items[n]
        begin, i = at, a
        while begin and i and words[begin - 1] == item[i - 1]:
            begin, i = begin - 1, i - 1
        stop, i = at + size, a + size
        while stop < len(words) and i < len(item) and words[stop] == item[i]:
            stop, i = stop + 1, i + 1
        seen[n, at - a] = stop
        if stop - begin >= self._window:
            ranges.append((begin, stop))
            ids.add(name)


def _in_document(words: list[bytes], places: list[int], step: int) -> list[tuple[int, int]]:
    """Runs of a block in a document: where each begins, and how many follow ``step`` words apart with equal words between."""
    if not step:
        return [(at, 1) for at in places]
    there = set(places)
    joined = {at for at in places if at + step in there and words[at : at + step] == words[at + step : at + 2 * step]}
    joined |= {at for at in places if at + step in there and at - step in joined}
    out = []
    for at in places:
        if at - step in joined:
            continue
        count = 1
        while at in joined:
            at, count = at + step, count + 1
        out.append((at - (count - 1) * step, count))
    return out


def merged_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in disjoint ranges, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code points of the text itself."""
    if not ranges:
        return []
    places = [m.span() for m in _WORD.finditer(text.translate(_ASCII_LOWER))]
    return [(places[b][0], places[e - 1][1]) for b, e in ranges]


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _blocks(items: list[Item], limit: int) -> Iterator[list[Item]]:
    block: list[Item] = []
    size = 0
    for item in items:
        n = sum(map(len, item[1])) + len(item[1])
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append(item)
        size += n
    if block:
        yield block


_RANGES = "array<struct<begin:int,end:int>>"
_FOUND = {"__words": "long", "__ranges": _RANGES, "__spans": _RANGES, "__items": "array<string>"}


def _item_groups(benchmark: DataFrame, item_key: str, columns: list[str], limit: int) -> Iterator[list[Item]]:
    rows = benchmark.select(
        F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("id"),
        F.concat_ws("\n", *columns).alias("text"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.length("id") + 16), F.lit(0)).alias("n")).first()["n"]
    # Each group is bounded by the limit, with room for the unevenness of a hash.
    groups = 1 if size <= limit else 2 * -(-size // limit)
    for g in range(groups):
        part = rows if groups == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g)
        yield [(r["id"], words_of(r["text"])) for r in part.toLocalIterator()]


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    item_key: str = "item_id",
    columns: tuple[str, ...] = ("text",),
    window: int = WINDOW,
    items_bytes: int = ITEMS_BYTES,
    automaton_bytes: int = AUTOMATON_BYTES,
    scan_bytes: int = SCAN_BYTES,
) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``spans`` (hit ranges in code points), ``items`` (sorted ids).

    ``columns`` of an item, such as question and answer, are joined by a line end. No shuffle.
    """
    rows = bounded(documents).withColumns({c: F.lit(None).cast(t) for c, t in _FOUND.items()})
    schema = rows.schema
    names = rows.columns
    spark = documents.sparkSession
    for n, group in enumerate(_item_groups(benchmark, item_key, list(columns), items_bytes)):
        if n:
            rows = kept(rows, "decontaminate")
        sent = spark.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            blocks = list(_blocks(sent.value, automaton_bytes))
            single = Finder(blocks[0], window) if len(blocks) == 1 else None
            for chunk in chunks(batches, limit=scan_bytes):
                texts = chunk.column(names.index("text")).to_pylist()
                earlier = zip(*(chunk.column(names.index(c)).to_pylist() for c in ("__ranges", "__items")))
                found = [([(x["begin"], x["end"]) for x in r or ()], set(i or ())) for r, i in earlier]
                counts = []
                for k, block in enumerate(blocks or [[]]):
                    finder = single or Finder(block, window)
                    for at, text in enumerate(texts):
                        words = words_of(text)
                        if not k:
                            counts.append(len(words))
                        ranges, ids = finder.find(words)
                        found[at][0].extend(ranges)
                        found[at][1].update(ids)
                ranges = [merged_ranges(r) for r, _ in found]
                spans = [original_spans(t, r) for t, r in zip(texts, ranges)]
                pairs = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
                as_rows = lambda many: pa.array([[{"begin": b, "end": e} for b, e in r] for r in many], pairs)
                fresh = {
                    "__words": pa.array(counts, pa.int64()),
                    "__ranges": as_rows(ranges),
                    "__spans": as_rows(spans),
                    "__items": pa.array([sorted(i) for _, i in found], pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays([fresh.get(c, chunk.column(k)) for k, c in enumerate(names)], names)

        rows = rows.mapInArrow(run, schema)
    hit = F.aggregate("__ranges", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["begin"]))
    found = {"n_words": F.col("__words"), "n_hit": hit, "spans": F.col("__spans"), "items": F.col("__items")}
    return rows.withColumns(found).drop(*_FOUND)


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns as they were."""
    rest = F.struct(*(f"`{c}`" for c in documents.columns if c != "text"))
    found = find_items(documents.select("text", rest.alias("__rest")), benchmark, **options).filter("n_hit = 0")
    return found.select(*(c if c == "text" else f"__rest.`{c}`" for c in documents.columns))
