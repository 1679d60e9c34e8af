"""Secret scan: three kinds of assignments and keys, and high-entropy strings.

A candidate is a run of 20 or more characters that tokens are made of. A window slides over
it; the counts of its characters change by one in and one out, and so does the sum that
Shannon's entropy is made from. The threshold depends on the class of the window's characters,
since 16 hex digits can carry at most four bits each and digits fewer. Windows over the
threshold join to spans of kind ``entropy``.

Defined results: null and empty texts have no spans; equal rows have equal results; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from cartlane.llm.shared import bounded
from cartlane.llm.texts import chunks

KINDS = ("assign", "access", "hex")

# The patterns of the three kinds. Letters of the names in either case, ASCII only.
_NAMES = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
_NAMES += "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_ASSIGN = re.compile(rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of one class are never cut, so 24 at least is the same as dropping shorter matches.
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

#: Characters in a window, and bits per character that a window of each class has to reach.
WINDOW = 20
THRESHOLDS = {"digits": 3.1, "hex": 3.4, "lower": 3.9, "letters": 4.0, "mixed": 3.7}

#: What is no secret though it looks random: names of hashes and ids stand right before it,
#: or the string itself is an id with dashes, a path, or a name in parts.
ALLOW_BEFORE = re.compile(r"(?:sha(?:1|256|512)|md5|crc32|etag|commit|rev|uuid|integrity)[\s:=\"'-]*$", re.IGNORECASE)
ALLOW_WHOLE = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?:/?[A-Za-z0-9_-]+)(?:/[a-z0-9_-]+){2,}/?"),
    re.compile(r"[A-Za-z]*(?:[_-][A-Za-z]+)+"),
)

#: What stands for a secret: windows that touch it are none, whatever is beside it in the run still counts.
PLACEHOLDER = re.compile(r"EXAMPLE|example|placeholder|x{5,}|X{5,}|changeme")

Span = tuple[int, int, int]


class Scan(NamedTuple):
    base: list[Span]  # (begin, kind, end), by begin and kind
    found: list[Span]  # those of kind ``entropy``


def _class(digits: int, hexes: int, lower: int, letters: int, size: int) -> str:
    if digits == size:
        return "digits"
    if digits + hexes == size:
        return "hex"
    if lower == size:
        return "lower"
    return "letters" if letters == size else "mixed"


def entropy_spans(token: str, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS) -> list[tuple[int, int]]:
    """Joined windows of ``token`` whose entropy reaches the threshold of their class.

    One step takes one character out and one in: linear in the token, whatever the window.
    """
    cost = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, kinds = 0.0, [0, 0, 0, 0]
    marks = {c: (c.isdigit(), c in "abcdefABCDEF", c.islower(), c.isalpha()) for c in set(token)}  # as in _class
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(token):
        if i >= window:
            out = token[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += cost[n - 1] - cost[n]
            for k, on in enumerate(marks[out]):
                kinds[k] -= on
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += cost[n + 1] - cost[n]
        for k, on in enumerate(marks[c]):
            kinds[k] += on
        if i >= window - 1:
            bits = math.log2(window) - total / window
            if bits >= thresholds[_class(*kinds, window)]:
                begin = i - window + 1
                if spans and begin <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((begin, i + 1))
    return spans


def _pieces(token: str) -> Iterator[tuple[int, str]]:
    """What is between placeholders, with its place, where a window fits in."""
    begin = 0
    for m in PLACEHOLDER.finditer(token):
        if m.start() - begin >= WINDOW:
            yield begin, token[begin : m.start()]
        begin = m.end()
    if len(token) - begin >= WINDOW:
        yield begin, token[begin:]


def scan(text: str) -> Scan:
    """All spans of one whole text, in code points."""
    base = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found = []
    for m in _CANDIDATE.finditer(text):
        token = m.group()
        if ALLOW_BEFORE.search(text, max(0, m.start() - 16), m.start()) or any(p.fullmatch(token) for p in ALLOW_WHOLE):
            continue
        for begin, piece in _pieces(token):
            if not any(p.fullmatch(piece) for p in ALLOW_WHOLE):
                found += [(m.start() + begin + b, len(KINDS), m.start() + begin + e) for b, e in entropy_spans(piece)]
    return Scan(sorted(base), found)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{(*KINDS, 'entropy')[k]}:{b}:{e}" for b, k, e in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def scan_secrets(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: counts of each kind, a digest of the base spans and all spans. No shuffle."""
    rows = bounded(documents).select(key, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            out: list[tuple] = []
            for text in chunk.column(1).to_pylist():
                base, found = scan(text)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(_listed(base).encode()).hexdigest()
                out.append((*counts, len(found), digest, _listed(sorted(base + found))))
            columns = list(zip(*out))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], [key, *names]
            )

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {SCHEMA}")
