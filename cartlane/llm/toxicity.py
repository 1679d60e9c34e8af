"""Toxicity: a convolutional text classifier in numpy.

A word is the sum of the embeddings of three hashes: of itself and of its beginnings of four and
six bytes, so that endings need not be seen in training. Hashes fall into ``SLOTS`` slots, so the model's
size is fixed; slots seen in fewer than two documents have the zero embedding. Filters of several widths
run over the words, each keeps its maximum over the document, and a logistic layer makes a score of those.
Thresholds are calibrated for each language on labelled documents by a model they were left out of: the score is
made from the text alone, and only the decision looks up the language.

All labelled documents that are not held out are learnt from or calibrated on. They are dealt into
pieces by a hash of the id, whole texts. In a round each piece starts from the same model
and goes through its documents; what the pieces changed is averaged, an embedding over the pieces that
touched it. Documents, slots and scores are counted by Spark, so neither a task nor the driver meets
more than a piece or the model. Every document is scored whole.

Defined results: null and empty texts get the score of no words, which is below all thresholds if ``crossed``; a language
without enough labelled documents has the threshold of all; without labels of both kinds the score is the share
of toxic labels (0 without labels) and nothing is flagged; repeated labels of an id count once,
toxic if any is; extra columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlane.llm.shared import bit_filter, bounded, dropped, fetched, filter_place, in_filter, kept
from cartlane.llm.texts import RangeHash, byte_table, chunks, flat, lowered, mixed, words

#: Rows that hashes fall into, two to the power of a whole number.
SLOTS = 1 << 18

#: Documents of a piece, more or less, and words at most unless one document has more.
PIECE, PIECE_WORDS = 4_096, 1 << 21

#: One in so many labelled documents is left out of the fit, to calibrate on.
LEFT_OUT = 5

WIDTHS, FILTERS, SIZE = (1, 2, 3), 8, 16
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7
#: Steps at least: few documents are gone through more often.
STEPS = 1000
#: How often the pieces are averaged, and how often a piece is gone through in between at least.
ROUNDS, PASSES = 2, 3
#: Scores are counted in so many bins for thresholds; rows of the model that are averaged at once.
BINS, BLOCK = 1 << 14, 1 << 12
#: What flagging a clean document costs, where missing a toxic one costs 1; there are more of these.
FALSE_COST = 4
#: How far a threshold is above a score that is not to be flagged, at least.
LEAST_GAP = 1e-4
#: Labelled documents of each kind that a language needs for a threshold of its own.
LEAST_LANGUAGE = 10

_PAD = max(WIDTHS)
_BEGINNINGS = (4, 6)
_WORD = byte_table(lambda b: chr(b).isalnum() if b < 128 else True)


class Model(NamedTuple):
    keys: np.ndarray  # slots that have an embedding, sorted
    embeddings: np.ndarray  # one row each, and the zero row
    filters: tuple[np.ndarray, ...]  # by width: (width, SIZE, FILTERS)
    biases: tuple[np.ndarray, ...]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float]  # by language
    threshold: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Three slots for each word, and the number of words before each text."""
    data, offsets = flat(texts)
    data = lowered(data)
    begins, ends, before = words(data, offsets, _WORD)
    hashed = RangeHash(data)
    parts = [hashed(begins, ends)]
    for n, size in enumerate(_BEGINNINGS):
        parts.append(mixed(hashed(begins, np.minimum(ends, begins + size)) + np.uint64(n + 1)))
    return np.stack(parts, axis=1) % np.uint64(SLOTS), before


def _row_of(keys: np.ndarray) -> np.ndarray:
    """The embedding row of each slot."""
    out = np.full(SLOTS, len(keys), np.int32)
    out[keys.astype(np.int64)] = np.arange(len(keys))
    return out


def _rows(row_of: np.ndarray, none: int, slots: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of padded texts, and where each begins."""
    n = len(before) - 1
    begins = before + np.arange(n + 1) * _PAD
    rows = np.full((begins[-1], slots.shape[1]), none, np.int32)
    rows[np.arange(len(slots)) + np.repeat(np.arange(n) * _PAD, np.diff(before))] = row_of[slots.astype(np.int64)]
    return rows, begins


def _convolved(x: np.ndarray, filters: np.ndarray, bias: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The filters at every word; places that reach into the next text lose."""
    width = len(filters)
    out = np.empty((len(x), filters.shape[2]), x.dtype)
    out[:] = x @ filters[0]
    for j in range(1, width):
        out[:-j] += x[j:] @ filters[j]
    out += bias
    for j in range(1, width):
        out[begins[1:] - j] = -1e9
    return out


def _logits(model: Model, rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    x = model.embeddings[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        x += model.embeddings[rows[:, k]]
    pooled = [
        np.maximum.reduceat(_convolved(x, f, b, begins), begins[:-1], axis=0) for f, b in zip(model.filters, model.biases)
    ]
    return np.maximum(np.concatenate(pooled, axis=1), 0) @ model.weights + model.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores from 0 to 1 of whole texts."""
    if not len(texts):
        return np.zeros(0)
    return _scores(model, *features(texts))


def _scores(model: Model, slots: np.ndarray, before: np.ndarray) -> np.ndarray:
    return _sigmoid(_logits(model, *_rows(_row_of(model.keys), len(model.keys), slots, before)).astype(np.float64))


class _Adam:
    def __init__(self, rate: float):
        self._rate, self._moments, self._step = rate, {}, 0

    def begin(self) -> None:
        self._step += 1

    def move(self, name, value: np.ndarray, slope: np.ndarray) -> None:
        first, second = self._moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        scale = self._rate * np.sqrt(1 - 0.999**self._step) / (1 - 0.9**self._step)
        value -= (scale * first / (np.sqrt(second) + 1e-8)).astype(value.dtype)


class _State(NamedTuple):
    """What is learnt: arrays that learning changes in place."""

    table: np.ndarray  # embeddings, the zero row last, and a column of how much each has moved
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    weights: np.ndarray
    bias: np.ndarray

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.biases, self.weights, self.bias]

    def copy(self) -> _State:
        return _State(
            self.table.copy(), tuple(f.copy() for f in self.filters), tuple(b.copy() for b in self.biases),
            self.weights.copy(), self.bias.copy(),
        )

    def model(self, keys: np.ndarray) -> Model:
        embeddings = np.ascontiguousarray(self.table[:, :SIZE])
        return Model(keys, embeddings, self.filters, self.biases, self.weights, float(self.bias[0]), {}, 0.5)


def _begun(keys: np.ndarray, draw: np.random.Generator) -> _State:
    table = np.full((len(keys) + 1, SIZE + 1), 1e-6, np.float32)
    for begin in range(0, len(keys), BLOCK):
        part = table[begin : min(begin + BLOCK, len(keys)), :SIZE]
        part[:] = draw.normal(0, 0.1, part.shape)
    table[-1, :SIZE] = 0
    filters = tuple(draw.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS)
    biases = tuple(np.zeros(FILTERS, np.float32) for _ in WIDTHS)
    weights = draw.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
    return _State(table, filters, biases, weights, np.zeros(1, np.float32))


def _one_sided(share: float) -> Model:
    """The model without labels of both kinds: always their share, and nothing is flagged."""
    state = _begun(np.zeros(0, np.uint64), np.random.default_rng(SEED))
    state.weights[:] = 0
    return state.model(np.zeros(0, np.uint64))._replace(bias=-30.0 if share == 0 else 30.0, threshold=2.0)


def _passes(documents: int, least: int) -> int:
    return max(least, -(-STEPS * BATCH // max(documents, 1)))


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """The model without thresholds, of texts in memory."""
    draw = np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 0, 1))
    if share in (0.0, 1.0):
        return _one_sided(share)
    slots, before = features(pa.array(texts, pa.string()))
    keys, counts = _seen(slots, before, np.ones(len(texts), bool))
    keys = keys[counts >= 2].astype(np.uint64)
    state = _begun(keys, draw)
    _learn(state, _row_of(keys), slots, before, np.arange(len(texts)), labels, share, _passes(len(texts), epochs), draw)
    return state.model(keys)


def _seen(slots: np.ndarray, before: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots, and in how many of the wanted documents each occurs."""
    found = [np.unique(slots[a:b]) for a, b, w in zip(before, before[1:], wanted) if w]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _learn(
    state: _State, row_of: np.ndarray, slots: np.ndarray, before: np.ndarray, documents: np.ndarray, labels: np.ndarray,
    share: float, passes: int, draw: np.random.Generator,
) -> None:
    """Goes through the documents. The slope goes to the few words that are a filter's maximum."""
    embeddings, squares = state.table[:, :SIZE], state.table[:, SIZE]
    filters, biases, weights, bias = state.filters, state.biases, state.weights, state.bias
    none = len(embeddings) - 1
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    adam = _Adam(RATE)
    for _ in range(passes):
        order = draw.permutation(documents)
        for a in range(0, len(order), BATCH):
            picked = order[a : a + BATCH]
            said = np.concatenate([slots[before[i] : before[i + 1]] for i in picked])
            rows, begins = _rows(row_of, none, said, np.concatenate([[0], np.cumsum(before[picked + 1] - before[picked])]))
            # Words are left out at random: no document may rest on one of them alone.
            rows = np.where(draw.random(rows.shape) < 0.1, none, rows)
            x = embeddings[rows].sum(axis=1)
            maxima, places = [], []
            for f, b in zip(filters, biases):
                out = _convolved(x, f, b, begins)
                at = np.stack([out[s:e].argmax(axis=0) + s for s, e in zip(begins, begins[1:])])
                places.append(at)
                maxima.append(np.take_along_axis(out, at, axis=0))
            pooled = np.maximum(np.concatenate(maxima, axis=1), 0)
            slope = (_sigmoid(pooled @ weights + bias[0]) - labels[picked]) * importance[picked] / len(picked)
            adam.begin()
            inner = slope[:, None] * weights * (pooled > 0)
            adam.move("weights", weights, pooled.T @ slope + 1e-4 * weights)
            adam.move("bias", bias, np.array([slope.sum()]))
            at_rows, at_slopes = [], []
            for n, (f, at) in enumerate(zip(filters, places)):
                part = inner[:, n * FILTERS : (n + 1) * FILTERS]
                change = np.empty_like(f)
                for j in range(len(f)):
                    near = x[at + j]  # texts, filters, SIZE
                    change[j] = np.einsum("tf,tfs->sf", part, near)
                    at_rows.append(rows[at + j].reshape(-1, rows.shape[1]))
                    at_slopes.append((part[:, :, None] * f[j].T[None]).reshape(-1, SIZE))
                adam.move(("filter", n), f, change + 1e-4 * f)
                adam.move(("bias", n), biases[n], part.sum(axis=0))
            touched, group = np.unique(np.concatenate(at_rows), return_inverse=True)
            total = np.zeros((len(touched), SIZE), np.float32)
            group = group.reshape(-1, rows.shape[1])
            for k in range(rows.shape[1]):
                np.add.at(total, group[:, k], np.concatenate(at_slopes).astype(np.float32))
            total[touched == none] = 0
            squares[touched] += (total * total).mean(axis=1)
            embeddings[touched] -= 0.05 * total / np.sqrt(squares[touched])[:, None]


def best_threshold(got: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among the thresholds with the least cost of errors."""
    order = np.argsort(got)
    return _best_threshold(got[order], got[order], labels[order], 1 - labels[order])


def _best_threshold(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """That of bins of scores in order: the least and largest score of each, and how many there are of both kinds."""
    cuts = np.concatenate([[0.0], (low[1:] + high[:-1]) / 2, [1.0]])
    gaps = np.concatenate([[low[0]], low[1:] - high[:-1], [1 - high[-1]]])
    missed = np.concatenate([[0], np.cumsum(toxic)])
    false = clean.sum() - np.concatenate([[0], np.cumsum(clean)])
    errors = missed + FALSE_COST * false
    errors[0] = np.inf  # never flag all
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(max(cuts[least[np.argmax(gaps[least])]], 1e-6))


def calibrated(model: Model, got: np.ndarray, labels: np.ndarray, languages: list[str | None]) -> Model:
    """The model with a threshold for all and one for each language with enough labels."""
    names = [x or "" for x in languages]
    _, at = np.unique(got, return_inverse=True)
    rows = pd.DataFrame({"lang": names, "bin": at, "low": got, "high": got, "toxic": labels, "clean": 1 - labels})
    return _calibrated(model, rows)


def _calibrated(model: Model, bins: pd.DataFrame, floor: float = 0.0) -> Model:
    """That from rows of ``lang, bin, low, high, toxic, clean``.

    Where the score ``floor`` would be flagged, the threshold goes halfway to the next score above.
    """

    def best(rows: pd.DataFrame) -> float:
        added = rows.groupby("bin", sort=True).agg({"low": "min", "high": "max", "toxic": "sum", "clean": "sum"})
        low, high, toxic, clean = (added[c].to_numpy(np.float64) for c in ("low", "high", "toxic", "clean"))
        found = _best_threshold(low, high, toxic, clean)
        if found > floor:
            return found
        return max((floor + min(low[low > floor], default=1.0)) / 2, floor + LEAST_GAP)

    if not len(bins) or not bins["toxic"].sum() or not bins["clean"].sum():
        return model if model.threshold > floor else model._replace(threshold=(1 + floor) / 2)
    enough = (r for r in bins.groupby("lang") if r[0] and min(r[1]["toxic"].sum(), r[1]["clean"].sum()) >= LEAST_LANGUAGE)
    return model._replace(thresholds={str(name): best(rows) for name, rows in enough}, threshold=best(bins))


def held_out(key: Column) -> Column:
    """Whether a document is never learnt from: crc32 of the id's text is a multiple of 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


_PIECES = "piece long, text string, lang string, label double, left boolean, seen binary, documents binary"


def _pieces(rows: DataFrame, kinds_left: tuple[bool, ...] = (False,)) -> DataFrame:
    """Rows of ``part, text, lang, label, left`` in order as documents in pieces.

    Behind each piece a row for each of ``kinds_left`` with ``seen`` and ``documents``: slots, and in how many
    documents with that ``left``.
    """
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in _PIECES.split(", "))])

    def batch(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def counted(piece: int, counts: dict[bool, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for left, found in counts.items():
            seen = np.flatnonzero(found).astype(np.int32)
            yield batch([piece], [None], [None], [None], [left], [seen.tobytes()], [found[seen].tobytes()])
            found[:] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, size = None, 0, 0
        counts = {left: np.zeros(SLOTS, np.int32) for left in kinds_left}
        for chunk in chunks(batches):
            slots, before = features(chunk.column(1))
            slots = slots.astype(np.int32)
            parts, left, pieces = chunk.column(0).to_pylist(), chunk.column(4).to_pylist(), []
            bounds = list(zip(before.tolist(), before[1:].tolist()))
            for (a, b), own, out in zip(bounds, parts, left):
                full = own == part and size + b - a > PIECE_WORDS
                if full or part not in (None, own):
                    yield from counted(piece, counts)
                    size = 0
                piece = piece + full if own == part else own << 32
                part, size = own, size + b - a
                if out in counts:
                    counts[out][np.unique(slots[a:b])] += 1
                pieces.append(piece)
            none = [None] * len(pieces)
            yield batch(pieces, chunk.column(1), chunk.column(2), chunk.column(3), chunk.column(4), none, none)
        if part is not None:
            yield from counted(piece, counts)

    return rows.mapInArrow(run, _PIECES)


def _keys(pieces: DataFrame) -> np.ndarray:
    """The slots seen in two documents or more of those that were counted."""
    rows = pieces.filter("seen IS NOT NULL").select("seen", "documents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seen, documents in zip(*(c.to_pylist() for c in batch.columns)):
                arrays = [pa.array(np.frombuffer(x, np.int32)) for x in (seen, documents)]
                yield pa.RecordBatch.from_arrays(arrays, ["slot", "documents"])

    counts = rows.mapInArrow(run, "slot int, documents int").groupBy("slot").agg(F.sum("documents").alias("documents"))
    # At most SLOTS rows.
    return np.sort(counts.filter("documents >= 2").select("slot").toArrow().column(0).to_numpy().astype(np.uint64))


def _by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], list[float]]]:
    """Slots and labels of the documents of each piece, from ``piece, text, label``.

    The texts are read again in each round, as they are smaller than their slots.
    """

    def documents() -> Iterator[tuple]:
        for chunk in chunks(batches):
            slots, before = features(chunk.column(1))
            slots = slots.astype(np.int32)
            for n, (piece, label) in enumerate(zip(chunk.column(0).to_pylist(), chunk.column(2).to_pylist())):
                yield piece, slots[before[n] : before[n + 1]], label

    for piece, rows in groupby(documents(), lambda r: r[0]):
        _, slots, labels = zip(*rows)
        yield piece, slots, labels


_CHANGES = "piece long, block int, rows binary, change binary, weight binary"


def _change(piece: int, block: int, rows: np.ndarray, change: np.ndarray, weight: np.ndarray) -> tuple:
    """A row of changes: places within the block, what changed there times the weight, and the weight."""
    return piece, block, rows.astype(np.int32).tobytes(), change.astype(np.float32).tobytes(), weight.astype(np.float32).tobytes()


def _added(block: int, size: int, changes) -> tuple[np.ndarray, np.ndarray]:
    """Changes and weights of all places of a block, added up."""
    total, weights = np.zeros((size, 1 if block < 0 else SIZE + 1)), np.zeros(size)
    for rows, change, weight in changes:
        at = np.frombuffer(rows, np.int32)
        total[at] += np.frombuffer(change, np.float32).reshape(len(at), -1)
        weights[at] += np.frombuffer(weight, np.float32)
    return total, weights


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block as one, added up in the order of the pieces."""
    pdf = pdf.sort_values("piece")
    piece, block = int(pdf["piece"].iloc[0]), int(pdf["block"].iloc[0])
    size = max(int(np.frombuffer(r, np.int32).max()) for r in pdf["rows"]) + 1
    total, weights = _added(block, size, zip(pdf["rows"], pdf["change"], pdf["weight"]))
    rows = np.flatnonzero(weights)
    return pd.DataFrame([_change(piece, block, rows, total[rows], weights[rows])], columns=["piece", "block", "rows", "change", "weight"])


def _changed(piece: int, state: _State, begun: _State, weight: float) -> Iterator[tuple]:
    """What learning changed: block -1 is all that is dense, by the number of documents, others are embeddings that moved."""
    dense = np.concatenate([(x - y).ravel() for x, y in zip(state.dense(), begun.dense())])
    yield _change(piece, -1, np.arange(len(dense)), dense * weight, np.full(len(dense), weight))
    moved = np.flatnonzero(state.table[:, SIZE] > begun.table[:, SIZE])
    for block in np.unique(moved // BLOCK).tolist():
        rows = moved[moved // BLOCK == block]
        yield _change(piece, block, rows - block * BLOCK, state.table[rows] - begun.table[rows], np.ones(len(rows)))


def _averaged(pieces: DataFrame, state: _State, keys: np.ndarray, share: float, passes: int, turn: int, parts: int) -> _State:
    """One round: every piece learns from the same state, to which the mean of the changes is added."""
    # The state before the first round is drawn in the tasks.
    sent = pieces.sparkSession.sparkContext.broadcast((keys, tuple(state) if turn else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, begun = sent.value
        row_of, begun = _row_of(keys), _State(*begun) if begun else _begun(keys, np.random.default_rng(SEED))
        for piece, texts, labels in _by_piece(batches):
            before = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            slots = np.concatenate(texts)
            state, draw = begun.copy(), np.random.default_rng([SEED, turn, piece])
            _learn(state, row_of, slots, before, np.arange(len(labels)), np.array(labels), share, passes, draw)
            for row in _changed(piece, state, begun, float(len(labels))):
                types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                names = ["piece", "block", "rows", "change", "weight"]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    changes = pieces.filter("label IS NOT NULL").select("piece", "text", "label").mapInArrow(run, _CHANGES)
    # At most 64 parts meet in one task, then the sums of 64 of these, until a block is one row.
    places = 32
    while places == 32 or parts > 1:
        places, parts = places + 6, -(-parts // 64)
        changes = changes.groupBy("block", F.shiftright("piece", places)).applyInPandas(_summed, _CHANGES)
    for row in fetched(changes):
        block, begin = row["block"], max(row["block"], 0) * BLOCK
        part = state.table[begin : begin + BLOCK]
        size = sum(x.size for x in state.dense()) if block < 0 else len(part)
        total, weights = _added(block, size, [(row["rows"], row["change"], row["weight"])])
        mean = total / np.maximum(weights, 1)[:, None]
        if block >= 0:
            part += mean.astype(np.float32)
            continue
        at = 0
        for x in state.dense():
            x += mean[at : at + x.size, 0].reshape(x.shape).astype(np.float32)
            at += x.size
    sent.destroy()
    return state


def _counted(pieces: DataFrame, model: Model) -> pd.DataFrame:
    """``lang, bin, low, high, toxic, clean``: scores of documents left out of the model's fit, counted."""
    sent = pieces.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for chunk in chunks(batches):
            got = pa.array(scores(model, chunk.column(0)), pa.float64())
            yield pa.RecordBatch.from_arrays([chunk.column(1), got, chunk.column(2)], ["lang", "score", "label"])

    rows = pieces.filter("label IS NOT NULL").select("text", F.coalesce("lang", F.lit("")).alias("lang"), "label")
    rows = rows.mapInArrow(run, "lang string, score double, label double")
    counted = rows.groupBy("lang", F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.min("score").alias("low"), F.max("score").alias("high"),
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"),
    )
    out = counted.toArrow().to_pandas()  # at most BINS + 1 rows for each language
    sent.destroy()
    return out


def _fitted(pieces: DataFrame, parts: int) -> Model | None:
    """The model without thresholds, of all documents in the pieces; none if they are not of both kinds."""
    every = pieces.filter("label IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"), F.min("piece").alias("first"), F.max("piece").alias("last")
    ).first()
    share = _share(every["toxic"], every["n"])
    if share in (0.0, 1.0):
        return None
    keys = _keys(pieces)
    state = _begun(keys, np.random.default_rng(SEED))
    rounds = ROUNDS if every["first"] < every["last"] else 1
    passes = -(-_passes(every["n"], ROUNDS * PASSES) // rounds)
    for turn in range(rounds):
        state = _averaged(pieces, state, keys, share, passes, turn, parts)
    return state.model(keys)


def _share(toxic: float | None, documents: int) -> float:
    return float(np.clip((toxic or 0.0) / (documents or 1), 0, 1))


def train(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", sample=None, crossed: bool = False
) -> Model:
    """The model with thresholds, of all labelled documents that are not held out.

    A fifth of them calibrates the thresholds, the model is learnt from the others. If ``crossed`` none is left out of
    either: the model is learnt from all, and thresholds come from the scores of all. Each half of the documents
    is scored for that by a model of the other half.

    With ``sample`` a caller who wants a quick model takes only so many of them that are toxic, and so many that are not.
    """
    spark = documents.sparkSession
    usable = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    usable = usable.groupBy(F.col(key).cast(documents.schema[key].dataType).alias("id")).agg(F.max(label).alias("label"))
    if sample is not None:
        parts = [usable.filter(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in zip((1, 0), sample)]
        usable = parts[0].union(parts[1])
    usable = kept(usable, "labels")
    parts = -(-usable.count() // PIECE)
    if not parts:
        return _one_sided(0.0)
    bits = spark.sparkContext.broadcast(bit_filter(usable, "id"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(bits.value, batch.column(3).to_numpy(zero_copy_only=False))))

    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")
    # Only documents that may have a label leave their task. They and the labels meet in one shuffle, in which
    # a part stays together.
    rows = bounded(documents).select(
        F.col(key).alias("id"), F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"), filter_place(F.col(key)).alias("place")
    )
    rows = rows.mapInArrow(likely, rows.schema).select("id", "text", "lang", F.lit(None).cast("double").alias("label"))
    said = usable.select("id", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), F.col("label").cast("double"))
    rows = rows.unionByName(said).filter("id IS NOT NULL").withColumns(
        {"mark": F.xxhash64("id"), "part": F.pmod(F.xxhash64("id", F.lit(PIECE)), F.lit(parts))}
    )
    same = Window.partitionBy("part", "mark", "id").orderBy("text", "lang").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.repartition("part").withColumn("label", F.max("label").over(same)).filter("text IS NOT NULL AND label IS NOT NULL")
    rows = rows.select("part", "text", "lang", "label", (F.pmod("mark", F.lit(2 if crossed else LEFT_OUT)) == 0).alias("left"))
    pieces = kept(_pieces(rows, (False, True) if crossed else (False,)), "pieces")
    bits.destroy()
    try:
        return _trained(pieces, parts, crossed)
    finally:
        dropped(usable, pieces)


def _trained(pieces: DataFrame, parts: int, crossed: bool) -> Model:
    """The model with thresholds, from labelled documents in pieces."""
    fit = pieces if crossed else pieces.filter("NOT left")
    model = _fitted(fit, parts)
    if model is None:
        found = fit.agg(F.sum("label").alias("toxic"), F.count("label").alias("n")).first()
        return _one_sided(_share(found["toxic"], found["n"]))
    left = pieces.filter("left")
    if not crossed:
        return _calibrated(model, _counted(left, model))
    rest = pieces.filter("NOT left")
    halves = [(left, _fitted(rest, parts)), (rest, _fitted(left, parts))]
    bins = [_counted(scored, half) for scored, half in halves if half is not None]
    # What a text without any known word scores is no ground to flag it.
    return _calibrated(model, pd.concat(bins) if bins else pd.DataFrame(), float(scores(model, pa.array([""]))[0]))


_OUT = {"__score": pa.float64(), "__threshold": pa.float64()}


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """Adds ``score``, the ``threshold`` of the row's language, and ``toxic``: whether it is reached."""
    sent = documents.sparkSession.sparkContext.broadcast(tuple(model))
    names = bounded(documents).columns
    lang = names.index("lang") if "lang" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for chunk in chunks(batches):
            got = scores(model, chunk.column(names.index("text")))
            said = chunk.column(lang).to_pylist() if lang is not None else [None] * len(got)
            limits = np.array([model.thresholds.get(x, model.threshold) for x in said])
            arrays = [*chunk.columns, pa.array(got), pa.array(limits)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *_OUT])

    rows = documents.withColumns({c: F.lit(None).cast("double") for c in _OUT})
    out = documents.mapInArrow(run, rows.schema)
    score, limit = F.col("__score"), F.col("__threshold")
    return out.withColumns({"score": score, "threshold": limit, "toxic": score >= limit}).drop(*_OUT)


def clean_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents below the threshold of their language, with their columns as they were."""
    known = [F.col(c) for c in ("text", "lang") if c in documents.columns]
    rest = F.struct(*(f"`{c}`" for c in documents.columns if c not in ("text", "lang")))
    clean = score_documents(documents.select(*known, rest.alias("__rest")), model).filter(~F.col("toxic"))
    return clean.select(*(c if c in ("text", "lang") else f"__rest.`{c}`" for c in documents.columns))
