"""Quality classifier: an interpolated modified Kneser-Ney model of characters.

The model is trained on the trusted documents: n-grams of ``ORDER`` characters are counted with
partial sums in each task, lower orders are counted by distinct characters to their left, and
joins of the count tables on contexts and suffixes make one table of interpolated probabilities
and one of backoff weights. The two are sharded by n-gram, and again by the two characters before the
predicted one into parts of bounded size. A document's perplexity needs each of its n-grams'
probability: every task joins its characters to one part after the other, without a shuffle. There is
one way for models of all sizes.

A document is kept if its perplexity is not above its language's threshold: a quantile of those of
trusted documents that are left out of the model, so that the threshold is one for unseen texts.

Defined results: null and empty texts are predicted as one end mark; rows without language, or of
one with few trusted documents left out, take the threshold of all; without trusted documents to learn
from all is kept and perplexities are null, without any left out all is kept; repeated rows have
equal results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.llm.shared import bit_filter, bounded, filter_place, in_filter, kept
from cartlane.llm.texts import CHUNK_BYTES, chunks, mixed

#: Characters in an n-gram.
ORDER = 5

#: One in so many trusted documents is left out of the model, to take the thresholds from.
LEFT_OUT = 5

#: Share of those below the threshold of their language, and how many a language needs for one of its own.
QUANTILE, LEAST_LANGUAGE = 0.98, 30

#: Bytes of the model that a task holds at once, at about 40 for an entry.
MODEL_BYTES, ENTRY_BYTES = 64 << 20, 40

#: Bytes of text that are scored with one part of a model of several before the next is loaded.
SCORE_BYTES = 16 << 20

#: Trusted ids that are sent to every task at most, at about 20 bytes each.
SENT_IDS = 1_000_000

#: Bytes of text whose n-grams are counted together before they leave a task.
COUNT_BYTES = 3 << 20

_BEGIN, _END = "\x02", "\x03"
_BASE = 0x9E3779B97F4A7C15


def _code_points(texts: list[str], order: int) -> tuple[str, np.ndarray, np.ndarray]:
    """Padded texts as one, their code points, and the places that are predicted."""
    padded = [_BEGIN * (order - 1) + t + _END for t in texts]
    whole = "".join(padded)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) for p in padded])
    predicted = np.ones(len(points), bool)
    begins = ends - np.array([len(p) for p in padded])
    for k in range(order - 1):
        predicted[begins + k] = False
    return whole, points, predicted


def gram_hashes(points: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each length up to ``order``, the hash of the n-gram that ends at each place."""
    total, power = np.zeros(len(points), np.uint64), 1
    for k in range(order):
        if k:
            total[k:] += (points[:-k] + np.uint64(1)) * np.uint64(power)
        else:
            total += points + np.uint64(1)
        power = power * _BASE % 2**64
        yield mixed(total + np.uint64(k + 1 << 48))


def _longest(points: np.ndarray, order: int) -> np.ndarray:
    for hashes in gram_hashes(points, order):
        last = hashes
    return last


def _string_hashes(grams: list[str], size: int) -> np.ndarray:
    if not grams:
        return np.zeros(0, np.uint64)
    points = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return _longest(points, size)[size - 1 :: size]


class Table:
    """Numbers by 64-bit hash, looked up by arrays: linear probing in a quarter-full table."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(hashes)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys = np.zeros(1 << bits, np.uint64)
        self._values = np.full(1 << bits, np.nan, np.float32)
        open_ = np.arange(len(hashes))
        at = (hashes >> self._shift).astype(np.int64)
        while len(open_):
            free = np.isnan(self._values[at[open_]])
            places, first = np.unique(at[open_[free]], return_index=True)
            placed = open_[free][first]
            self._keys[places], self._values[places] = hashes[placed], values[placed]
            open_ = np.setdiff1d(open_, placed, assume_unique=True)
            taken = ~np.isnan(self._values[at[open_]])
            at[open_[taken]] = (at[open_[taken]] + 1) & self._mask

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers, not a number where there is none."""
        at = (hashes >> self._shift).astype(np.int64)
        found = self._values[at]
        wrong = np.flatnonzero((self._keys[at] != hashes) & ~np.isnan(found))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self._mask
            now = self._values[at[wrong]]
            found[wrong] = now
            wrong = wrong[(self._keys[at[wrong]] != hashes[wrong]) & ~np.isnan(now)]
        return found


def count_grams(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n`` over all documents; what a task has seen is summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=COUNT_BYTES):
            whole, points, predicted = _code_points(chunk.column(0).to_pylist(), order)
            hashes = _longest(points, order)
            places = np.flatnonzero(predicted)
            _, first, counts = np.unique(hashes[places], return_index=True, return_counts=True)
            grams = [whole[i - order + 1 : i + 1] for i in places[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["gram", "n"])

    counted = documents.select("text").mapInArrow(run, "gram string, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """What n-grams seen once, twice, and more often lose: from the counts of counts."""
    few = counts.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("grams")).collect()
    n = {r["n"]: r["grams"] for r in few}
    if not n.get(1):
        return 0.5, 0.5, 0.5
    y = n[1] / (n[1] + 2 * n.get(2, 0))
    raw = [k - (k + 1) * y * n.get(k + 1, 0) / n[k] if n.get(k) else 0.5 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw))


class Model:
    """``probabilities``: by length, ``gram, logp``. ``backoff``: by length, ``context, logg``."""

    def __init__(self, probabilities: list[DataFrame], backoff: list[DataFrame], unseen: float):
        self.probabilities, self.backoff, self.unseen = probabilities, backoff, unseen

    @property
    def order(self) -> int:
        return len(self.probabilities)

    def entries(self) -> int:
        return sum(t.count() for t in (*self.probabilities, *self.backoff))


def _taken(n: Column, discounts: tuple[float, float, float]) -> Column:
    return F.when(n == 1, discounts[0]).when(n == 2, discounts[1]).otherwise(discounts[2])


def train(trusted: DataFrame, order: int = ORDER) -> Model | None:
    """The model of the texts; none without any. Joins of count tables, from short to long."""
    counts = [kept(count_grams(trusted, order), "grams")]
    for k in range(order - 1, 0, -1):
        shorter = counts[0].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counts.insert(0, kept(shorter, "grams"))
    letters = counts[0].count()
    if not letters:
        return None
    probabilities: list[DataFrame] = []
    backoff: list[DataFrame] = []
    lower = None
    unseen = 0.0
    for k, table in enumerate(counts, 1):
        discounts = _discounts(table)
        marked = table.withColumn("context", F.substring("gram", 1, k - 1))
        taken = _taken(F.col("n"), discounts)
        contexts = marked.groupBy("context").agg(F.sum("n").alias("total"), F.sum(taken).alias("left"))
        # n is above its discount by construction, so no probability is below its interpolated part.
        share = F.greatest(F.col("n") - taken, F.lit(0.0)) / F.col("total")
        weight = F.col("left") / F.col("total")
        joined = marked.join(contexts, "context")
        if lower is None:
            first = contexts.select((weight / (letters + 1)).alias("p")).first()["p"]
            unseen = math.log(first)
            table_k = joined.select("gram", (share + weight / (letters + 1)).alias("p"))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            with_suffix = joined.withColumn("suffix", F.substring("gram", 2, k - 1)).join(below, "suffix")
            table_k = with_suffix.select("gram", (share + weight * F.col("q")).alias("p"))
        lower = kept(table_k, "probabilities")
        probabilities.append(lower.select("gram", F.log("p").alias("logp")))
        backoff.append(kept(contexts.select("context", F.log(weight).alias("logg")), "backoff"))
    return Model(probabilities, backoff, unseen)


def _hashed(table: DataFrame, gram: str, value: str, size: int, last: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and numbers of the n-grams of ``size`` characters of one part of the model.

    N-grams are dealt to parts by the two characters that end at ``last``, shorter ones are in all.
    Tasks hash them: the driver gets 12 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_pylist()
            hashes, values = _string_hashes(grams, size), batch.column(1)
            if last >= 2 and parts > 1:
                mine = _string_hashes([g[last - 2 : last] for g in grams], 2) % np.uint64(parts) == part
                hashes, values = hashes[mine], values.filter(pa.array(mine))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), values], ["hash", "value"])

    found = table.select(gram, F.col(value).cast("float").alias("value")).mapInArrow(run, "hash long, value float").toArrow()
    return found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy()


def _tables(model: Model, part: int, parts: int) -> list[tuple]:
    """One part of the model as arrays: what is needed behind contexts that end with some pairs of characters."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
    return [
        (
            *_hashed(p, "gram", "logp", k, k - 1, part, parts),
            *(_hashed(b, "context", "logg", k - 1, k - 1, part, parts) if k > 1 else none),
        )
        for k, (p, b) in enumerate(zip(model.probabilities, model.backoff), 1)
    ]


def _log_probabilities(hashes: list[np.ndarray], places: np.ndarray, tables: list[tuple[Table, Table]], unseen: float) -> np.ndarray:
    total = np.zeros(len(places), np.float64)
    open_ = np.arange(len(places))
    for k in range(len(tables), 0, -1):
        probabilities, backoff = tables[k - 1]
        found = probabilities.get(hashes[k - 1][places[open_]])
        hit = ~np.isnan(found)
        total[open_[hit]] += found[hit]
        open_ = open_[~hit]
        if k > 1:
            weight = backoff.get(hashes[k - 2][places[open_] - 1])
            total[open_] += np.where(np.isnan(weight), 0, weight)
    total[open_] += unseen
    return total


def perplexities(documents: DataFrame, model: Model, columns: list[str], model_bytes: int = MODEL_BYTES) -> DataFrame:
    """``columns`` of every document, ``n_chars_scored`` and ``perplexity``.

    The model is sent in parts of about ``model_bytes``, as many as it needs. A task takes documents of
    ``SCORE_BYTES`` and looks up each of their characters in the part for the two before it, one part after
    the other. No n-gram of a document is shuffled.
    """
    rows = documents.select(*columns, "text")
    parts = max(1, -(-model.entries() * ENTRY_BYTES // max(1, model_bytes)))
    context = documents.sparkSession.sparkContext
    sent = [context.broadcast(_tables(model, part, parts)) for part in range(parts)]
    order, unseen = model.order, model.unseen
    schema = documents.select(*columns).withColumns({"n_chars_scored": F.lit(0).cast("long"), "perplexity": F.lit(0.0)}).schema

    def load(part: int) -> list[tuple[Table, Table]]:
        return [(Table(h, v), Table(c, g)) for h, v, c, g in sent[part].value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = load(0) if parts == 1 else None
        for chunk in chunks(batches, limit=CHUNK_BYTES if single else SCORE_BYTES):
            texts = chunk.column(len(columns)).to_pylist()
            _, points, predicted = _code_points(texts, order)
            places = np.flatnonzero(predicted)
            hashes = list(gram_hashes(points, order))
            logs = np.zeros(len(places))
            for part in range(parts):
                mine = np.flatnonzero(hashes[1][places - 1] % np.uint64(parts) == part) if parts > 1 else slice(None)
                logs[mine] = _log_probabilities(hashes, places[mine], single or load(part), unseen)
            sizes = np.array([len(t) + 1 for t in texts])
            sums = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
            arrays = [chunk.column(i) for i in range(len(columns))]
            arrays += [pa.array(sizes, pa.int64()), pa.array(np.exp(-sums / sizes))]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_chars_scored", "perplexity"])

    return rows.mapInArrow(run, schema)


def trusted_ids(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """``id`` of documents whose every label says good."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(key).alias("id")).agg(F.min(label).alias("good")).filter("good = 1").select("id")


def only_trusted(documents: DataFrame, ids: DataFrame, key: str = "doc_id", sent: int = SENT_IDS) -> DataFrame:
    """The trusted documents.

    Up to ``sent`` ids go to the tasks, and no text is shuffled. More of them meet the documents in a
    shuffle, from which a filter of fixed size keeps most other texts out.
    """
    if ids.count() <= sent:
        return documents.select(F.col(key).alias("id"), "text").join(F.broadcast(ids), "id", "left_semi")
    bits = documents.sparkSession.sparkContext.broadcast(bit_filter(ids, "id"))
    rows = documents.select(F.col(key).alias("id"), "text", filter_place(F.col(key)).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(bits.value, batch.column(2).to_numpy(zero_copy_only=False))))

    return rows.mapInArrow(run, rows.schema).drop("place").join(ids, "id", "left_semi")


def _left_out(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LEFT_OUT)) == 0


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", model_bytes: int = MODEL_BYTES) -> DataFrame:
    """``n_chars_scored``, ``perplexity``, the ``threshold`` of the language and ``keep`` of every document."""
    documents = bounded(documents)
    ids = kept(trusted_ids(labels, key), "trusted")
    learned = ids.filter(~_left_out(F.col("id")))
    model = train(only_trusted(documents, learned, key))
    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")
    rows = documents.select(F.col(key).alias("__id"), lang.alias("__lang"), "text")
    if model is None:
        none = F.lit(None).cast("double")
        out = rows.withColumn("n_chars_scored", (F.length(F.coalesce("text", F.lit(""))) + 1).cast("long"))
        out = out.withColumns({"perplexity": none, "threshold": none, "keep": F.lit(True)})
        return out.select(F.col("__id").alias(key), "n_chars_scored", "perplexity", "threshold", "keep")
    scored = kept(perplexities(rows, model, ["__id", "__lang"], model_bytes), "perplexities")
    good = scored.join(ids.filter(_left_out(F.col("id"))), scored["__id"] == ids["id"], "left_semi")
    quantile = F.percentile_approx("perplexity", QUANTILE, 10_000)
    by_language = good.groupBy(F.col("__lang").alias("lang")).agg(quantile.alias("own"), F.count(F.lit(1)).alias("n"))
    by_language = by_language.filter(F.col("lang").isNotNull() & (F.col("n") >= LEAST_LANGUAGE)).drop("n")
    of_all = good.agg(quantile.alias("of_all")).first()["of_all"]
    threshold = F.coalesce("own", F.lit(of_all).cast("double"))
    return (
        scored.join(by_language, scored["__lang"] == by_language["lang"], "left")
        .withColumn("threshold", threshold)
        .select(
            F.col("__id").alias(key),
            "n_chars_scored",
            "perplexity",
            "threshold",
            F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"),
        )
    )
