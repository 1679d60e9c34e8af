import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartlane.llm import toxicity
from cartlane.plans.scratch import _application_folder, children


def area(scores, labels):
    ranks = np.empty(len(scores))
    ranks[np.argsort(scores)] = np.arange(1, len(scores) + 1)
    toxic = labels == 1
    return (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(documents, labels, sample=(400, 800))
    held = documents.join(labels.filter(toxicity.held_out(F.col("doc_id"))), "doc_id").select("doc_id", "text", "lang", F.col("toxic").alias("y"))
    rows = toxicity.score_documents(held, model).collect()
    got, want = np.array([r["score"] for r in rows]), np.array([r["y"] for r in rows])
    assert area(got, want) > 0.95
    flagged = np.array([r["toxic"] for r in rows])
    assert flagged[want == 1].mean() > 0.85 and flagged[want == 0].mean() < 0.02
    assert {"en"} < set(model.thresholds) <= {"en", "de", "fr", "es"}


def small_model():
    bad, good = ["you utter vilxen fool", "what a vilxor day it is"], ["a fine day it is", "you and I are here now"]
    texts = [t + f" {w}" for t in bad + good for w in ("one", "two", "three", "four", "five")] * 3
    return toxicity.fit(texts, np.array(([1.0] * 10 + [0.0] * 10) * 3), epochs=3)


def test_scores_do_not_depend_on_neighbours_or_columns(spark, documents, hard):
    model = small_model()
    texts = [r["text"] or "" for r in hard.collect()] + ["a VILXAN thing", "a fine thing"]
    together = toxicity.scores(model, pa.array(texts))
    alone = np.concatenate([toxicity.scores(model, pa.array([t])) for t in texts])
    assert np.allclose(together, alone, atol=1e-6)
    assert together[-2] > 0.5 > together[-1]  # a beginning that was learnt with other endings
    rows = hard.withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    left = toxicity.clean_documents(rows, model._replace(threshold=2.0))
    assert left.columns == rows.columns and left.count() == hard.count()
    assert {r["toxic"] for r in left.collect()} == {"clash"}
    assert toxicity.score_documents(hard.limit(0), model).collect() == []


def test_labels_that_say_nothing(spark, documents, hard):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(hard, none)
    assert toxicity.clean_documents(hard, model).count() == hard.count()
    odd = spark.createDataFrame([(4, 0), (4, 0), (6, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(hard, odd)
    assert {r["toxic"] for r in toxicity.score_documents(hard, model).collect()} == {False}


def test_held_out_rows_are_never_learnt(spark, documents):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = documents([(i, "vilxen") for i in ids])
    model = toxicity.train(rows, spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int"))
    assert len(model.keys) == 0
    flags = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("out")).filter("out")
    assert sorted(r["id"] for r in flags.collect()) == ids


def test_thresholds():
    scores, labels = np.array([0.1, 0.2, 0.8, 0.9]), np.array([0.0, 0.0, 1.0, 1.0])
    assert abs(toxicity.best_threshold(scores, labels) - 0.5) < 1e-9
    model = toxicity.calibrated(small_model(), np.tile(scores, 10), np.tile(labels, 10), ["en"] * 40)
    assert model.thresholds == {"en": model.threshold}


def test_scores_equal_a_plain_forward_pass():
    draw = np.random.default_rng(4)
    said = ["bad worse awful word", "fine good text here", "", "one", "two words"] * 20
    texts = [" ".join(draw.permutation(t.split())) for t in said]
    model = toxicity.fit(texts, np.array([float("bad" in t) for t in texts]), epochs=2)
    for text in ["bad worse", "good", "", "unheard of words and bad ones too", "x" * 50]:
        hashes, _ = toxicity.features(pa.array([text]))
        at = {int(k): i for i, k in enumerate(model.keys)}
        words = [sum(model.embeddings[at.get(int(h), len(at))] for h in row) for row in hashes]
        words += [np.zeros(toxicity.SIZE)] * max(toxicity.WIDTHS)  # the padding behind a text
        odds = model.bias
        for n, (filters, biases) in enumerate(zip(model.filters, model.biases)):
            width = len(filters)
            for f in range(toxicity.FILTERS):
                best = max(
                    sum(float(words[i + j] @ filters[j][:, f]) for j in range(width)) + biases[f] for i in range(len(words) - width + 1)
                )
                odds += max(best, 0) * model.weights[n * toxicity.FILTERS + f]
        assert toxicity.scores(model, pa.array([text]))[0] == pytest.approx(1 / (1 + np.exp(-odds)), rel=1e-4)


def test_every_label_is_learnt_from_in_many_pieces(spark, documents, monkeypatch):
    """A word of the last thousand toxic documents alone, of more than three thousand in all."""
    monkeypatch.setattr(toxicity, "PIECE", 2000, raising=False)
    ids = spark.range(9000).filter(~toxicity.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").collect()
    ids = [r["id"] for r in ids]
    toxic = ids[::2]
    text = {i: f"what a fine day number {i} is" for i in ids}
    text |= {i: f"what a {'vilxen' if n < 2000 else 'zorblag'} day number {i} is" for n, i in enumerate(toxic)}
    labels = spark.createDataFrame([(i, 1) for i in toxic] + [(i, 0) for i in ids[1::2]], "doc_id long, toxic int")
    rows = documents(list(text.items()))
    model = toxicity.train(rows, labels)
    vilxen, zorblag, fine = toxicity.scores(model, pa.array([f"what a {w} day it is" for w in ("vilxen", "zorblag", "fine")]))
    assert vilxen > 0.9 and zorblag > 0.9 and fine < 0.1 and 0.1 < model.threshold < 0.9
    again = toxicity.train(rows.repartition(3), labels.repartition(5))
    assert all(np.array_equal(x, y) for x, y in zip(model.filters, again.filters)) and np.array_equal(model.embeddings, again.embeddings)


def test_words_never_seen_are_no_ground_to_flag(spark, documents, hard):
    toxic = [(1000 + i, f"you vilxen fool number {i} of many") for i in range(30)]
    fine = [(2000 + i, f"you are a good friend {i} and so on") for i in range(50)]
    labels = spark.createDataFrame([(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in fine], "doc_id long, toxic int")
    model = toxicity.train(hard.union(documents(toxic + fine)), labels, crossed=True)
    assert {r["toxic"] for r in toxicity.score_documents(hard, model).collect()} == {False}
    assert all(r["toxic"] for r in toxicity.score_documents(documents(toxic), model).collect())


@pytest.mark.parametrize("crossed", [False, True])
def test_training_leaves_no_texts_behind(spark, documents, crossed):
    folder = _application_folder(spark)
    before = set(children(spark, folder))
    ids = range(200)
    rows = documents([(i, f"you are a {'vilxen' if i % 2 else 'good friend'} number {i}") for i in ids])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    model = toxicity.train(rows, labels, crossed=crossed)
    bad, fine = toxicity.scores(model, pa.array(["you are a vilxen", "you are a good friend"]))
    assert bad > 0.5 > fine
    assert set(children(spark, folder)) == before
