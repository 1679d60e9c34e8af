import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartlane.llm import registry, toxicity

from .test_jaccard import edited_copies, near_copies, plain_set, roots


@pytest.fixture(scope="module")
def folder(spark, documents, hard, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    ten = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    clean = [(100 + i, f"document number {i} speaks about the weather in town {i * 7} and nothing else at all {i}") for i in range(20)]
    rows = [(200, "you vilxen fool number 99 of many"), (201, f"here is {ten} again"), (202, clean[0][1]), (203, clean[0][1].upper())]
    rows += [(300 + i, f"own words {i} of it\nthis very line stands in all of these documents") for i in range(4)]
    documents(clean + rows).union(hard).write.parquet(f"{path}/documents.parquet")
    toxic = [(1000 + i, f"you vilxen fool number {i} of many") for i in range(30)]
    fine = [(2000 + i, f"you are a good friend {i} and so on") for i in range(30)]
    documents(toxic + fine).write.mode("append").parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 1) for i, _ in toxic] + [(i, 1, 0) for i, _ in fine + clean]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ten)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_takes_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        left[name] = {r["doc_id"]: r for r in docs.collect()}
    assert not set(left["toxicity"]) & {200, *range(1000, 1030)}
    assert {*range(100, 120), *range(2000, 2030)} <= set(left["toxicity"])
    lines = left["line dedup"]
    assert "this very line" in lines[303]["text"] and "this very line" not in lines[300]["text"]
    assert lines[300]["n_chars"] == len(lines[300]["text"])
    # Three copies of one line: the one with the largest id has it.
    assert [bool(lines[i]["text"]) for i in (100, 202, 203)] == [False, False, True]
    near = left["n-gram Jaccard join"]
    assert 4 in near and 5 not in near and 101 in near
    assert 201 in near and 201 not in left["benchmark decontamination"]
    final = left["byte-level BPE"]
    assert set(final) == set(left["benchmark decontamination"]) and final[1]["n_tokens"] == 0 < final[101]["n_tokens"]
    whole = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in whole.collect()} == set(final)



def test_no_label_is_left_out_of_the_model_or_the_thresholds(spark, documents, tmp_path, monkeypatch):
    """A word that only the fifth of the toxic documents says that once calibrated; few labels in German."""
    ids = spark.range(1500).filter(~toxicity.held_out(F.col("id"))).withColumn("fifth", F.pmod(F.xxhash64("id"), F.lit(5)) == 0)
    rows, labels = [], []
    for n, r in enumerate(ids.orderBy("id").collect()):
        word = ("zorblag" if r["fifth"] else "vilxen") if n % 2 else "fine"
        rows.append((r["id"], f"what a {word} day number {r['id']} is", "de" if n < 40 else "en"))
        labels.append((r["id"], 1, n % 2))
    news = [(5000, "what a zorblag day it is"), (5001, "what a vilxen day it is"), (5002, "what a fine day it is")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    models, clean = [], toxicity.clean_documents
    monkeypatch.setattr(toxicity, "clean_documents", lambda docs, model: models.append(model) or clean(docs, model))
    left = corpus_pipeline.drop_toxic(spark, documents(rows + news), str(tmp_path))
    toxic = {i for i, _, y in labels if y}
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in rows + news} - toxic - {5000, 5001}
    assert set(models[0].thresholds) == {"de", "en"}


def test_registered():
    names = [n.split("_")[0] for n in registry.QUERIES if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in registry.QUERIES and set(registry.ORACLES) <= set(registry.QUERIES)


def similar_rows(seed):
    """Copies with words appended and with scattered edits, beside the groups of the join's own tests."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    texts = [t for _, t in near_copies(seed) + edited_copies(seed)]
    for added in (20, 30, 45, 49, 50, 60):
        base = [word() for _ in range(200)]
        texts += [" ".join(base), " ".join(base + [word() for _ in range(added)])]
    for edits in (4, 8, 10, 11, 12, 16):
        base = [word() for _ in range(500)]
        copy = list(base)
        for i in range(edits):
            copy[20 + i * 500 // edits] = word()
        texts += [" ".join(base), " ".join(copy)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [11, 12])
def test_near_copies_share_four_fifths_of_five_words(spark, documents, seed):
    rows = similar_rows(seed)
    sets = {i: plain_set(t, 5) for i, t in rows}
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] and sets[b]}
    assert sum(0.8 <= s < 0.9 for s in share.values()) > 10
    want = roots(sets, [(a, b) for a, b in share if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    left = corpus_pipeline.drop_near_copies(spark, documents(rows), "")
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))


def test_empty_tables(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
