import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from cartlane.functions.text import base_slug
from cartlane.operators.slugs import unique_slugs
from cartlane.plans import ordered
from cartlane.plans.ordered import RANGE, ranged
from tests.conftest import rows


def one_by_one(names, existing):
    """The rule applied row by row."""
    used, slugs = set(existing), []
    for name in names:
        base = re.sub(r"\W+", "-", name.lower())
        slug, n = base, 0
        while slug in used:
            n += 1
            slug = f"{base}-{n}"
        used.add(slug)
        slugs.append(slug)
    return slugs


def check(spark, names, existing=()):
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string").repartition(5)
    old = spark.createDataFrame([(s,) for s in existing], "slug string") if existing else None
    got = [r["slug"] for r in unique_slugs(df, "name", "id", old).orderBy("id").collect()]
    assert got == one_by_one(names, existing)


def test_plain_suffixes(spark):
    check(spark, ["Lamp", "lamp", "Red  Chair", "LAMP", "red chair", "sofa"])


def test_letters_of_any_script_stay(spark):
    check(spark, ["Café", "café", "Straße 9", "東京 店"])


def test_existing_slugs_with_gaps(spark):
    check(spark, ["lamp"] * 6 + ["sofa", "desk"], ["lamp", "lamp-2", "lamp-3", "lamp-5", "sofa-1", "other", "desk"])


def test_existing_without_the_bare_slug(spark):
    check(spark, ["lamp"] * 3, ["lamp-1"])


def test_large_base_with_existing(spark):
    names = ["lamp" if i % 4 else f"name {i % 7}x" for i in range(160)]
    check(spark, names, ["lamp"] + [f"lamp-{n}" for n in range(3, 90, 4)])


def test_marks_of_a_run_of_taken_slugs_are_one(spark, monkeypatch):
    """What the rule itself leaves: no task gets more than twice its share."""
    seen = []

    def spied(df, group, order):
        cut = ranged(df, group, order)
        seen.append([r["count"] for r in cut.groupBy(RANGE).count().collect()])
        return cut

    monkeypatch.setattr(ordered, "ranged", spied)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.range(2000).select("id", F.lit("Lamp").alias("name"))
        old = spark.range(2000).select(F.concat(F.lit("lamp-"), F.col("id") + 1).alias("slug")).union(spark.sql("SELECT 'lamp'"))
        got = {r["slug"] for r in unique_slugs(df, "name", "id", old).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert got == {f"lamp-{n}" for n in range(2001, 4001)}
    assert len(seen) == 3 and all(max(sizes) < 2 * sum(sizes) / len(sizes) for sizes in seen)


def test_names_that_are_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "")], "id long, name string")
    old = spark.createDataFrame([(None,), ("x",)], "slug string")
    assert rows(unique_slugs(df, "name", "id", old), "id", "slug") == [(1, None), (2, "x-1"), (3, None), (4, "")]


def test_word_characters_are_those_of_the_rule(spark):
    """Every code point that both sides know, between two letters."""
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    df = spark.createDataFrame([(c, f"x{chr(c)}y") for c in points], "c int, name string")
    known = spark._jvm.java.lang.Character
    wrong = []
    for r in df.select("c", "name", base_slug(F.col("name")).alias("slug")).collect():
        if r["slug"] != re.sub(r"\W+", "-", r["name"].lower()) and known.getType(r["c"]) != 0:
            wrong.append(hex(r["c"]))
    assert wrong == []
    names = ["हिन्दी", "ไทยที่", "cafe\u0301 x", "a‿b", "²x"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(base_slug(F.col("n"))).collect()]
    assert got == [re.sub(r"\W+", "-", n) for n in names]


def mixed(*scenarios):
    """Scenarios side by side, each under a letter of its own, their rows interleaved."""
    lists = [[f"{chr(97 + i)}{name}" for name in names] for i, names in enumerate(scenarios)]
    return [names[k] for k in range(max(map(len, lists))) for names in lists if k < len(names)]


def test_a_base_that_reads_like_a_numbered_slug(spark):
    names = mixed(
        ["foo", "foo", "foo 1"],
        ["foo 1", "foo", "foo", "foo"],
        ["foo", "foo 2", "foo", "foo", "foo 2", "foo-1"],
        ["foo 01", "foo", "foo", "foo 0", "foo"],
        ["a", "a", "a 1", "a 1", "a 1 1", "a 1 1", "a", "a 1 1 1", "a 2", "a"],
    )
    check(spark, names, ["ea-1-2"])


@pytest.mark.parametrize("seed", [1_000_000, 5])
def test_random_collisions(spark, seed):
    rng = random.Random(seed)
    pool = ["a"] * 6 + [f"a {n}" for n in range(1, 7)] + [f"a 1 {n}" for n in range(1, 4)] + ["a 1"] * 3 + ["b", "b 1"]
    names = mixed(*[[rng.choice(pool) for _ in range(rng.randint(10, 30))] for _ in range(4)])
    existing = {f"{chr(97 + i)}a-{rng.randint(1, 9)}" for i in range(4) for _ in range(rng.randint(0, 3))}
    check(spark, names, sorted(existing | {"ab", "ba", "cb-1"}))


def test_carries_the_columns(spark):
    df = spark.createDataFrame([(1, "x", 9), (2, "x", 8)], "id long, name string, extra int")
    assert rows(unique_slugs(df, "name", "id"), "id", "name", "extra", "slug") == [(1, "x", 9, "x"), (2, "x", 8, "x-1")]
