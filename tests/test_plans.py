import random
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartlane.functions.draws import draw, draw_chance, draw_choice, draw_decimal, draw_int
from cartlane.plans.assign import assign
from cartlane.plans.keys import next_id, with_surrogate_key
from cartlane.plans.ordered import RANGE, neighbour, numbered_in_group, ranged, running_total
from cartlane.plans.samples import baskets, distinct_up_to, sample_rows
from cartlane.plans import scratch
from cartlane.plans.scratch import drop_scratch, written
from cartlane.sources.sinks import batch_start, read_batches, read_children, write_batch, write_parent_and_child
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 1 holds most rows; its order values are bunched in one place."""
    rng = random.Random(5)
    data = [(1, 10**6 + i, rng.randint(1, 9)) for i in range(700)]
    data += [(1, rng.randint(10**8, 10**12), rng.randint(1, 9)) for _ in range(50)]
    data += [(g, i, rng.randint(1, 9)) for g in range(2, 30) for i in range(rng.randint(1, 9))]
    data += [(40, i * 3, 1) for i in range(60)]
    data = list({(g, o): (g, o, v) for g, o, v in data}.values())
    rng.shuffle(data)
    return spark.createDataFrame(data, "g long, o long, v long").repartition(7).cache()


def by_group(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["g"]].append(r)
    return {g: sorted(rs, key=lambda r: r["o"]) for g, rs in groups.items()}


@pytest.fixture(params=[1, 4, 16])
def ranges(request, spark):
    """So many ranges, none of them joined again for being small."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_running_total(skewed, ranges):
    got = by_group(running_total(skewed, ["g"], ["o"], F.col("v"), "t"))
    assert sum(map(len, got.values())) == skewed.count()
    for rs in got.values():
        total = 0
        for r in rs:
            total += r["v"]
            assert r["t"] == total


def test_numbered_in_group(skewed, ranges):
    for rs in by_group(numbered_in_group(skewed, ["g"], ["o"], "i")).values():
        assert [r["i"] for r in rs] == list(range(1, len(rs) + 1))


@pytest.mark.parametrize("following", [False, True])
def test_neighbour(skewed, ranges, following):
    got = by_group(neighbour(skewed, ["g"], ["o"], ["v", "o"], "near", following))
    for rs in got.values():
        values = [(r["v"], r["o"]) for r in rs]
        want = values[1:] + [None] if following else [None] + values[:-1]
        assert [tuple(r["near"]) if r["near"] else None for r in rs] == want


def test_nulls_are_values_like_others(spark, ranges):
    data = [(None, None), *[(None, i) for i in range(40)], (1, None), (1, 1), (1, 2), (2, 5)]
    df = spark.createDataFrame(data, "g long, o long").repartition(5)
    got = {(r["g"], r["o"]): r["i"] for r in numbered_in_group(df, ["g"], ["o"], "i").collect()}
    assert got == {(None, None): 1, **{(None, i): i + 2 for i in range(40)}, (1, None): 1, (1, 1): 2, (1, 2): 3, (2, 5): 1}


def test_order_by_two_columns_and_time(spark, skewed, ranges):
    timed = skewed.withColumn("at", F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,o % 100)"))
    got = {(r["g"], r["o"]): r["i"] for r in numbered_in_group(timed, ["g"], ["at", "o"], "i").collect()}
    want = {}
    for g in {g for g, _ in got}:
        order = sorted((o for h, o in got if h == g), key=lambda o: (o % 100, o))
        want |= {(g, o): i for i, o in enumerate(order, 1)}
    assert got == want


def test_a_large_group_is_spread(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sizes = [r["count"] for r in ranged(skewed, ["g"], ["o"]).groupBy(RANGE).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_rows_cut_once_serve_several_steps(skewed):
    cut = ranged(skewed, ["g"], ["o"])
    some = numbered_in_group(cut.filter("v > 3"), ["g"], ["o"], "i")
    again = neighbour(some, ["g"], ["o"], ["i"], "near")
    assert RANGE in again.columns
    for rs in by_group(again).values():
        assert [r["i"] for r in rs] == list(range(1, len(rs) + 1))
        assert [r["near"] and r["near"]["i"] for r in rs] == [None, *range(1, len(rs))]


def test_keys_are_dense_and_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("name", F.concat(F.lit("n"), "id")).select("name")
    one = rows(with_surrogate_key(df, ["name"], "k", start=11))
    other = rows(with_surrogate_key(df.repartition(13), ["name"], "k", start=11))
    assert one == other == sorted(one, key=lambda r: r[1])
    assert sorted(k for _, k in one) == list(range(11, 1011))


def test_surrogate_key_starts_after_the_highest(spark):
    existing = spark.createDataFrame([(5,), (41,)], "id long")
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert sorted(r["id"] for r in with_surrogate_key(new, ["name"], "id", existing).collect()) == [42, 43, 44]
    empty = existing.limit(0)
    assert sorted(r["id"] for r in with_surrogate_key(new, ["name"], "id", empty).collect()) == [1, 2, 3]
    assert with_surrogate_key(new.limit(0), ["name"], "id", existing).collect() == []
    assert spark.range(1).select(next_id(existing).alias("n")).first()["n"] == 42


def test_a_batch_that_is_run_again_gets_its_keys(spark, tmp_path):
    path = str(tmp_path / "rows")
    old = spark.createDataFrame([(10,)], "id long")

    def store(batch_id, names):
        there = read_batches(spark, path, "name string, id long")
        start = batch_start(old.union(there.select("id")), path, batch_id)
        new = spark.createDataFrame([(n,) for n in names], "name string")
        write_batch(with_surrogate_key(new, ["name"], start=start), path, batch_id)

    for batch_id, names in ((1, "ab"), (2, "cd"), (1, "ab"), (2, "cd")):
        store(batch_id, names)
    assert rows(read_batches(spark, path), "name", "id") == [("a", 11), ("b", 12), ("c", 13), ("d", 14)]


def test_parents_go_before_children_are_replaced(spark, tmp_path):
    heads, lines = str(tmp_path / "heads"), str(tmp_path / "lines")
    parents = spark.createDataFrame([(1,)], "id long")
    children = spark.createDataFrame([(1, "x")], "order_id long, what string")
    write_parent_and_child(parents, children, heads, lines, 7)
    broken = children.withColumn("what", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_parent_and_child(parents, broken, heads, lines, 7)
    assert read_batches(spark, heads, "id long").collect() == []
    write_parent_and_child(parents, children, heads, lines, 7)
    assert rows(read_children(spark, heads, lines, "order_id"), "order_id", "what") == [(1, "x")]


def test_scratch_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(tmp_path))
    assert written(spark.range(3), "three").count() == 3
    assert [p.name for p in tmp_path.iterdir()] == [f"cartlane-{spark.sparkContext.applicationId}"]
    drop_scratch(spark)
    assert list(tmp_path.iterdir()) == []


class _Session:
    """A session as far as the folder asks it."""

    def __init__(self, setting, folder, master):
        self.conf = SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default)
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: folder, master=master)


def test_the_shared_folder_is_the_setting():
    assert scratch.shared_folder(_Session("hdfs://x/y/", "z", "yarn")) == "hdfs://x/y"
    assert scratch.shared_folder(_Session(None, "z", "yarn")) == "z"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_Session(None, None, "yarn"))
    assert scratch.shared_folder(_Session(None, None, "local[2]")) == scratch.shared_folder(_Session(None, None, "local[2]"))


def test_assign_is_even_and_repeatable(spark):
    people = spark.range(4000).withColumnRenamed("id", "who")
    choices = spark.createDataFrame([(i * 10, f"c{i}") for i in range(8)], "id long, label string")
    pick = lambda p: assign(p, ["who"], choices, ["id"], {"id": "c", "label": "l"}, "s")
    got = rows(pick(people))
    assert got == rows(pick(people.repartition(11)))
    assert len(got) == 4000 and all(f"c{c // 10}" == label for _, c, label in got)
    counts = defaultdict(int)
    for _, c, _ in got:
        counts[c] += 1
    assert len(counts) == 8 and min(counts.values()) > 400


def test_assign_none_slot_condition_and_no_choices(spark):
    people = spark.range(3000).withColumnRenamed("id", "who")
    choices = spark.createDataFrame([(1,), (2,)], "id long")
    with_none = assign(people, ["who"], choices, ["id"], {"id": "c"}, "s", null_slot=True)
    none = with_none.filter("c IS NULL").count()
    assert with_none.count() == 3000 and 800 < none < 1200
    some = assign(people, ["who"], choices, ["id"], {"id": "c"}, "s", only_if=F.col("who") < 100)
    assert some.count() == 3000 and some.filter("c IS NOT NULL").count() == 100
    nothing = assign(people, ["who"], choices.limit(0), ["id"], {"id": "c"}, "s")
    assert nothing.count() == 3000 and nothing.filter("c IS NOT NULL").count() == 0


def test_baskets_are_distinct_sized_and_even(spark):
    requests = spark.range(3000).withColumnRenamed("id", "req")
    items = spark.range(100, 112).withColumnRenamed("id", "item")
    got = baskets(requests, "req", items, ["item"], "s").collect()
    per = defaultdict(list)
    for r in got:
        per[r["req"]].append(r)
    assert len(per) == 3000
    sizes, seen = defaultdict(int), defaultdict(int)
    for lines in per.values():
        assert len({r["item"] for r in lines}) == len(lines)
        assert sorted(r["line_number"] for r in lines) == list(range(1, len(lines) + 1))
        sizes[len(lines)] += 1
        for r in lines:
            seen[r["item"]] += 1
    assert set(sizes) == set(range(1, 11)) and min(sizes.values()) > 220
    assert min(seen.values()) > 0.9 * sum(seen.values()) / 12


def test_baskets_with_few_or_no_items(spark):
    requests = spark.range(200).withColumnRenamed("id", "req")
    items = spark.range(3).withColumnRenamed("id", "item")
    sizes = {r["n"] for r in baskets(requests, "req", items, ["item"], "s").groupBy("req").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1, 2, 3}
    assert baskets(requests, "req", items.limit(0), ["item"], "s").count() == 0


def test_sample_rows(spark):
    df = spark.range(500)
    a, b = rows(sample_rows(df, 10, ["id"], "s")), rows(sample_rows(df.repartition(9), 10, ["id"], "s"))
    assert a == b and len(set(a)) == 10 and a != rows(sample_rows(df, 10, ["id"], "other"))
    assert "TakeOrderedAndProject" in sample_rows(df, 10, ["id"], "s")._jdf.queryExecution().executedPlan().toString()


def test_distinct_up_to(spark):
    df = spark.createDataFrame([(v,) for v in "bbaccd"], "v string")
    assert rows(distinct_up_to(df, "v", 3)) == [("a",), ("b",), ("c",)]
    assert len(rows(distinct_up_to(df, "v", 9))) == 4


def test_draws_stay_in_range(spark):
    df = spark.range(5000).select(
        draw("s", "id").alias("d"),
        draw_int("s", 3, 7, "id").alias("i"),
        draw_decimal("s", "0.5", "0.9", 6, "id").alias("x"),
        draw_choice("s", ["a", "b"], "id").alias("c"),
        draw_chance("s", 4, 11, "id").alias("t"),
    )
    got = df.collect()
    assert all(0 <= r["d"] < 2**60 for r in got)
    assert {r["i"] for r in got} == {3, 4, 5, 6, 7}
    assert all(0.5 <= r["x"] <= 0.9 for r in got)
    assert {r["c"] for r in got} == {"a", "b"}
    assert 0.33 < sum(r["t"] for r in got) / 5000 < 0.40
