import random

import pytest
from pyspark.sql import functions as F

from cartlane.operators import audit, catalog, users
from cartlane.modes import REFERENCE, STRICT
from cartlane.plans.trees import subtree_totals, tree_intervals
from cartlane.schemas import TABLES
from cartlane.sources.tables import read_csv, seed_table
from tests.conftest import rows


def brute(parents):
    """Intervals by a walk from the roots; nodes that it does not reach have none."""
    children, out = {}, {k: (k, None, None, None, None) for k in parents}
    for k in sorted(parents):
        up = parents[k]
        children.setdefault(up if up in parents else None, []).append(k)
    place = 0
    for root in children.get(None, []):
        todo = [(root, 0, False)]
        begins = {}
        while todo:
            k, depth, left = todo.pop()
            if left:
                out[k] = (k, root, depth, begins[k], place)
                continue
            begins[k] = place
            place += 1
            todo.append((k, depth, True))
            todo += [(c, depth + 1, False) for c in reversed(children.get(k, []))]
    return sorted(out.values())


def frame(spark, parents):
    return spark.createDataFrame(sorted(parents.items()), "id long, category_id long")


@pytest.mark.parametrize("seed", range(2))
def test_intervals_of_random_forests(spark, seed):
    draw = random.Random(seed)
    parents = {k * 3: draw.choice([None, 10_000]) if k < 3 or draw.random() < 0.1 else 3 * draw.randrange(k) for k in range(120)}
    # A cycle with a branch, and a node under itself.
    parents |= {1001: 1004, 1004: 1007, 1007: 1001, 1010: 1007, 1013: 1010, 1016: 1016, 1019: 1016}
    found = tree_intervals(frame(spark, parents))
    assert rows(found, "id", "root_id", "depth", "begin", "end") == sorted(brute(parents), key=repr)
    facts = [(draw.choice([*parents, 77]), draw.randrange(100)) for _ in range(300)]
    got = {r["id"]: r["v"] for r in subtree_totals(found, spark.createDataFrame(facts, "k long, v long"), "k", ["v"]).collect()}
    spans = {k: (a, b) for k, _, _, a, b in brute(parents)}
    own = {k: sum(v for f, v in facts if f == k) for k in parents}
    for k, (a, b) in spans.items():
        assert got[k] == (None if a is None else sum(own[o] for o, (c, _) in spans.items() if c is not None and a <= c < b))


def test_a_chain_and_a_star(spark):
    deep, wide = 10_000, 5_000
    chain = spark.range(deep).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("category_id"))
    star = spark.range(1, wide).select((F.col("id") + deep).alias("id"), F.lit(0).cast("long").alias("category_id"))
    tree = chain.unionByName(star)
    facts = tree.select(F.col("id").alias("category_id"), F.lit(1).cast("long").alias("n"))
    got = {r["id"]: (r["depth"], r["n"]) for r in catalog.category_rollup(tree, facts, ["n"]).collect()}
    assert got[0] == (0, deep + wide - 1) and got[deep - 1] == (deep - 1, 1) and got[deep + 7] == (1, 1)
    assert all(got[k] == (k, deep - k) for k in range(1, deep))


def test_no_tree(spark):
    assert tree_intervals(frame(spark, {}) if False else spark.createDataFrame([], "id long, category_id long")).collect() == []
    assert rows(tree_intervals(frame(spark, {5: 5}))) == [(5, None, None, None, None)]


# Batches


def _batches(draw, n):
    """Batches of one to three users; some users come twice, some hold a role."""
    listed, user = [], 0
    for batch in range(n):
        for _ in range(draw.randrange(0, 4)):
            listed.append((user if draw.random() < 0.9 else draw.randrange(user + 1), batch))
            user += 1
    return listed


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
@pytest.mark.parametrize("seed", range(3))
def test_roles_equal_batch_by_batch(spark, mode, seed):
    draw = random.Random(seed)
    listed = _batches(draw, 10_000 if seed == 0 else 12)
    names = {r["id"]: r["role_name"] for r in seed_table(spark, "roles").collect()}
    held = [(draw.choice(list(names)), 1_000_000 + n) for n in range(seed * 2)] + [(4, 3)]
    people = spark.createDataFrame(listed, "id long, batch int")
    found = users.assign_roles(people, spark.createDataFrame(held, "role_id long, user_id long"), seed_table(spark, "roles"), mode, "batch")
    got = {r["user_id"]: r["role_name"] for r in found.collect()}
    counts = {r: sum(names[i] == r for i, _ in held) for r in users.ROLE_QUOTAS}
    want, known = {}, {u for _, u in held}
    by_batch = {}
    for user, batch in listed:
        by_batch.setdefault(batch, []).append(user)
    first = lambda: next((r for r, q in users.ROLE_QUOTAS.items() if counts[r] < q), "customer")
    for batch in sorted(by_batch):
        role = first()
        for user in sorted(set(by_batch[batch]) - known):
            role = first() if mode == STRICT else role
            want[user] = role
            known.add(user)
            if role in counts and mode == STRICT:
                counts[role] += 1
        if mode == REFERENCE and role in counts:
            counts[role] += sum(1 for u in set(by_batch[batch]) if want.get(u) == role and u in known)
    assert got == want


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_tags_equal_batch_by_batch(spark, mode):
    draw = random.Random(4)
    pairs = [(n, 1 if draw.random() < 0.4 else draw.randrange(6), draw.randrange(9), n // 5) for n in range(400)]
    old = [(1, 0), (2, 1), (2, 2), (2, 3), (2, 4), (2, 5)]
    df = spark.createDataFrame(pairs, "n int, product_id int, tag_id int, batch int")
    there = spark.createDataFrame(old, "product_id int, tag_id int")
    got = catalog.associate_tags(df, "n", there, 5, mode, batch="batch")
    kept, want = there, []
    for batch in sorted({p[3] for p in pairs})[:14]:
        new = [tuple(r) for r in catalog.associate_tags(df.filter(F.col("batch") == batch), "n", kept, 5, mode).collect()]
        want += new
        kept = spark.createDataFrame([*old, *((p, t) for _, p, t, _ in want)], "product_id int, tag_id int")
    assert rows(got.filter("batch < 14")) == sorted(want, key=repr)
    full = {}
    for _, p, t, _ in rows(got):
        full.setdefault(p, set()).add(t)
    assert all(len(t) >= 4 for p, t in full.items() if p > 2)


# Audits


def test_duplicate_keys_of_equals_duplicate_keys(spark):
    draw = random.Random(5)
    made = [(draw.choice([None, *range(40)]), draw.choice(["a", "b", None, "a\x00"]), draw.randrange(200)) for _ in range(300)]
    df = spark.createDataFrame(made, "a int, b string, c long")
    keys = [["a"], ["b"], ["a", "b"], ["c", "a", "b"]]
    got = audit.duplicate_keys_of(df, keys)
    want = [(",".join(k), [str(r[c]) for c in k], r["rows"]) for k in keys for r in audit.duplicate_keys(df, k).collect()]
    assert rows(got) == sorted(want, key=repr)


def test_audit_together_equals_the_single_audits(spark, tmp_path):
    people = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (2, "b", "x"), (None, "c", "y")], "id long, username string, email string")
    orders = spark.createDataFrame([(i, i % 4, 1 if i % 3 else 9) for i in range(20)], "id int, user_id int, order_status_id long")
    amounts = {c: F.lit(n).cast("decimal(15,2)") for c, n in (("order_amount", 5), ("tax_amount", 1), ("discount_amount", 2), ("total_amount", 4))}
    amounts["total_amount"] = (F.col("id") % 5).cast("decimal(15,2)")
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 8)], "id long, category_id long")
    frames = {"users": people, "orders": orders.withColumns(amounts), "categories": tree}
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    frames = {name: spark.read.parquet(str(tmp_path / name)) for name in frames} | {"orderstatus": seed_table(spark, "orderstatus")}
    got = audit.audit_together(frames, ["users", "orders", "categories"])
    want = [r for n in ("users", "orders", "categories") for r in rows(audit.audit_table(TABLES[n], frames))]
    assert rows(got) == sorted(want, key=repr)
    assert {r[1] for r in want if r[3]} >= {"unique", "reference", "totals", "not_null"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("] parquet") <= 2 * 3


# Files and categories


def test_null_tokens_of_a_file(spark, tmp_path):
    lines = ['"city",state_name,lat,lng', 'A,NA,1.5,"NaN"', '"NA",X,"",2', "na, NA,null,3", 'C,"",#N/A,-nan', "D,None,<NA>,4", "E,Nothing,n/a,1.#IND"]
    (tmp_path / "places.csv").write_text("\n".join(lines) + "\n")
    got = read_csv(spark, str(tmp_path / "places.csv"), "city string, state_name string, lat double, lng double")
    want = [("A", None, 1.5, None), (None, "X", None, 2.0), ("na", " NA", None, 3.0), ("C", None, None, None), ("D", None, None, 4.0), ("E", "Nothing", None, None)]
    assert rows(got) == sorted(want, key=repr)


def test_categories_under_given_parents(spark):
    existing = spark.createDataFrame([(1, "Lamp", "lamp"), (7, "Chair", "chair")], "id long, category_name string, slug string")
    new = spark.createDataFrame([(3, "Lamp", 7), (1, "Lamp", None), (2, "Sofa", 99), (4, "Sofa", 1)], "n int, category_name string, category_id long")
    got = catalog.given_categories(new, "n", existing, "2024-01-01")
    want = [(8, "Lamp", "lamp-1", None), (9, "Lamp", "lamp-2", 7), (10, "Sofa", "sofa", 1)]
    assert rows(got, "id", "category_name", "slug", "category_id") == sorted(want, key=repr)
    assert set(got.columns) == {c.name for c in TABLES["categories"].columns}
    assert rows(catalog.given_categories(new, "n", existing, "2024-01-01", start=50), "id") == [(50,), (51,), (52,)]
