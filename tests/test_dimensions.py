import pytest
from pyspark.sql import functions as F

from cartlane.functions.text import base_slug, digest, joined
from cartlane.functions.times import from_epoch_millis, to_epoch_millis, to_second
from cartlane.modes import STRICT
from cartlane.operators import catalog, geo, upserts, users
from cartlane.schemas import SEEDS, TABLES
from cartlane.sources.sinks import append, read_batches, read_children, write_batch, write_parent_and_child
from cartlane.sources.tables import POSITION, read_csv, seed_if_empty, seed_table
from tests.conftest import rows


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_first_row_of_each_key_goes_in(spark):
    batch = frame(spark, "k string, n int", ("a", 3), ("a", 1), ("b", 2), ("c", 9), (None, 5), (None, 6)).repartition(4)
    target = frame(spark, "k string", ("b",), (None,))
    new = upserts.insert_new(batch, target, ["k"], ["n"])
    assert rows(new) == [("a", 1), ("c", 9), (None, 5), (None, 6)]
    assert rows(upserts.rejected(batch, new, ["n"]), "n") == [(2,), (3,)]
    assert rows(upserts.insert_new(batch.limit(0), target, ["k"], ["n"])) == []
    assert len(rows(upserts.insert_new(batch, None, ["k"], ["n"]))) == 5


def test_composite_key_with_a_null_is_never_equal(spark):
    batch = frame(spark, "a int, b int, n int", (1, 1, 1), (1, 1, 2), (1, None, 3), (1, None, 4))
    assert rows(upserts.insert_new(batch, None, ["a", "b"], ["n"]), "n") == [(1,), (3,), (4,)]


def test_frequent_key_is_cut_before_the_shuffle(spark):
    batch = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    plan = upserts.first_per_key(batch, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_update_by_key(spark):
    target = frame(spark, "id int, a string, b int", (1, "x", 1), (2, "y", 2), (3, "z", 3))
    updates = frame(spark, "id int, a string, at int", (2, "old", 1), (2, None, 2), (9, "q", 1))
    assert rows(upserts.update_by_key(target, updates, "id", ["a"], ["at"])) == [(1, "x", 1), (2, None, 2), (3, "z", 3)]


def test_a_key_that_is_updated_twice(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string")
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "z", 1), (None, "z", 2)], "id long, a string, at int")
    with pytest.raises(Exception, match="id is updated twice: 1"):
        upserts.update_by_key(target, twice, "id", ["a"]).collect()
    assert rows(upserts.update_by_key(target, twice, "id", ["a"], ["at"])) == [(1, "y"), (2, "b")]


def test_a_missing_role_is_an_error(spark):
    people = spark.createDataFrame([(i,) for i in range(9)], "id long")
    roles = spark.createDataFrame([(1, "admin"), (2, "staff"), (3, "manager")], "id long, role_name string")
    none = spark.createDataFrame([], "role_id long, user_id long")
    with pytest.raises(Exception, match="there is no role customer"):
        users.assign_roles(people, none, roles, STRICT).collect()


def test_reading_before_anything_was_written(spark, tmp_path):
    got = read_batches(spark, str(tmp_path / "nothing"), "id long")
    assert got.columns == ["id", "batch_id"] and got.collect() == []



def test_assign_roles_strict_and_reference(spark):
    people, roles = spark.range(1, 13), seed_table(spark, "roles")
    none = spark.createDataFrame([], "role_id long, user_id long")
    strict = [r["role_name"] for r in users.assign_roles(people, none, roles, STRICT).orderBy("user_id").collect()]
    assert strict == ["admin"] + ["manager"] * 2 + ["staff"] * 4 + ["customer"] * 5
    assert {r["role_name"] for r in users.assign_roles(people, none, roles).collect()} == {"admin"}


@pytest.mark.parametrize(
    "held, reference, strict",
    [
        ([1], "manager", ["manager", "manager", "staff"]),
        ([1, 3, 3, 2], "staff", ["staff", "staff", "staff"]),
        ([1, 3, 3, 2, 2, 2, 2], "customer", ["customer", "customer", "customer"]),
        ([3, 3, 3, 2], "admin", ["admin", "staff", "staff"]),
        ([1, 1, 3], "manager", ["manager", "staff", "staff"]),
    ],
)
def test_assign_roles_looks_at_holders(spark, held, reference, strict):
    holders = frame(spark, "role_id long, user_id long", *[(r, 100 + i) for i, r in enumerate(held)], (4, 2))
    people, roles = frame(spark, "id long", (1,), (2,), (3,), (4,)), seed_table(spark, "roles")
    assert {r["role_name"] for r in users.assign_roles(people, holders, roles).collect()} == {reference}
    got = users.assign_roles(people, holders, roles, STRICT).orderBy("user_id").collect()
    assert [(r["user_id"], r["role_name"]) for r in got] == list(zip([1, 3, 4], strict))


def test_ready_gate(spark):
    roles = seed_table(spark, "roles")
    addresses, role_user = frame(spark, "user_id long", (1,), (2,)), frame(spark, "role_id long, user_id long", (4, 2), (2, 1))
    assert rows(users.ready_gate(addresses, role_user, roles)) == [(True,)]
    assert rows(users.ready_gate(addresses, role_user.filter("role_id = 2"), roles)) == [(False,)]
    assert rows(users.ready_gate(addresses.limit(0), role_user, roles)) == [(False,)]


def test_role_counts_with_an_unused_role(spark):
    role_user = frame(spark, "role_id long, user_id long", (4, 1), (4, 2), (2, 3))
    assert rows(users.role_counts(role_user, seed_table(spark, "roles")), "role_name", "user_count") == [
        ("admin", 0), ("customer", 2), ("manager", 0), ("staff", 1)
    ]


def test_category_levels(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    forest = [(100, None), (101, 100), (102, 100), (103, 102)]
    got = {r["id"]: (r["root_id"], r["depth"]) for r in catalog.category_levels(frame(spark, "id long, category_id long", *chain, *forest)).collect()}
    assert all(got[i] == (0, i) for i in range(40))
    assert got[103] == (100, 2) and got[101] == (100, 1) and got[100] == (100, 0)


@pytest.mark.parametrize("cycle", [[(1, 1)], [(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1), (4, 1)]])
def test_a_cycle_of_categories_is_an_error(spark, cycle):
    with pytest.raises(ValueError):
        catalog.category_levels(frame(spark, "id long, category_id long", (9, None), *cycle))


def test_parents(spark):
    tree = frame(spark, "id long, category_name string, category_id long", (1, "Product A", None), (2, "products", 1), (3, "My Product", 2))
    assert rows(catalog.parent_candidates(tree), "id") == [(1,), (2,)]
    assert rows(catalog.with_parent_name(tree), "id", "parent_name") == [(1, None), (2, "Product A"), (3, "products")]
    old = tree.withColumn("slug", base_slug(F.col("category_name")))
    names = spark.range(300).select("id", F.lit("Lamp").alias("category_name"))
    new = catalog.new_categories(names, "id", old, "s").collect()
    assert len({r["slug"] for r in new}) == 300
    assert {r["category_id"] for r in new} == {None, 1, 2}
    rootless = catalog.new_categories(names, "id", old.filter("id = 3"), "s")
    assert rootless.filter("category_id IS NOT NULL").count() == 0


def test_tag_cap_modes(spark):
    old = frame(spark, "product_id long, tag_id long", (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (2, 4), (2, 5))
    new = frame(spark, "event long, product_id long, tag_id long", (1, 1, 3), (2, 1, 9), (3, 1, 8), (4, 1, 9), (5, 1, 7), (6, 2, 9), (7, 3, 1))
    reference = catalog.associate_tags(new, "event", old)
    assert rows(reference) == [(2, 1, 9), (3, 1, 8), (5, 1, 7), (7, 3, 1)]
    strict = catalog.associate_tags(new, "event", old, mode=STRICT)
    assert rows(strict) == [(2, 1, 9), (3, 1, 8), (7, 3, 1)]


def test_product_values(spark):
    drawn = catalog.draw_product_values(spark.range(500).withColumnRenamed("id", "p"), ["p"], spark.range(3), spark.range(10, 12), "s")
    low, high = drawn.agg(F.min("product_price"), F.min("product_tax"), F.min("product_quantity")).first(), drawn.agg(
        F.max("product_price"), F.max("product_tax"), F.max("product_quantity")
    ).first()
    assert low[0] >= 10 and low[1] >= 0 and low[2] >= 1 and high[0] <= 1000 and high[1] <= 20 and high[2] <= 100
    assert drawn.select("category_id").distinct().count() == 3 and drawn.select("brand_id").distinct().count() == 2


CSV = """county,city,lat,lng,state_name
x,Springfield,1.5,2.5,Ohio
x,Springfield,1.5,2.5,Ohio
y,Springfield,0.5,9.5,Ohio
y,Dover,3.0,4.0,Delaware
z,Dover,3.0,4.0,
z,Nowhere,5.0,6.0,Atlantis
"""


def test_provinces_and_cities_from_a_file(spark, tmp_path):
    (tmp_path / "places.csv").write_text(CSV)
    schema = "city string, state_name string, lat double, lng double"
    places = read_csv(spark, str(tmp_path / "places.csv"), schema)
    old = frame(spark, "id long, province_name string", (7, "Ohio"))
    new = geo.new_provinces(places, old)
    assert sorted(r["province_name"] for r in new.collect()) == ["Atlantis", "Delaware"]
    assert sorted(r["id"] for r in new.collect()) == [8, 9]
    exact = read_csv(spark, str(tmp_path / "places.csv"), "lat decimal(9,6), city string")
    assert exact.columns == ["lat", "city"] and dict(exact.dtypes)["lat"] == "decimal(9,6)" and exact.count() == 6
    provinces = frame(spark, "id long, province_name string", (7, "Ohio"), (8, "Delaware"))
    ordered = read_csv(spark, str(tmp_path / "places.csv"), schema, position=True)
    cities = geo.new_cities(ordered, provinces, order=POSITION)
    assert rows(cities, "city_name", "province_id", "latitude") == [("Dover", 8, 3.0), ("Springfield", 7, 1.5)]
    there = frame(spark, "id long, city_name string, province_id long", (5, "Dover", 8))
    assert rows(geo.new_cities(places, provinces, there), "id", "city_name", "latitude") == [(6, "Springfield", 0.5)]
    assert geo.new_cities(places, provinces.limit(0)).count() == 0


def test_file_position_over_several_blocks(spark, tmp_path):
    lines = ["city,state_name,lat,lng"] + [f"c{i},s,{i},0" for i in range(4000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = read_csv(spark, str(tmp_path / "big.csv"), "city string, lat int", position=True)
        assert df.rdd.getNumPartitions() > 1
        assert [r["lat"] for r in df.orderBy(*POSITION).collect()] == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_addresses(spark):
    people = spark.range(200).select("id", F.lit("1 Road").alias("street"), F.lit("Unit 2").alias("unit"))
    there = frame(spark, "user_id long", (1,), (2,), (2,))
    cities = frame(spark, "id long, province_id long", (10, 1), (20, 2), (21, 2))
    made = geo.attach_addresses(people, there, cities, "s").collect()
    assert len(made) == 198 and {r["title"] for r in made} == {"home", "office"}
    assert {(r["city_id"], r["province_id"]) for r in made} == {(10, 1), (20, 2), (21, 2)}
    assert {r["full_address"] for r in made} == {"1 Road, Unit 2"}
    assert geo.attach_addresses(people, there, cities.limit(0), "s").count() == 0


def test_seeds(spark):
    for name, data in SEEDS.items():
        got = seed_table(spark, name).orderBy("id").collect()
        assert [tuple(r)[1:] for r in got] == data and [r["id"] for r in got] == list(range(1, len(data) + 1))
    roles = seed_table(spark, "roles")
    assert seed_if_empty(roles, roles.limit(0)).count() == 4
    assert seed_if_empty(roles, roles.limit(1)).count() == 0


def test_batches_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(spark.range(3), path, 1)
    write_batch(spark.range(5), path, 2)
    write_batch(spark.range(4), path, 2)
    assert read_batches(spark, path).count() == 7
    append(spark.range(2), str(tmp_path / "u"))
    append(spark.range(2), str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 4


def test_children_without_parents_stay_unseen(spark, tmp_path):
    parents, children = str(tmp_path / "p"), str(tmp_path / "c")
    heads = frame(spark, "id long", (1,), (2,))
    details = frame(spark, "order_id long, n int", (1, 1), (1, 2), (2, 3))
    write_parent_and_child(heads, details, parents, children, 1)
    write_batch(frame(spark, "order_id long, n int", (3, 4)), children, 2)
    assert rows(read_children(spark, parents, children, "order_id"), "order_id", "n") == [(1, 1), (1, 2), (2, 3)]


def test_text(spark):
    df = frame(spark, "s string", ("Home & Garden",), ("Café  Noir!",))
    assert rows(df.select(base_slug(F.col("s")))) == [("café-noir-",), ("home-garden",)]
    assert df.select(digest(F.lit("abc"))).first()[0].startswith("ba7816bf8f01cfea")
    assert df.select(joined(F.lit("a"), F.lit("b"))).first()[0] == "a, b"


def test_times(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-29 23:59:59.5' AS t, timestamp_ntz'1969-12-31 23:59:59.499' AS u")
    assert [str(v) for v in df.select(to_second(F.col("t")), to_second(F.col("u"))).first()] == ["2024-03-01 00:00:00", "1969-12-31 23:59:59"]
    back = df.select(from_epoch_millis(to_epoch_millis(F.col("t"))), to_epoch_millis(F.col("u"))).first()
    assert str(back[0]) == "2024-02-29 23:59:59.500000" and back[1] == -501


def test_schemas_cover_the_model():
    assert len(TABLES) == 22
    for table in TABLES.values():
        names = [c.name for c in table.columns]
        assert names[0] == "id" and names[-1] == "created_at" and len(set(names)) == len(names)
        for key in table.unique:
            assert set(key) <= set(names)
        for column, parent in table.references.items():
            assert column in names and parent in TABLES
    assert sum(len(t.references) for t in TABLES.values()) == 27
