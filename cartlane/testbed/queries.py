"""One query per operator, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column as Expression
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_choice
from cartlane.functions.text import base_slug
from cartlane.functions.times import as_of_column, plus_days, to_second
from cartlane.modes import REFERENCE, STRICT
from cartlane.operators import audit, catalog, geo, orders, payments, promotions, upserts, users
from cartlane.operators.slugs import unique_slugs
from cartlane.plans.keys import with_surrogate_key
from cartlane.plans.samples import baskets, distinct_up_to, sample_rows
from cartlane.plans.scratch import scratch_path, written
from cartlane.plans.trees import tree_intervals
from cartlane.schemas import TABLES, Column, Table
from cartlane.sources.sinks import batch_start, read_batches, read_children, write_batch, write_parent_and_child
from cartlane.sources.tables import POSITION, read_csv, seed_if_empty
from cartlane.streaming import envelope, feed, handover, history, references, repeats, routing, state, totals
from cartlane.testbed.model import AS_OF, SEED, Model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    QUERIES[make.__name__] = lambda spark, folder: make(Model(spark, folder))
    return make


# Orders


@query
def order_totals(m: Model) -> DataFrame:
    return orders.order_totals(m.lines())


@query
def order_totals_strict(m: Model) -> DataFrame:
    return orders.order_totals(m.lines(), mode=STRICT)


@query
def order_lines_priced(m: Model) -> DataFrame:
    reference = orders.price_lines(m.products(), ["id"], SEED)
    both = orders.price_lines(reference.withColumnRenamed("subtotal_amount", "tax_subtotal"), ["id"], SEED, STRICT)
    return both.select("id", "quantity", "tax_subtotal", "subtotal_amount", "unit_cost")


@query
def order_costs(m: Model) -> DataFrame:
    priced = m.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast("decimal(15,2)").alias("unit_cost")
    )
    return orders.order_costs(priced)


def _discounted(m: Model, mode: str) -> DataFrame:
    amounts = m.orders().select("id", F.col("total_amount").alias("order_amount"))
    taxed = amounts.withColumn("tax_amount", F.lit(0).cast("decimal(15,2)"))
    found = orders.apply_discounts(taxed, ["id"], m.discounts(), AS_OF, f"{SEED}-give", mode)
    return orders.stored_amounts(found).select("id", "discount_id", "discount_amount", "total_amount")


@query
def discount_amounts(m: Model) -> DataFrame:
    return _discounted(m, REFERENCE)


@query
def discount_amounts_strict(m: Model) -> DataFrame:
    return _discounted(m, STRICT)


def _people(m: Model) -> dict:
    return {
        "users": m.users(),
        "role_user": m.role_user(),
        "roles": m.seeds("roles"),
        "addresses": m.addresses(),
        "payment_methods": m.seeds("paymentmethods"),
        "shipping_methods": m.seeds("shippingmethods"),
        "existing_orders": m.raw("orders").select(F.col("o_orderkey").alias("id")),
    }


def _goods(m: Model, mode: str) -> dict:
    return {
        "products": m.products(),
        "discounts": m.discounts(),
        "statuses": m.seeds("orderstatus"),
        "as_of": AS_OF,
        "seed": SEED,
        "mode": mode,
    }


def _assembled(m: Model, mode: str = REFERENCE) -> orders.Assembled:
    requests = m.raw("orders").select("o_orderkey")
    return orders.assemble_orders(requests, "o_orderkey", **_goods(m, mode), **_people(m))


@query
def order_assembly(m: Model) -> DataFrame:
    return _assembled(m).orders


@query
def order_assembly_strict(m: Model) -> DataFrame:
    return _assembled(m, STRICT).orders


def _from_picks(m: Model, mode: str) -> DataFrame:
    lines = orders.lines_from_picks(m.basket(), m.products(), mode)
    return orders.orders_from_picks(m.picks(), lines, m.given_discounts(), m.seeds("orderstatus"), AS_OF, mode)


@query
def orders_given(m: Model) -> DataFrame:
    """Orders of given customers, staff, methods, discounts and baskets; some without a line."""
    return _from_picks(m, REFERENCE)


@query
def orders_given_strict(m: Model) -> DataFrame:
    return _from_picks(m, STRICT)


@query
def order_lines_given(m: Model) -> DataFrame:
    return orders.lines_from_picks(m.basket(), m.products())


@query
def discounts_given(m: Model) -> DataFrame:
    amounts = m.raw("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("order_amount"),
        (F.col("o_custkey") % 10).alias("discount_id"),
    )
    found = orders.given_discounts(amounts, m.given_discounts(), AS_OF, STRICT)
    return found.select("id", "discount_id", F.col("discount_amount").cast("decimal(15,2)").alias("discount_amount"))


def _own_time(key: Expression) -> Expression:
    return plus_days(as_of_column(AS_OF), key % 50 - 30)


@query
def discounts_given_at_own_time(m: Model) -> DataFrame:
    """Each order asks for a discount at a time of its own."""
    amounts = m.raw("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("order_amount"),
        (F.col("o_custkey") % 10).alias("discount_id"),
        _own_time(F.col("o_orderkey")).alias("ordered_at"),
    )
    found = orders.given_discounts(amounts, m.given_discounts(), F.col("ordered_at"))
    return found.select("id", "ordered_at", "discount_id", F.col("discount_amount").cast("decimal(15,2)").alias("discount_amount"))


@query
def orders_given_at_own_time(m: Model) -> DataFrame:
    """``orders_given_strict`` with every order made at a time of its own."""
    picks = m.picks().withColumn("ordered_at", _own_time(F.col("id")))
    lines = orders.lines_from_picks(m.basket(), m.products(), STRICT)
    return orders.orders_from_picks(picks, lines, m.given_discounts(), m.seeds("orderstatus"), F.col("ordered_at"), STRICT)


def _numbered_orders(m: Model, batch_id: int) -> DataFrame:
    return m.raw("orders").filter(F.col("o_orderkey") % 2 == batch_id % 2).select("o_orderkey", "o_custkey")


@query
def orders_replayed(m: Model) -> DataFrame:
    """Two batches of orders with keys of their own, then the first one again."""
    path, lines = scratch_path(m.spark, "orders"), scratch_path(m.spark, "lines")
    old = m.raw("orders").select(F.col("o_orderkey").alias("id"))
    for batch_id in (1, 2, 1):
        there = read_batches(m.spark, path, "id long, o_orderkey long, o_custkey long")
        start = batch_start(old.unionByName(there.select("id")), path, batch_id)
        rows = with_surrogate_key(_numbered_orders(m, batch_id), ["o_orderkey"], start=start)
        heads = rows.select("id", "o_orderkey", "o_custkey")
        items = heads.join(m.basket(), F.col("o_orderkey") == F.col("order_id")).select(F.col("id").alias("order_id"), "product_id")
        write_parent_and_child(heads, items, path, lines, batch_id)
    counted = read_children(m.spark, path, lines, "order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("line_count"))
    found = read_batches(m.spark, path).join(counted, F.col("id") == F.col("order_id"), "left")
    return found.select("id", "o_orderkey", F.coalesce("line_count", F.lit(0)).alias("line_count"))


@query
def append_batches(m: Model) -> DataFrame:
    """Events appended in three batches, the second of them twice, as a retried job does."""
    path = scratch_path(m.spark, "appended")
    rows = m.raw("events").select("event_id", "user_id")
    for batch_id in (0, 1, 2, 1):
        write_batch(rows.filter(F.col("event_id") % 3 == batch_id), path, batch_id)
    return read_batches(m.spark, path).select("event_id", "user_id", F.col("batch_id").cast("int").alias("batch_id"))


@query
def due_dates(m: Model) -> DataFrame:
    """Each line's payment is due ten days after shipping for each piece of its line number."""
    due = plus_days(F.col("l_shipdate"), F.col("l_linenumber") * 10)
    return m.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", due.alias("due_at"))


@query
def order_assembly_lines(m: Model) -> DataFrame:
    return _assembled(m).lines


@query
def orders_saved(m: Model) -> DataFrame:
    """A batch of orders assembled, written, and read back with its lines."""
    heads, lines = scratch_path(m.spark, "orders"), scratch_path(m.spark, "lines")
    requests = m.raw("orders").select("o_orderkey")
    orders.save_orders(requests, "o_orderkey", heads, lines, 1, **_goods(m, REFERENCE), **_people(m))
    counted = read_children(m.spark, heads, lines, "order_id").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count")
    )
    return read_batches(m.spark, heads).join(counted, F.col("id") == F.col("order_id")).select(
        "id", "order_amount", "total_amount", "line_count"
    )


@query
def parent_child_write(m: Model) -> DataFrame:
    """Orders and lines written as one batch, read back as whole orders."""
    parents, children = scratch_path(m.spark, "orders"), scratch_path(m.spark, "lines")
    rows = m.orders().select("id", "total_amount")
    lines = m.lines().select("order_id", "product_id", "quantity")
    write_parent_and_child(rows, lines, parents, children, batch_id=1)
    read = read_children(m.spark, parents, children, "order_id").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("pieces")
    )
    return read_batches(m.spark, parents).join(read, F.col("id") == F.col("order_id"), "left").select(
        "id", "total_amount", F.coalesce("line_count", F.lit(0)).alias("line_count"), F.coalesce("pieces", F.lit(0)).alias("pieces")
    )


def _transactions(m: Model) -> DataFrame:
    requests = m.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    return payments.make_transactions(m.orders(), requests, SEED)


@query
def transactions_from_orders(m: Model) -> DataFrame:
    return _transactions(m)


def _after_payment(m: Model, mode: str) -> DataFrame:
    after = payments.status_after_payment(_transactions(m), SEED, mode)
    return orders.change_status(m.orders(), after, m.seeds("orderstatus"), AS_OF, mode)


@query
def status_after_payment(m: Model) -> DataFrame:
    return _after_payment(m, REFERENCE)


@query
def status_after_payment_strict(m: Model) -> DataFrame:
    return _after_payment(m, STRICT)


@query
def status_change_by_name(m: Model) -> DataFrame:
    """One status name per order priority; a name that does not exist changes nothing."""
    name = F.when(F.col("o_orderpriority") == "1-URGENT", "Shipped").when(
        F.col("o_orderpriority") == "5-LOW", "Cancelled"
    )
    changes = m.raw("orders").select(
        F.col("o_orderkey").alias("id"), F.coalesce(name, F.lit("Unheard of")).alias("order_status_name")
    )
    return orders.change_status(m.orders(), changes, m.seeds("orderstatus")).select("id", "order_status_id")


@query
def status_changed_twice(m: Model) -> DataFrame:
    """Every order gets a first status, half of them a second one, and some an unknown third."""
    keys = m.raw("orders").select(F.col("o_orderkey").alias("id"))
    steps = [
        keys.select("id", F.lit("Processing").alias("order_status_name"), F.lit(1).alias("step")),
        keys.filter("id % 2 = 0").select("id", F.lit("Shipped").alias("order_status_name"), F.lit(2).alias("step")),
        keys.filter("id % 3 = 0").select("id", F.lit("Unheard of").alias("order_status_name"), F.lit(3).alias("step")),
    ]
    changes = reduce(DataFrame.unionByName, steps)
    changed = orders.change_status(m.orders(), changes, m.seeds("orderstatus"), AS_OF, STRICT, sequence="step")
    return changed.select("id", "order_status_id", "updated_at")


def _paid(m: Model) -> DataFrame:
    """Payments with their results: one per order, and a second one for urgent orders."""
    rows = m.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_custkey") % 4 != 0).cast("string").alias("status"),
        F.when(F.col("o_custkey") % 8 == 0, "Cancelled").otherwise("Shipped").alias("next_status"),
        "o_orderpriority",
    )
    again = rows.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"request_id": F.col("request_id") + 100_000_000, "status": F.lit("false"), "next_status": F.lit("Pending")}
    )
    return rows.unionByName(again).drop("o_orderpriority")


@query
def transactions_stored(m: Model) -> DataFrame:
    return payments.stored_transactions(m.orders(), _paid(m), "request_id", AS_OF)


@query
def status_after_given_payment(m: Model) -> DataFrame:
    """The result of each payment decides whether the status asked for is taken; the last one counts."""
    paid = _paid(m).withColumn("status", F.col("status").cast("boolean"))
    return orders.change_status(
        m.orders(), payments.next_status(paid), m.seeds("orderstatus"), sequence="request_id"
    ).select("id", "order_status_id")


@query
def status_ids(m: Model) -> DataFrame:
    """Status names looked up, then counted."""
    return m.orders().groupBy("order_status_id").agg(F.count(F.lit(1)).alias("orders"))


# Users


@query
def role_quota(m: Model) -> DataFrame:
    nobody = m.role_user().filter("role_id = 1")
    return users.assign_roles(m.users(), nobody, m.seeds("roles"), STRICT)


@query
def role_quota_with_holders(m: Model) -> DataFrame:
    """Machinery customers are staff already, so only admin and manager places are free."""
    held = m.role_user().filter("role_id = 2")
    return users.assign_roles(m.users(), held, m.seeds("roles"), STRICT)


@query
def role_quota_reference(m: Model) -> DataFrame:
    held = m.role_user().filter("role_id = 2")
    return users.assign_roles(m.users(), held, m.seeds("roles"), REFERENCE)


def _users_by_two(m: Model) -> DataFrame:
    return m.users().withColumn("batch", F.floor(F.col("id") / 2))


@query
def role_quota_by_batch(m: Model) -> DataFrame:
    """Two users a batch; each batch sees the counts that those before it left."""
    nobody = m.role_user().filter("role_id = 1")
    return users.assign_roles(_users_by_two(m), nobody, m.seeds("roles"), REFERENCE, batch="batch")


@query
def role_quota_by_batch_strict(m: Model) -> DataFrame:
    held = m.role_user().filter("role_id = 3 AND user_id % 100 = 0")
    return users.assign_roles(_users_by_two(m).withColumn("batch", -F.col("batch")), held, m.seeds("roles"), STRICT, batch="batch")


@query
def users_with_role(m: Model) -> DataFrame:
    return users.users_with_role(m.users(), m.role_user(), m.seeds("roles"), "staff").select("id", "username")


@query
def users_in_named_group(m: Model) -> DataFrame:
    """Customers as users, nations as memberships, regions as roles."""
    nation = m.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("role_id"))
    member = m.raw("customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("user_id"), "role_id")
    regions = m.raw("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("role_name"))
    return users.users_with_role(m.users(), member, regions, "ASIA").select("id", "username")


@query
def customers_without_orders_since(m: Model) -> DataFrame:
    recent = m.raw("orders").filter(F.col("o_orderdate") >= as_of_column("2001-01-01"))
    return users.users_without(m.users(), recent.select(F.col("o_custkey").alias("user_id"))).select("id", "username")


@query
def ready_gate(m: Model) -> DataFrame:
    return users.ready_gate(m.addresses(), m.role_user(), m.seeds("roles"))


@query
def role_counts(m: Model) -> DataFrame:
    return users.role_counts(m.role_user(), m.seeds("roles"))


@query
def password_digest(m: Model) -> DataFrame:
    return users.with_digest(m.users().select("id", F.col("username").alias("password")))


# Catalog


@query
def slugged_parts(m: Model) -> DataFrame:
    return unique_slugs(m.raw("part").select("p_partkey", "p_name"), "p_name", "p_partkey")


def _old_slugs(m: Model) -> DataFrame:
    """Small parts hold numbered slugs with gaps, large economy parts the bare ones."""
    part = m.raw("part").withColumn("base", base_slug(F.col("p_name")))
    numbered = part.filter(F.col("p_type") == "SMALL").select(F.concat_ws("-", "base", "p_size").alias("slug"))
    bare = part.filter((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 45)).select(F.col("base").alias("slug"))
    return numbered.unionByName(bare).distinct()


@query
def slug_with_existing(m: Model) -> DataFrame:
    old = (F.col("p_type") == "SMALL") | ((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 45))
    new = m.raw("part").filter(~old)
    return unique_slugs(new.select("p_partkey", "p_name"), "p_name", "p_partkey", _old_slugs(m))


@query
def slugs_any_script(m: Model) -> DataFrame:
    """The beginnings of documents in four languages as names."""
    names = m.raw("documents").select("doc_id", F.substring("text", 1, 12).alias("name"))
    return unique_slugs(names, "name", "doc_id")


@query
def slugs_hot_base(m: Model) -> DataFrame:
    """Most parts have one name, whose slugs are taken without a gap from the bare one on."""
    parts = m.raw("part")
    name = F.when(F.col("p_size") > 5, "Lamp").otherwise(F.col("p_name"))
    taken = parts.select(F.concat(F.lit("lamp-"), F.col("p_partkey") + 1).alias("slug"))
    bare = parts.limit(1).select(F.lit("lamp").alias("slug"))
    return unique_slugs(parts.select("p_partkey", name.alias("name")), "name", "p_partkey", taken.unionByName(bare))


@query
def category_tree(m: Model) -> DataFrame:
    return catalog.category_levels(m.categories())


@query
def category_parent_names(m: Model) -> DataFrame:
    return catalog.with_parent_name(m.categories()).select("id", "category_name", "category_id", "parent_name")


@query
def category_rows(m: Model) -> DataFrame:
    """New categories from suppliers' nations, hung under existing ones by draw."""
    nation = m.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("category_name"))
    names = m.raw("supplier").join(nation, "s_nationkey").select("s_suppkey", "category_name")
    existing = m.categories().withColumn("slug", base_slug(F.col("category_name")))
    return catalog.new_categories(names, "s_suppkey", existing, SEED, prefix="Small")


@query
def categories_given(m: Model) -> DataFrame:
    """Suppliers' nations as categories under given parents; some have none, and some ask for one that is not there."""
    nation = m.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("category_name"))
    key = F.col("s_suppkey")
    parent = F.when(key % 3 == 0, key % 40).when(key % 3 == 1, key + 1_000_000_000)
    rows = m.raw("supplier").join(nation, "s_nationkey").select("s_suppkey", "category_name", parent.alias("category_id"))
    existing = m.categories().withColumn("slug", base_slug(F.col("category_name")))
    return catalog.given_categories(rows, "s_suppkey", existing, AS_OF)


@query
def category_intervals(m: Model) -> DataFrame:
    return tree_intervals(m.categories())


@query
def category_rollup(m: Model) -> DataFrame:
    """Pieces and lines sold in each category and all below it."""
    sold = m.raw("lineitem").select(
        F.col("l_partkey").alias("category_id"), F.col("l_quantity").cast("long").alias("pieces"), F.lit(1).cast("long").alias("lines")
    )
    return catalog.category_rollup(m.categories(), sold, ["pieces", "lines"])


@query
def name_prefix(m: Model) -> DataFrame:
    return catalog.parent_candidates(m.categories(), "Small").select("id", "category_name")


@query
def product_values(m: Model) -> DataFrame:
    brands = m.raw("supplier").select(F.col("s_suppkey").alias("id"))
    drawn = catalog.draw_product_values(m.raw("part").select("p_partkey"), ["p_partkey"], m.categories(), brands, SEED)
    return drawn


def _tags(m: Model) -> tuple[DataFrame, DataFrame]:
    pairs = m.event_tags()
    old = pairs.filter("event_type = 'purchase'").select("product_id", "tag_id").distinct()
    return pairs.filter("event_type <> 'purchase'").select("event_id", "product_id", "tag_id"), old


@query
def tag_cap(m: Model) -> DataFrame:
    new, old = _tags(m)
    return catalog.associate_tags(new, "event_id", old, cap=18, mode=STRICT)


@query
def tag_cap_reference(m: Model) -> DataFrame:
    new, old = _tags(m)
    return catalog.associate_tags(new, "event_id", old, cap=18, mode=REFERENCE)


def _tag_batches(m: Model) -> tuple[DataFrame, DataFrame]:
    new, old = _tags(m)
    return new.withColumn("batch", F.floor(F.col("event_id") / 20)), old


@query
def tag_cap_by_batch(m: Model) -> DataFrame:
    """Batches of twenty events, each with the tags there that those before it left."""
    new, old = _tag_batches(m)
    return catalog.associate_tags(new, "event_id", old, cap=18, mode=REFERENCE, batch="batch")


@query
def tag_cap_by_batch_strict(m: Model) -> DataFrame:
    new, old = _tag_batches(m)
    return catalog.associate_tags(new.withColumn("batch", -F.col("batch")), "event_id", old, cap=18, mode=STRICT, batch="batch")


@query
def tags_drawn(m: Model) -> DataFrame:
    """Drawn pairs, capped at five per product, one tag per product already there."""
    brands = m.raw("supplier").select(F.col("s_suppkey").alias("id"))
    products = m.products().select("id")
    old = m.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_size").cast("bigint").alias("tag_id"))
    drawn = catalog.draw_tags(m.raw("events").select("event_id"), "event_id", products, brands, SEED)
    return catalog.associate_tags(drawn, "event_id", old, mode=STRICT)


@query
def tags_per_product(m: Model) -> DataFrame:
    return catalog.tags_per_product(m.event_tags())


@query
def distinct_names(m: Model) -> DataFrame:
    return distinct_up_to(m.raw("part"), "p_name", 50)


# Geography


@query
def provinces_from_file(m: Model) -> DataFrame:
    """States of the places file; those of region 2 are provinces already."""
    nation = m.raw("nation").filter("n_regionkey = 2")
    old = nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("province_name"))
    return geo.new_provinces(m.places(), old)


def _provinces(m: Model) -> DataFrame:
    return m.raw("nation").filter("n_regionkey <> 1").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("province_name")
    )


@query
def geo_cities(m: Model) -> DataFrame:
    return geo.new_cities(m.places(), _provinces(m))


@query
def geo_cities_from_csv(m: Model) -> DataFrame:
    """The places written as one CSV in order of longitude, read back; first place wins."""
    path = scratch_path(m.spark, "places")
    m.places().repartitionByRange("lng").sortWithinPartitions("lng").write.option("header", True).csv(path)
    places = read_csv(m.spark, path, "city string, state_name string, lat double, lng double", position=True)
    old = _provinces(m).select(F.col("id").alias("province_id"), F.lit("MACHINERY").alias("city_name"))
    cities = geo.new_cities(places, _provinces(m), old.withColumn("id", F.lit(100)), POSITION)
    return cities.select("city_name", "province_id", "latitude", "longitude")


@query
def places_with_null_tokens(m: Model) -> DataFrame:
    """The places written as one CSV, in which a dash of nations and numbers is spelled as no value."""
    path = scratch_path(m.spark, "places")
    key = F.col("lng").cast("long")
    tokens = F.array(*[F.lit(t) for t in ("NA", "NaN", "", "null", "#N/A", "na", "Na")])
    token = F.element_at(tokens, (key % 7 + 1).cast("int"))
    rows = m.places().select(
        "city",
        F.when(key % 5 == 0, token).otherwise(F.col("state_name")).alias("state_name"),
        F.when((key % 10 == 0) & (key % 7 < 5), token).otherwise(F.col("lat").cast("string")).alias("lat"),
        "lng",
    )
    rows.write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(path)
    places = read_csv(m.spark, path, "city string, state_name string, lat double, lng double")
    return places.groupBy("state_name").agg(F.count(F.lit(1)).alias("places"), F.count("lat").alias("located"))


@query
def address_attach(m: Model) -> DataFrame:
    return geo.attach_addresses(m.users(), m.addresses(), m.cities(), SEED)


@query
def addresses_given(m: Model) -> DataFrame:
    """Users without an address get one in their own nation."""
    people = m.raw("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        F.when(F.col("c_acctbal") > 0, "office").otherwise("home").alias("title"),
        F.col("c_name").alias("street"),
        F.col("c_mktsegment").alias("unit"),
    )
    return geo.given_addresses(people, m.addresses(), m.cities(), AS_OF, m.addresses())


# Samples and keys


@query
def seeded_sample(m: Model) -> DataFrame:
    pending = m.raw("orders").filter(F.col("o_orderstatus") == "P")
    return sample_rows(pending, 10, ["o_orderkey"], SEED).select("o_orderkey", "o_custkey")


@query
def seeded_baskets(m: Model) -> DataFrame:
    items = m.products().filter("product_quantity > 0").select(F.col("id").alias("product_id"))
    return baskets(m.raw("orders"), "o_orderkey", items, ["product_id"], SEED)


@query
def surrogate_keys(m: Model) -> DataFrame:
    existing = m.raw("part").select(F.col("p_partkey").alias("id"))
    return with_surrogate_key(m.raw("customer").select("c_name"), ["c_name"], "id", existing)


@query
def surrogate_keys_strided(m: Model) -> DataFrame:
    existing = m.raw("part").select(F.col("p_partkey").alias("id"))
    return with_surrogate_key(m.raw("orders").select("o_orderkey"), ["o_orderkey"], "id", existing)


# Promotions


@query
def active_at(m: Model) -> DataFrame:
    rows = m.raw("events").select("event_id", F.col("ts").alias("expired_at"))
    return promotions.active_at(rows, "2024-01-15 00:00:00")


@query
def active_at_each(m: Model) -> DataFrame:
    """Every event with each discount that runs at its time."""
    moments = m.raw("events").select("event_id", "ts")
    found = promotions.active_at_each(moments, "ts", m.flash_discounts(), window=True)
    return found.select("event_id", F.col("id").alias("discount_id"))


@query
def active_discounts(m: Model) -> DataFrame:
    return promotions.active_at(m.discounts(), "2024-01-15 00:00:00", window=True)


@query
def discount_terms(m: Model) -> DataFrame:
    return m.discounts()


@query
def campaign_windows(m: Model) -> DataFrame:
    ids = m.raw("orders").select(F.col("o_orderkey").alias("id"))
    return promotions.with_campaign_window(ids, ["id"], AS_OF, SEED)


# Writes


_LINE_KEY = ["l_orderkey", "l_linenumber"]


def _line_order(df: DataFrame) -> list[str]:
    return ["l_shipdate", *[c for c in df.columns if c != "l_shipdate"]]


@query
def insert_ignore(m: Model) -> DataFrame:
    """Open lines are there; of the finished ones, those with a new key go in, earliest first."""
    lines = m.raw("lineitem")
    there, batch = lines.filter(F.col("l_linestatus") == "O"), lines.filter(F.col("l_linestatus") == "F")
    return upserts.insert_new(batch, there, _LINE_KEY, _line_order(lines))


@query
def insert_ignore_rejected(m: Model) -> DataFrame:
    orders_ = m.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    there = orders_.filter(F.col("o_orderdate") < as_of_column("1996-01-01"))
    batch = orders_.filter(F.col("o_orderdate") >= as_of_column("1996-01-01"))
    inserted = upserts.insert_new(batch, there, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return upserts.rejected(batch, inserted, ["o_orderkey"])


@query
def update_by_key(m: Model) -> DataFrame:
    """Customers take the segment drawn for their latest order."""
    updates = m.raw("orders").select(
        F.col("o_custkey").alias("c_custkey"),
        draw_choice(SEED, ["GARDEN", "KITCHEN"], "o_orderkey").alias("c_mktsegment"),
        "o_orderdate",
        "o_orderkey",
    )
    return upserts.update_by_key(m.raw("customer"), updates, "c_custkey", ["c_mktsegment"], ["o_orderdate", "o_orderkey"])


@query
def seeds_if_empty(m: Model) -> DataFrame:
    """Roles are seeded for the users of a segment that nobody is in, not for one in use."""
    nobody = m.raw("customer").filter(F.col("c_mktsegment") == "NOBODY")
    somebody = m.raw("customer").filter(F.col("c_mktsegment") == "BUILDING")
    first = seed_if_empty(m.seeds("roles"), nobody).withColumn("target", F.lit("empty"))
    return first.unionByName(seed_if_empty(m.seeds("roles"), somebody).withColumn("target", F.lit("used")))


# Audits


@query
def audit_unique(m: Model) -> DataFrame:
    return audit.duplicate_keys(m.raw("lineitem"), _LINE_KEY)


@query
def audit_unique_together(m: Model) -> DataFrame:
    """Three keys of the lines, the table read twice."""
    keys = [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]]
    found = audit.duplicate_keys_of(m.raw("lineitem"), keys)
    return found.select("columns", F.concat_ws("|", "key").alias("key"), "rows")


@query
def audit_fk(m: Model) -> DataFrame:
    """Orders as references into lines: the orders without a line."""
    return audit.orphans(m.raw("orders"), "o_orderkey", m.raw("lineitem").select("l_orderkey"), "l_orderkey")


@query
def audit_domain(m: Model) -> DataFrame:
    rows = m.raw("events")
    return rows.filter(audit.breaks_domain(F.col("event_type"), ("view", "click", "purchase"))).select("event_id", "event_type")


@query
def audit_not_null(m: Model) -> DataFrame:
    """Documents without a label have no quality."""
    labelled = m.raw("documents").select("doc_id").join(m.raw("labels"), "doc_id", "left")
    return labelled.filter(audit.breaks_not_null(F.col("quality"))).select("doc_id")


@query
def audit_length(m: Model) -> DataFrame:
    rows = m.raw("documents")
    return rows.filter(audit.breaks_length(F.col("text"), 500)).select("doc_id", F.char_length("text").alias("length"))


@query
def audit_decimal(m: Model) -> DataFrame:
    rows = m.raw("orders").withColumn("amount", F.col("o_totalprice"))
    return rows.filter(audit.breaks_decimal(F.col("amount"), 7, 2)).select("o_orderkey", "amount")


@query
def audit_totals(m: Model) -> DataFrame:
    """Line price, tax and discount against a total that forgets the discount of some lines."""
    price, zero = F.col("l_extendedprice").cast("decimal(15,2)"), F.lit(0).cast("decimal(15,2)")
    discount = (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(15,2)")
    lines = m.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        price.alias("order_amount"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(15,2)").alias("tax_amount"),
        discount.alias("discount_amount"),
        F.when(F.col("l_returnflag") == "R", zero).otherwise(discount).alias("forgotten"),
    )
    rows = lines.withColumn(
        "total_amount", (F.col("order_amount") + F.col("tax_amount") - F.col("forgotten")).cast("decimal(15,2)")
    )
    return audit.wrong_totals(rows).select("l_orderkey", "l_linenumber", "total_amount")


@query
def audit_report(m: Model) -> DataFrame:
    """All rules of the users, products and orders tables, counted."""
    people = m.users().select(
        "id", "username", F.col("unit").alias("email"), F.when(F.col("unit") != "BUILDING", F.col("username")).alias("mobile")
    )
    goods = m.products().select(
        "id",
        F.when(F.col("product_quantity") > 0, F.col("product_name")).alias("product_name"),
        (F.col("product_price") * 1000).alias("product_price"),
        (F.col("product_tax") * 10).alias("product_tax"),
        "product_quantity",
        (F.col("id") + 1).alias("category_id"),
    )
    frames = {"users": people, "products": goods, "orders": m.orders(), "discounts": m.discounts()}
    parents = {"categories": m.categories(), "orderstatus": m.seeds("orderstatus"), "adscampaigns": m.campaigns()}
    return audit.audit_together(frames | parents, list(frames))


@query
def defaults_filled(m: Model) -> DataFrame:
    """Lines of orders with an odd history: quantities and costs missing."""
    table = TABLES["orderdetails"]
    lines = m.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int")).alias("quantity"),
    )
    return audit.fill_defaults(lines, table, as_of_column(AS_OF))


@query
def stored_types(m: Model) -> DataFrame:
    """Event values and times as the transactions table stores them."""
    table = Table("values", (Column("amount", "decimal(15,1)"), Column("created_at", "timestamp(0)")))
    rows = m.raw("events").select("event_id", F.col("value").cast("decimal(15,2)").alias("amount"), F.col("ts").alias("created_at"))
    return audit.stored(rows, table)


# Change feed


ROW = ["order_status_id", "total_amount", "updated_at"]


def _changes(m: Model, columns: list[str] = ROW) -> DataFrame:
    return envelope.decode(m.feed(), TABLES["orders"], columns)


@query
def cdc_decode(m: Model) -> DataFrame:
    return _changes(m)


@query
def cdc_times(m: Model) -> DataFrame:
    """All three times of an order, as they come in milliseconds."""
    rows = m.raw("events").select(
        F.col("user_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "purchase", plus_days(F.col("ts"), F.lit(2))).alias("shipped_at"),
        F.col("ts").alias("updated_at"),
        "event_id",
        "ts",
    )
    raw = envelope.encode(rows, TABLES["orders"], F.lit("u"), F.col("event_id"), F.col("ts"))
    return envelope.decode(raw, TABLES["orders"], ["created_at", "shipped_at", "updated_at"])


@query
def cdc_rejects(m: Model) -> DataFrame:
    """The feed, and among it every record cut off, every update with an operation that is none, and
    records with an amount or a status that cannot be one."""
    value = F.col("value")

    def spoiled(pattern: str, by: str) -> Expression:
        return F.regexp_replace("value", pattern, by)

    bad = [
        spoiled('"op":"u"', '"op":"x"'),
        spoiled('"after.total_amount":"[^"]*"', '"after.total_amount":"abc"'),
        spoiled('"after.total_amount":"[^"]*"', '"after.total_amount":"12345678901234567.89"'),
        spoiled('"after.order_status_id":[0-9]+', '"after.order_status_id":"x"'),
        spoiled('"source.ts_ms":[0-9]+', '"source.ts_ms":9000000000000000000'),
    ]
    # The feed is read and encoded once for all of them.
    of_update = F.when(value.contains('"op":"u"'), F.array(*bad)).otherwise(F.array().cast("array<string>"))
    each = F.concat(F.array(value, F.substring("value", 1, 20)), of_update)
    whole, columns = m.feed().select(F.explode(each).alias("value")), ["order_status_id", "total_amount"]
    left = envelope.decode(whole, TABLES["orders"], columns).agg(F.count(F.lit(1)).alias("records"))
    return envelope.reject_counts(whole, TABLES["orders"], columns).unionByName(left.select(F.lit("none").alias("reason"), "records"))


@query
def cdc_flatten(m: Model) -> DataFrame:
    nested = m.raw("events").select(
        F.struct(F.col("user_id").alias("id"), F.struct("value").alias("amounts")).alias("after"),
        F.struct(F.col("event_id").alias("lsn")).alias("source"),
        F.lit("u").alias("op"),
    )
    flat = envelope.flatten(nested)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@query
def latest_state(m: Model) -> DataFrame:
    return state.current_state(_changes(m))


@query
def status_history(m: Model) -> DataFrame:
    return history.status_history(_changes(m, [history.STATUS]))


@query
def first_visits(m: Model) -> DataFrame:
    return history.first_visits(history.status_changes(_changes(m, [history.STATUS])))


@query
def history_with_deletes(m: Model) -> DataFrame:
    """Two statuses only, so that most orders come back from a delete with the one they had."""
    changes = _changes(m, [history.STATUS]).withColumn(history.STATUS, F.col(history.STATUS) % 2)
    return history.status_history(changes)


@query
def history_stored(m: Model) -> DataFrame:
    """First visits as rows of the history table, for orders with staff."""
    staff = m.raw("customer").filter("c_custkey % 3 > 0").select(
        F.col("c_custkey").alias("order_id"), (F.col("c_custkey") % 7).alias("staff_id")
    )
    return history.history_rows(history.status_changes(_changes(m, [history.STATUS])), staff, AS_OF)


def _feed_folder(m: Model, files: int = 1, twice: bool = False) -> str:
    """The feed as files of JSON lines; ``twice`` with every record in two files, in no order."""
    path = scratch_path(m.spark, "feed")
    raw = m.feed()
    if twice:
        raw = raw.unionByName(raw.withColumn("value", F.concat("value", F.lit(" ")))).repartition(files, F.md5("value"))
    elif files > 1:
        raw = raw.repartition(files, F.md5("value"))
    raw.write.text(path)
    return path


@query
def cdc_repeats(m: Model) -> DataFrame:
    """Every record twice and out of order, over several triggers."""
    raw = feed.feed_file_stream(m.spark, _feed_folder(m, 6, twice=True), max_files=2)
    target = scratch_path(m.spark, "changes")
    changes = envelope.decode(raw, TABLES["orders"], ["order_status_id", "total_amount"])
    state.write_changes(changes, target, scratch_path(m.spark, "changes-log")).awaitTermination()
    return state.without_repeats(read_batches(m.spark, target).drop("batch_id"))


@query
def cdc_log_once(m: Model) -> DataFrame:
    """Every record twice and out of order, over several triggers and a restart: the log has each once."""
    source, target, log = _feed_folder(m, 4, twice=True), scratch_path(m.spark, "changes"), scratch_path(m.spark, "changes-log")
    for _ in range(2):
        raw = feed.feed_file_stream(m.spark, source, max_files=2)
        changes = envelope.decode(raw, TABLES["orders"], ["order_status_id", "total_amount"])
        repeats.write_once(changes, target, log).awaitTermination()
    return read_batches(m.spark, target).drop("batch_id")


@query
def cdc_snapshot_and_log(m: Model) -> DataFrame:
    """Orders read in eight chunks while the log goes on; what the log held before the first one is lost."""
    # Read six times below, so decoded once.
    changes = written(_changes(m, ["order_status_id", "total_amount"]), "changes")
    last = changes.agg(F.max("lsn").alias("last"))
    step = F.floor(F.col("last") / 20)
    chunk = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("chunk")
    chunks = last.select("last", chunk).select(
        "chunk",
        (F.col("last") - 2 * step * (8 - F.col("chunk"))).alias("low"),
        (F.col("last") - 2 * step * (8 - F.col("chunk")) + step).alias("high"),
        as_of_column(AS_OF).alias("read_at"),
    )
    chunks = written(chunks, "chunks")
    # The table as it was half way through the reading of each chunk.
    of_chunk = changes.withColumn("chunk", F.pmod("id", F.lit(8))).join(chunks, "chunk")
    seen = of_chunk.filter(F.col("lsn") <= (F.col("low") + F.col("high")) / 2).select(*changes.columns, "chunk")
    rows = state.current_state(seen).select("id", "chunk", "order_status_id", "total_amount")
    begin = chunks.agg(F.min("low").alias("low")).scalar()
    whole = handover.with_snapshot(changes.filter(F.col("lsn") > begin), rows, chunks)
    return state.current_state(whole).select("id", "order_status_id", "total_amount")


def _totals(m: Model, mode: str) -> DataFrame:
    """Lines that change, go and move between orders, in no order over several triggers."""
    source, target = scratch_path(m.spark, "feed"), scratch_path(m.spark, "totals")
    m.line_feed().repartition(3, F.md5("value")).write.text(source)
    raw = feed.feed_file_stream(m.spark, source, max_files=1)
    changes = envelope.decode(raw, TABLES["orderdetails"], totals.LINE)
    totals.write_totals(changes, target, scratch_path(m.spark, "totals-log"), mode).awaitTermination()
    return totals.read_totals(m.spark, target)


@query
def cdc_order_totals(m: Model) -> DataFrame:
    return _totals(m, REFERENCE)


@query
def cdc_order_totals_strict(m: Model) -> DataFrame:
    return _totals(m, STRICT)


@query
def cdc_orphans(m: Model) -> DataFrame:
    """Orders whose user is gone, followed over several triggers in no order."""
    source, target = scratch_path(m.spark, "feed"), scratch_path(m.spark, "references")
    m.reference_feed().repartition(3, F.md5("value")).write.text(source)
    raw = feed.feed_file_stream(m.spark, source, max_files=1)
    tables = [TABLES["users"], TABLES["orders"]]
    references.write_references(raw, tables, target, scratch_path(m.spark, "references-log")).awaitTermination()
    return references.read_orphans(m.spark, target).filter("rule = 'orders.user_id'").select(F.col("key").alias("user_id"), "rows")


@query
def cdc_history_merged(m: Model) -> DataFrame:
    """Every record twice and out of order, over several triggers; intervals are kept, not derived."""
    raw = feed.feed_file_stream(m.spark, _feed_folder(m, 3, twice=True), max_files=1)
    target = scratch_path(m.spark, "history")
    changes = envelope.decode(raw, TABLES["orders"], [history.STATUS])
    history.write_intervals(changes, target, scratch_path(m.spark, "history-log")).awaitTermination()
    return history.read_intervals(m.spark, target)


@query
def cdc_state_compacted(m: Model) -> DataFrame:
    """The state after several triggers and a restart, reduced on the way."""
    source, target, log = _feed_folder(m, 5), scratch_path(m.spark, "state"), scratch_path(m.spark, "state-log")
    for _ in range(2):
        changes = envelope.decode(feed.feed_file_stream(m.spark, source, max_files=1), TABLES["orders"], ["order_status_id", "total_amount"])
        state.write_state(changes, target, log, every=2).awaitTermination()
    return state.read_state(m.spark, target)


@query
def cdc_stream_state(m: Model) -> DataFrame:
    raw = feed.feed_file_stream(m.spark, _feed_folder(m))
    target = scratch_path(m.spark, "state")
    changes = envelope.decode(raw, TABLES["orders"], ["order_status_id", "total_amount"])
    state.write_state(changes, target, scratch_path(m.spark, "state-log")).awaitTermination()
    return state.read_state(m.spark, target)


@query
def cdc_stream_history(m: Model) -> DataFrame:
    """Records in no order, over several triggers: late ones count."""
    raw = feed.feed_file_stream(m.spark, _feed_folder(m, 4), max_files=1)
    target = scratch_path(m.spark, "history")
    changes = envelope.decode(raw, TABLES["orders"], [history.STATUS])
    history.write_status_log(changes, target, scratch_path(m.spark, "history-log")).awaitTermination()
    return history.read_history(m.spark, target)


@query
def cdc_stream_status_log(m: Model) -> DataFrame:
    raw = feed.feed_file_stream(m.spark, _feed_folder(m))
    target = scratch_path(m.spark, "statuses")
    changes = envelope.decode(raw, TABLES["orders"], [history.STATUS])
    history.write_status_log(changes, target, scratch_path(m.spark, "statuses-log")).awaitTermination()
    return history.read_history(m.spark, target)


@query
def cdc_routed(m: Model) -> DataFrame:
    """Order changes and part rows in one feed, taken apart by table, then decoded."""
    parts = m.products().select("id", "product_name", "product_price", "product_quantity")
    at = as_of_column(AS_OF)
    lines = m.feed().unionByName(envelope.encode(parts, TABLES["products"], F.lit("r"), F.col("id"), at))
    source, target = scratch_path(m.spark, "feed"), scratch_path(m.spark, "routed")
    lines.write.text(source)
    stream = feed.feed_file_stream(m.spark, source)
    routing.route_by_table(stream, target, scratch_path(m.spark, "routed-log")).awaitTermination()
    found = []
    for table, amount in (("products", "product_price"), ("orders", "total_amount")):
        changes = envelope.decode(routing.routed(m.spark, target, table), TABLES[table], [amount])
        found.append(changes.select(F.lit(table).alias("table_name"), "id", "op", "lsn", "changed_at", F.col(amount).alias("amount")))
    return reduce(DataFrame.unionByName, found)


@query
def times_to_second(m: Model) -> DataFrame:
    return m.raw("events").select("event_id", to_second(F.col("ts")).alias("second"))
