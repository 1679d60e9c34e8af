from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartlane.modes import REFERENCE, STRICT
from cartlane.operators import orders, payments
from cartlane.operators.promotions import active_at, with_campaign_window, with_discount_terms
from cartlane.schemas import STATUS_AFTER_FAILURE, STATUS_AFTER_SUCCESS
from cartlane.sources.tables import seed_table
from tests.conftest import rows

AS_OF = "2024-03-01 12:00:00"
LINE = "order_id long, quantity int, product_price decimal(15,2), product_tax decimal(4,2)"


@pytest.fixture(scope="module")
def lines(spark):
    data = [(1, 2, D("10.00"), D("7.50")), (1, 3, D("0.99"), D("20.00")), (2, 1, D("99.95"), D("0.00"))]
    return spark.createDataFrame(data, LINE)


def test_totals_count_the_tax_of_one_piece(lines):
    assert rows(orders.order_totals(lines)) == [
        (1, D("22.97"), D("0.95"), D("23.92")),
        (2, D("99.95"), D("0.00"), D("99.95")),
    ]


def test_strict_totals_count_the_tax_of_all_pieces(lines):
    assert rows(orders.order_totals(lines, mode=STRICT))[0] == (1, D("22.97"), D("2.09"), D("25.06"))


def test_totals_are_rounded_once(spark):
    # Two taxes of 0.004 are 0.008, a cent; each rounded first they would be nothing.
    data = [(1, 1, D("0.04"), D("10.00")), (1, 1, D("0.04"), D("10.00"))]
    assert rows(orders.order_totals(spark.createDataFrame(data, LINE))) == [(1, D("0.08"), D("0.01"), D("0.09"))]


def test_totals_of_nothing(lines):
    assert rows(orders.order_totals(lines.limit(0))) == []


def test_unknown_mode(lines):
    with pytest.raises(ValueError):
        orders.order_totals(lines, mode="loose")


@pytest.mark.parametrize("stock, quantity", [(0, 1), (1, 1), (19, 1), (20, 2), (30, 3), (99, 9), (100, 10)])
def test_quantity_is_a_tenth_of_the_stock(spark, stock, quantity):
    product = spark.createDataFrame([(1, D("10.00"), D("5.00"), stock)], "id long, product_price decimal(15,2), product_tax decimal(4,2), product_quantity int")
    reference = orders.price_lines(product, ["id"], "s").first()
    strict = orders.price_lines(product, ["id"], "s", STRICT).first()
    assert reference["quantity"] == quantity
    assert reference["subtotal_amount"] == D("0.50") * quantity
    assert strict["subtotal_amount"] == D("10.00") * quantity
    assert D("5.00") <= reference["unit_cost"] <= D("9.00")


def test_pricing_needs_no_shuffle(spark):
    product = spark.createDataFrame([(1, D("10.00"), D("5.00"), 3)], "id long, product_price decimal(15,2), product_tax decimal(4,2), product_quantity int")
    assert "Exchange" not in orders.price_lines(product, ["id"], "s")._jdf.queryExecution().executedPlan().toString()


def discounts(spark, data):
    schema = "id long, type string, value decimal(15,2), started_at string, expired_at string"
    df = spark.createDataFrame(data, schema)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "expired_at")})


def discounted(spark, kind, value, mode, amount="50.00"):
    table = discounts(spark, [(7, kind, D(value), "2024-02-01", "2024-04-01")])
    data = [(i, D(amount), D("1.00")) for i in range(400)]
    df = spark.createDataFrame(data, "id long, order_amount decimal(15,2), tax_amount decimal(15,2)")
    found = orders.stored_amounts(orders.apply_discounts(df, ["id"], table, AS_OF, "s", mode)).collect()
    with_one = [r for r in found if r["discount_id"] is not None]
    assert len(found) == 400 and 110 < len(with_one) < 180
    assert all(r["discount_amount"] == 0 and r["total_amount"] == D(amount) + 1 for r in found if r["discount_id"] is None)
    amounts = {(r["discount_amount"], r["total_amount"]) for r in with_one}
    assert len(amounts) == 1
    return amounts.pop()


def test_percent_discount(spark):
    assert discounted(spark, "percent", "15", REFERENCE) == (D("7.50"), D("43.50"))
    assert discounted(spark, "percent", "15", STRICT) == (D("7.50"), D("43.50"))


def test_amount_discount_in_both_modes(spark):
    assert discounted(spark, "amount", "20", REFERENCE) == (D("30.00"), D("21.00"))
    assert discounted(spark, "amount", "20", STRICT) == (D("20.00"), D("31.00"))
    assert discounted(spark, "amount", "80", REFERENCE) == (D("-30.00"), D("81.00"))
    assert discounted(spark, "amount", "80", STRICT) == (D("50.00"), D("1.00"))


def test_no_valid_discount_means_none(spark):
    table = discounts(spark, [(7, "percent", D("10"), "2024-01-01", "2024-02-01")])
    df = spark.createDataFrame([(i, D("5.00")) for i in range(50)], "id long, order_amount decimal(15,2)")
    found = orders.apply_discounts(df, ["id"], table, AS_OF, "s")
    assert found.filter("discount_id IS NULL AND discount_amount = 0").count() == 50


def test_valid_discounts_in_both_readings(spark):
    data = [
        (1, "percent", D("1"), "2024-02-01", "2024-04-01"),
        (2, "percent", D("1"), "2024-03-05", "2024-04-01"),
        (3, "percent", D("1"), "2024-02-01", "2024-03-01 12:00:00"),
        (4, "percent", D("1"), "2024-02-01", None),
    ]
    table = discounts(spark, data)
    assert rows(active_at(table, AS_OF), "id") == [(1,), (2,)]
    assert rows(active_at(table, AS_OF, window=True), "id") == [(1,)]


def test_windows_and_terms_stay_in_range(spark):
    ids = spark.range(600)
    windows = with_campaign_window(ids, ["id"], AS_OF, "s").selectExpr(
        "datediff(date'2024-03-01', started_at) AS age", "datediff(expired_at, started_at) AS days"
    )
    assert windows.agg(F.min("age"), F.max("age"), F.min("days"), F.max("days")).first() == (1, 30, 1, 10)
    terms = with_discount_terms(ids, ["id"], spark.range(3), AS_OF, "s")
    kinds = {r["type"]: r for r in terms.groupBy("type").agg(F.min("value").alias("a"), F.max("value").alias("b")).collect()}
    assert set(kinds) == {"percent", "amount"}
    assert 1 <= kinds["percent"]["a"] and kinds["percent"]["b"] <= 100
    assert 1 <= kinds["amount"]["a"] and 100 < kinds["amount"]["b"] <= 1000
    assert {r[0] for r in terms.select("adscampaign_id").distinct().collect()} == {None, 0, 1, 2}


def market(spark, addresses=((10, 1), (9, 1), (11, 2)), staff=(5, 6), stock=(30, 40, 0)):
    """Users 1 to 4 are customers, 5 and 6 may be staff; users 1 and 2 have addresses."""
    role_user = [(4, u) for u in range(1, 5)] + [(2, u) for u in staff]
    return dict(
        users=spark.range(1, 7),
        role_user=spark.createDataFrame(role_user, "role_id long, user_id long"),
        roles=seed_table(spark, "roles"),
        addresses=spark.createDataFrame(list(addresses), "id long, user_id long"),
        products=spark.createDataFrame(
            [(100 + i, D("10.00"), D("10.00"), s) for i, s in enumerate(stock)],
            "id long, product_price decimal(15,2), product_tax decimal(4,2), product_quantity int",
        ),
        discounts=discounts(spark, [(1, "percent", D("50"), "2024-02-01", "2024-04-01")]),
        statuses=seed_table(spark, "orderstatus"),
        payment_methods=seed_table(spark, "paymentmethods"),
        shipping_methods=seed_table(spark, "shippingmethods"),
        as_of=AS_OF,
        seed="s",
    )


def test_assembled_orders_hold_together(spark):
    requests = spark.range(300).withColumnRenamed("id", "req")
    existing = spark.createDataFrame([(1000,)], "id long")
    made = orders.assemble_orders(requests, "req", existing_orders=existing, **market(spark))
    heads = {r["id"]: r for r in made.orders.collect()}
    lines = made.lines.collect()
    assert 100 < len(heads) < 200 and min(heads) > 1000
    assert {r["user_id"] for r in heads.values()} == {1, 2}
    assert {(r["user_id"], r["address_id"]) for r in heads.values()} == {(1, 9), (2, 11)}
    assert {r["staff_id"] for r in heads.values()} == {5, 6}
    assert {r["order_status_id"] for r in heads.values()} == {1}
    assert all(r["payment_status_id"] is None and r["shipped_at"] is None for r in heads.values())
    assert {r["order_id"] for r in lines} == set(heads)
    assert {r["product_id"] for r in lines} == {100, 101}
    for key, head in heads.items():
        mine = [r for r in lines if r["order_id"] == key]
        assert head["order_amount"] == sum(r["quantity"] * r["product_price"] for r in mine)
        assert head["tax_amount"] == len(mine) * D("1.00")
        assert head["total_amount"] == head["order_amount"] + head["tax_amount"] - head["discount_amount"]
        assert (head["discount_id"] is None) == (head["discount_amount"] == 0)
    again = orders.assemble_orders(requests.repartition(7), "req", existing_orders=existing, **market(spark))
    assert rows(again.orders) == rows(made.orders)


def test_saved_orders_are_the_assembled_ones(spark, tmp_path):
    requests = spark.range(60).withColumnRenamed("id", "req")
    made = orders.assemble_orders(requests, "req", **market(spark))
    heads, lines = str(tmp_path / "o"), str(tmp_path / "l")
    for _ in range(2):
        orders.save_orders(requests, "req", heads, lines, 3, **market(spark))
    assert rows(spark.read.parquet(heads).drop("batch_id")) == rows(made.orders)
    assert rows(spark.read.parquet(lines).drop("batch_id")) == rows(made.lines)


@pytest.mark.parametrize("lack", [{"addresses": ((1, 5),)}, {"staff": ()}, {"stock": (0, 0)}])
def test_no_order_without_address_staff_or_stock(spark, lack):
    requests = spark.range(20).withColumnRenamed("id", "req")
    made = orders.assemble_orders(requests, "req", **market(spark, **lack))
    assert made.orders.count() == 0 and made.lines.count() == 0


def stored_orders(spark):
    data = [(i, D("10.00") * i, 1, "2024-01-01 00:00:00") for i in range(1, 41)]
    df = spark.createDataFrame(data, "id long, total_amount decimal(15,2), order_status_id long, updated_at string")
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def test_transactions(spark):
    requests = spark.createDataFrame([(3,), (4,), (99,), (None,)], "order_id long")
    made = payments.make_transactions(stored_orders(spark), requests, "s")
    assert rows(made, "order_id", "transaction_type", "amount") == [(3, "payment", D("30.00")), (4, "payment", D("40.00"))]
    assert made.filter("order_id = 3").first()["description"].endswith("order #3")
    all_of_them = payments.make_transactions(stored_orders(spark), stored_orders(spark).select(F.col("id").alias("order_id")), "s")
    assert {r["status"] for r in all_of_them.collect()} == {True, False}


def test_status_after_payment(spark):
    made = spark.createDataFrame([(i, i % 2 == 0) for i in range(200)], "order_id long, status boolean")
    reference = payments.status_after_payment(made, "s").collect()
    assert {r["order_status_name"] for r in reference} == set(STATUS_AFTER_SUCCESS)
    strict = payments.status_after_payment(made, "s", STRICT).collect()
    assert {r["order_status_name"] for r in strict if r["id"] % 2 == 0} == set(STATUS_AFTER_SUCCESS)
    assert {r["order_status_name"] for r in strict if r["id"] % 2} == set(STATUS_AFTER_FAILURE)


def test_status_change(spark):
    changes = spark.createDataFrame([(1, "Shipped"), (2, "Lost"), (77, "Shipped")], "id long, order_status_name string")
    statuses = seed_table(spark, "orderstatus")
    plain = orders.change_status(stored_orders(spark), changes, statuses)
    assert plain.count() == 40
    assert rows(plain.filter("id <= 3"), "id", "order_status_id") == [(1, 3), (2, 1), (3, 1)]
    assert plain.filter("updated_at > timestamp_ntz'2024-01-01 00:00:00'").count() == 0
    strict = orders.change_status(stored_orders(spark), changes, statuses, AS_OF, STRICT)
    assert [r["id"] for r in strict.filter("updated_at = timestamp_ntz'2024-03-01 12:00:00'").collect()] == [1]
    with pytest.raises(ValueError):
        orders.change_status(stored_orders(spark), changes, statuses, mode=STRICT)


def test_order_costs(spark):
    df = spark.createDataFrame([(1, D("1.25")), (1, D("2.50")), (2, D("3.00"))], "order_id long, unit_cost decimal(15,2)")
    assert rows(orders.order_costs(df)) == [(1, D("3.75")), (2, D("3.00"))]


def test_orders_from_given_picks(spark):
    products = spark.createDataFrame([(1, "10.00", "5.00", 40), (2, "3.00", "0.00", 0)], "id long, p string, t string, product_quantity int")
    products = products.selectExpr("id", "CAST(p AS DECIMAL(15,2)) product_price", "CAST(t AS DECIMAL(4,2)) product_tax", "product_quantity")
    basket = spark.createDataFrame([(7, 1, 1, None), (7, 2, 2, 3), (8, 1, 2, 1)], "order_id long, line_number int, product_id long, quantity int")
    lines = orders.lines_from_picks(basket, products)
    assert rows(lines, "order_id", "product_id", "quantity") == [(7, 1, 4), (7, 2, 3), (8, 2, 1)]
    picks = spark.createDataFrame(
        [(7, 1, 2, 3, 50, 1, 1), (8, 1, 2, 3, 51, 1, 1), (9, 1, 2, 3, None, 1, 1)],
        "id long, user_id long, staff_id long, address_id long, discount_id long, payment_method_id long, shipping_method_id long",
    )
    terms = spark.sql("""SELECT * FROM VALUES (50L, 'percent', CAST(10 AS DECIMAL(15,2)), timestamp_ntz'2000-01-01', timestamp_ntz'2100-01-01'),
        (51L, 'percent', CAST(10 AS DECIMAL(15,2)), timestamp_ntz'2000-01-01', timestamp_ntz'2001-01-01') AS t(id, type, value, started_at, expired_at)""")
    statuses = spark.createDataFrame([(1, "Pending")], "id long, order_status_name string")
    got = orders.orders_from_picks(picks, lines, terms, statuses, AS_OF, STRICT)
    found = [(i, d, *map(str, amounts)) for i, d, *amounts in rows(got, "id", "discount_id", "order_amount", "tax_amount", "discount_amount", "total_amount")]
    assert found == [(7, 50, "49.00", "2.00", "4.90", "46.10"), (8, None, "3.00", "0.00", "0.00", "3.00"), (9, None, "0.00", "0.00", "0.00", "0.00")]


def test_no_job_runs_while_given_orders_are_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        picks = spark.sql("SELECT 1L id, 1L user_id, 1L staff_id, 1L address_id, 1L discount_id, 1L payment_method_id, 1L shipping_method_id")
        products = spark.sql("SELECT 1L id, CAST(1 AS DECIMAL(15,2)) product_price, CAST(1 AS DECIMAL(4,2)) product_tax, 5 product_quantity")
        basket = spark.sql("SELECT 1L order_id, 1 line_number, 1L product_id")
        terms = spark.sql("SELECT 1L id, 'percent' type, CAST(1 AS DECIMAL(15,2)) value, timestamp_ntz'2000-01-01' started_at, timestamp_ntz'2100-01-01' expired_at")
        statuses = spark.sql("SELECT 1L id, 'Pending' order_status_name")
        orders.orders_from_picks(picks, orders.lines_from_picks(basket, products), terms, statuses, AS_OF)
        assert tracker.getJobIdsForGroup("plan") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_status_asked_for_has_to_fit_the_payment(spark):
    paid = spark.createDataFrame(
        [(1, True, "Shipped", 1), (2, False, "Shipped", 2), (3, False, "Cancelled", 3), (4, None, "Pending", 4), (5, True, "Pending", 5)],
        "order_id long, status boolean, next_status string, request_id long",
    )
    assert rows(payments.next_status(paid), "id", "order_status_name") == [(1, "Shipped"), (3, "Cancelled")]
