"""Orders: line prices, totals, discounts, assembly, status."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_chance, draw_decimal
from cartlane.functions.money import discount_amount, line_quantity, line_subtotal, money, tax_sum
from cartlane.functions.times import as_of_column
from cartlane.modes import REFERENCE, STRICT, check_mode
from cartlane.operators.promotions import active_at
from cartlane.operators.upserts import update_by_key
from cartlane.operators.users import users_with_role
from cartlane.plans.assign import assign
from cartlane.plans.keys import with_surrogate_key
from cartlane.plans.samples import baskets
from cartlane.plans.scratch import written
from cartlane.schemas import ROLE_CUSTOMER, ROLE_STAFF, STATUS_PENDING
from cartlane.sources.sinks import batch_start, read_batch, withdraw, write_batch

# Unit cost as a share of the price, and 4 of 11 orders with a discount.
COST_SHARE = ("0.5", "0.9")
DISCOUNT_HITS, DISCOUNT_OF = 4, 11


class Assembled(NamedTuple):
    orders: DataFrame
    lines: DataFrame


def price_lines(items: DataFrame, keys: list[str], seed: str, mode: str = REFERENCE) -> DataFrame:
    """Adds ``quantity``, ``subtotal_amount`` and ``unit_cost`` to rows with a product's
    ``product_price``, ``product_tax`` and ``product_quantity``. No shuffle."""
    share = draw_decimal(seed, *COST_SHARE, 6, *keys)
    price, tax = F.col("product_price"), F.col("product_tax")
    return items.withColumn("quantity", line_quantity(F.col("product_quantity"))).withColumns(
        {
            "subtotal_amount": money(line_subtotal(price, tax, F.col("quantity"), mode)),
            "unit_cost": money(price * share),
        }
    )


def sum_lines(lines: DataFrame, order_key: str, mode: str = REFERENCE) -> DataFrame:
    """Order amount and tax per order, not yet rounded. One shuffle, partial sums first."""
    price, tax, quantity = F.col("product_price"), F.col("product_tax"), F.col("quantity")
    return lines.groupBy(order_key).agg(
        F.sum(quantity * price).alias("order_amount"),
        tax_sum(price, tax, quantity, mode).alias("tax_amount"),
    )


def order_totals(lines: DataFrame, order_key: str = "order_id", mode: str = REFERENCE) -> DataFrame:
    """Amount, tax and total per order, for orders without a discount."""
    sums = sum_lines(lines, order_key, mode)
    return sums.select(
        order_key,
        money(F.col("order_amount")).alias("order_amount"),
        money(F.col("tax_amount")).alias("tax_amount"),
        money(F.col("order_amount") + F.col("tax_amount")).alias("total_amount"),
    )


def order_costs(lines: DataFrame, order_key: str = "order_id") -> DataFrame:
    """The sum of unit costs per order."""
    return lines.groupBy(order_key).agg(money(F.sum("unit_cost")).alias("cost_amount"))


def apply_discounts(
    orders: DataFrame,
    keys: list[str],
    discounts: DataFrame,
    as_of,
    seed: str,
    mode: str = REFERENCE,
) -> DataFrame:
    """Adds ``discount_id`` and ``discount_amount`` (not yet rounded) to rows with an
    ``order_amount``. Some orders draw a discount; it is one of those valid at ``as_of``.

    Reference mode looks at the expiry only; strict mode at the whole window.
    """
    check_mode(mode)
    valid = active_at(discounts, as_of, window=mode == STRICT)
    drawn = assign(
        orders,
        keys,
        valid,
        ["id"],
        {"id": "discount_id", "type": "__type", "value": "__value"},
        seed,
        only_if=draw_chance(f"{seed}-chance", DISCOUNT_HITS, DISCOUNT_OF, *keys),
    )
    amount = discount_amount(F.col("__type"), F.col("__value"), F.col("order_amount"), mode)
    return drawn.withColumn("discount_amount", amount).drop("__type", "__value")


def given_discounts(orders: DataFrame, discounts: DataFrame, as_of, mode: str = REFERENCE) -> DataFrame:
    """Adds ``discount_amount`` (not yet rounded) to rows with ``order_amount`` and ``discount_id``.

    A discount that is not valid at ``as_of``, or unknown, counts as none; validity as in
    ``apply_discounts``. With a column of the orders as ``as_of`` each order has its own time.
    """
    window = check_mode(mode) == STRICT
    each = isinstance(as_of, Column)
    valid = discounts if each else active_at(discounts, as_of, window)
    terms = {"id": "discount_id", "type": "__type", "value": "__value"}
    terms |= {"started_at": "__started", "expired_at": "__expired"} if each else {}
    found = orders.join(valid.select(*[F.col(c).alias(name) for c, name in terms.items()]), "discount_id", "left")
    if each:
        holds = F.col("__expired") > as_of
        holds = holds & (F.col("__started") <= as_of) if window else holds
        found = found.withColumn("__type", F.when(holds, F.col("__type")))
    amount = discount_amount(F.col("__type"), F.col("__value"), F.col("order_amount"), mode)
    kept = F.when(F.col("__type").isNotNull(), F.col("discount_id"))
    return found.withColumns({"discount_amount": amount, "discount_id": kept}).drop(*set(terms.values()) - {"discount_id"})


def stored_amounts(orders: DataFrame) -> DataFrame:
    """Adds ``total_amount`` and rounds all four amounts as the table stores them."""
    total = F.col("order_amount") + F.col("tax_amount") - F.col("discount_amount")
    amounts = ["order_amount", "discount_amount", "tax_amount", "total_amount"]
    return orders.withColumn("total_amount", total).withColumns({c: money(F.col(c)) for c in amounts})


def first_addresses(addresses: DataFrame) -> DataFrame:
    """Each user's address with the lowest id."""
    return addresses.groupBy("user_id").agg(F.min("id").alias("address_id"))


def lines_from_picks(basket: DataFrame, products: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Order lines for given picks: ``order_id, line_number, product_id`` and, if given, ``quantity``.

    Without a quantity the line takes the rule's share of the stock; without a ``unit_cost`` it has
    the table's default. One shuffle of the lines, to their products.
    """
    goods = products.select(F.col("id").alias("product_id"), "product_price", "product_tax", "product_quantity")
    by_rule = line_quantity(F.col("product_quantity"))
    quantity = F.coalesce(F.col("quantity").cast("int"), by_rule) if "quantity" in basket.columns else by_rule
    cost = F.coalesce("unit_cost", F.lit(0)) if "unit_cost" in basket.columns else F.lit(0)
    priced = basket.join(goods, "product_id").withColumn("quantity", quantity)
    return priced.select(
        "order_id",
        "line_number",
        "product_id",
        "quantity",
        "product_price",
        "product_tax",
        money(line_subtotal(F.col("product_price"), F.col("product_tax"), F.col("quantity"), mode)).alias("subtotal_amount"),
        money(cost).alias("unit_cost"),
    )


def orders_from_picks(
    picks: DataFrame, lines: DataFrame, discounts: DataFrame, statuses: DataFrame, as_of, mode: str = REFERENCE
) -> DataFrame:
    """Order rows for given picks: ``id``, user, staff, address, methods and ``discount_id`` of each order.

    An order without lines is an order over nothing. ``as_of`` may be a column of the picks: each
    order is then made at its own time. The lines are shuffled once more, to be summed; the picks meet
    the sums and the discounts. Nothing runs while it is built.
    """
    sums = sum_lines(lines, "order_id", mode).withColumnRenamed("order_id", "id")
    nothing = F.lit(0).cast("decimal(15,2)")
    whole = picks.join(sums, "id", "left").withColumns({c: F.coalesce(c, nothing) for c in ("order_amount", "tax_amount")})
    return _stored_orders(given_discounts(whole, discounts, as_of, mode), statuses, as_of)


def order_headers(
    requests: DataFrame,
    request_key: str,
    *,
    users: DataFrame,
    role_user: DataFrame,
    roles: DataFrame,
    addresses: DataFrame,
    payment_methods: DataFrame,
    shipping_methods: DataFrame,
    seed: str,
    existing_orders: DataFrame | None = None,
    start: int | None = None,
) -> DataFrame:
    """The id, customer, address, staff and methods of each requested order, written once:
    one narrow row per order, needed for the lines and again for the orders."""
    request = [request_key]
    header = requests.select(request_key)
    # Addresses join the customers, of whom there are fewer than orders.
    homes = first_addresses(addresses).withColumnRenamed("user_id", "id")
    picks = {
        "user_id": users_with_role(users, role_user, roles, ROLE_CUSTOMER).join(homes, "id", "left"),
        "staff_id": users_with_role(users, role_user, roles, ROLE_STAFF),
        "payment_method_id": payment_methods,
        "shipping_method_id": shipping_methods,
    }
    for column, choices in picks.items():
        columns = {"id": column, "address_id": "address_id"} if column == "user_id" else {"id": column}
        header = assign(header, request, choices, ["id"], columns, f"{seed}-{column}")
    header = header.filter("staff_id IS NOT NULL AND address_id IS NOT NULL")
    return written(with_surrogate_key(header, request, "id", existing_orders, start), "headers")


def order_lines(
    headers: DataFrame, request_key: str, products: DataFrame, seed: str, mode: str = REFERENCE
) -> DataFrame:
    """One to ten priced lines for each header, of different products in stock."""
    in_stock = products.filter(F.col("product_quantity") > 0).select(
        F.col("id").alias("product_id"), "product_price", "product_tax", "product_quantity"
    )
    chosen = baskets(headers, request_key, in_stock, ["product_id"], f"{seed}-basket", keep=["id"])
    return price_lines(chosen, [request_key, "product_id"], f"{seed}-cost", mode).select(
        F.col("id").alias("order_id"),
        "line_number",
        "product_id",
        "quantity",
        "product_price",
        "product_tax",
        "subtotal_amount",
        "unit_cost",
    )


def orders_from_lines(
    headers: DataFrame,
    request_key: str,
    lines: DataFrame,
    discounts: DataFrame,
    statuses: DataFrame,
    as_of,
    seed: str,
    mode: str = REFERENCE,
) -> DataFrame:
    """The order rows: headers with the sums of their lines, a discount and a total."""
    sums = sum_lines(lines, "order_id", mode).withColumnRenamed("order_id", "id")
    priced = apply_discounts(headers.join(sums, "id"), [request_key], discounts, as_of, f"{seed}-discount", mode)
    return _stored_orders(priced, statuses, as_of, request_key)


def _stored_orders(priced: DataFrame, statuses: DataFrame, as_of, *keys: str) -> DataFrame:
    """Rows of the orders table, pending, with their amounts as stored."""
    pending = statuses.filter(F.col("order_status_name") == STATUS_PENDING).select("id").scalar()
    now = as_of_column(as_of)
    return stored_amounts(priced).select(
        "id",
        *keys,
        "user_id",
        "staff_id",
        "address_id",
        "order_amount",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "discount_id",
        "payment_method_id",
        F.lit(None).cast("bigint").alias("payment_status_id"),
        pending.alias("order_status_id"),
        "shipping_method_id",
        F.lit(None).cast("bigint").alias("shipping_status_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipped_at"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def assemble_orders(
    requests: DataFrame,
    request_key: str,
    *,
    products: DataFrame,
    discounts: DataFrame,
    statuses: DataFrame,
    as_of,
    seed: str,
    mode: str = REFERENCE,
    **people,
) -> Assembled:
    """One order with one to ten lines for each request; ``people`` as in ``order_headers``.

    A request is dropped when its customer has no address, or when there is no staff or no
    product in stock: an order needs all three.
    """
    headers = order_headers(requests, request_key, seed=seed, **people)
    lines = order_lines(headers, request_key, products, seed, mode)
    return Assembled(
        orders_from_lines(headers, request_key, lines, discounts, statuses, as_of, seed, mode), lines
    )


def save_orders(
    requests: DataFrame,
    request_key: str,
    order_path: str,
    line_path: str,
    batch_id: int,
    *,
    products: DataFrame,
    discounts: DataFrame,
    statuses: DataFrame,
    as_of,
    seed: str,
    mode: str = REFERENCE,
    **people,
) -> None:
    """Assembles and writes a batch of orders. The lines are made once: the orders are summed
    from the lines as written, and a batch counts once its orders are there. Run again, it replaces
    itself with the same keys."""
    if people.get("existing_orders") is not None:
        people["start"] = batch_start(people["existing_orders"], order_path, batch_id)
    headers = order_headers(requests, request_key, seed=seed, **people)
    withdraw(requests.sparkSession, order_path, batch_id)
    write_batch(order_lines(headers, request_key, products, seed, mode), line_path, batch_id)
    lines = read_batch(requests.sparkSession, line_path, batch_id)
    orders = orders_from_lines(headers, request_key, lines, discounts, statuses, as_of, seed, mode)
    write_batch(orders, order_path, batch_id)


def change_status(
    orders: DataFrame,
    changes: DataFrame,
    statuses: DataFrame,
    as_of=None,
    mode: str = REFERENCE,
    sequence: str | None = None,
) -> DataFrame:
    """The orders after ``changes`` (``id, order_status_name``).

    ``sequence`` is the column in whose order the changes came, the last one counts; without it a
    second change of an order is an error. A name that ``statuses`` lacks changes nothing. Strict
    mode also sets ``updated_at``.
    """
    names = statuses.select(F.col("id").alias("order_status_id"), "order_status_name")
    known = changes.join(names, "order_status_name")
    columns = ["order_status_id"]
    if check_mode(mode) == STRICT:
        if as_of is None:
            raise ValueError("strict mode needs as_of")
        known = known.withColumn("updated_at", as_of_column(as_of))
        columns.append("updated_at")
    return update_by_key(orders, known, "id", columns, [sequence] if sequence else None)
