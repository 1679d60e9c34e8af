"""The 22 tables of the retail model: columns, keys, references, domains and seed rows.

Fixed values: names, types, bounds and seed rows are those of the modelled database, since
audits and change records depend on them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    default: object = None
    domain: tuple[str, ...] = ()

    @property
    def max_length(self) -> int | None:
        match = re.fullmatch(r"varchar\((\d+)\)", self.type)
        return int(match.group(1)) if match else None

    @property
    def decimal(self) -> tuple[int, int] | None:
        match = re.fullmatch(r"decimal\((\d+),(\d+)\)", self.type)
        return (int(match.group(1)), int(match.group(2))) if match else None

    @property
    def is_timestamp(self) -> bool:
        return self.type.startswith("timestamp")

    def spark_type(self) -> T.DataType:
        if self.type.startswith("varchar") or self.type == "text":
            return T.StringType()
        if self.is_timestamp:
            return T.TimestampNTZType()
        if self.decimal is not None:
            return T.DecimalType(*self.decimal)
        return {"int": T.IntegerType(), "long": T.LongType(), "boolean": T.BooleanType()}[self.type]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type(), True) for c in self.columns])

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


PERCENT, AMOUNT = "percent", "amount"
DISCOUNT_TYPES = (PERCENT, AMOUNT)
TRANSACTION_TYPES = ("payment", "refund", "adjustment", "other")


def _table(name: str, columns: str, unique=(), references=None, created="timestamp(0)!") -> Table:
    """Reads ``name type[!] [= default] [in (...)]`` lines; ``!`` marks a required column."""
    parsed = [Column("id", "long", True)]
    for line in [*columns.strip().splitlines(), f"created_at {created}"]:
        spec, _, default = line.strip().partition(" = ")
        column, kind = spec.split(" ", 1)
        domain = {"discount_type": DISCOUNT_TYPES, "transaction_type": TRANSACTION_TYPES}.get(kind.rstrip("!"), ())
        value = {"0": 0, "1": 1, "false": False, "": None}.get(default, default)
        parsed.append(Column(column, "text" if domain else kind.rstrip("!"), kind.endswith("!"), value, domain))
    return Table(name, tuple(parsed), tuple(tuple(u) for u in unique), dict(references or {}))


def _named(table: str, column: str) -> Table:
    return _table(table, f"{column} varchar(100)!", [[column]])


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        _table(
            "users",
            """
            username varchar(100)!
            password varchar(255)
            email varchar(255)!
            mobile varchar(255)!
            """,
            [["username"], ["email"], ["mobile"]],
        ),
        _table(
            "roles",
            """
            role_name varchar(50)!
            role_title varchar(50)!
            """,
            [["role_name"], ["role_name", "role_title"]],
        ),
        _table(
            "role_user",
            """
            role_id long!
            user_id long!
            """,
            [["role_id", "user_id"]],
            {"role_id": "roles", "user_id": "users"},
        ),
        _named("provinces", "province_name"),
        _table(
            "cities",
            """
            city_name varchar(100)!
            province_id long!
            latitude decimal(9,6)
            longitude decimal(9,6)
            """,
            [["city_name", "province_id"]],
            {"province_id": "provinces"},
        ),
        _table(
            "addresses",
            """
            title varchar(100)!
            user_id long!
            province_id long!
            city_id long!
            full_address varchar(255)
            """,
            references={"user_id": "users", "province_id": "provinces", "city_id": "cities"},
        ),
        _table(
            "categories",
            """
            category_name varchar(100)!
            category_id long
            slug varchar(100)!
            """,
            [["slug"]],
            {"category_id": "categories"},
        ),
        _named("brands", "brand_name"),
        _named("tags", "tag_name"),
        _table(
            "products",
            """
            product_name varchar(255)!
            category_id long!
            brand_id long!
            product_description text
            product_price decimal(15,2)!
            product_tax decimal(4,2)! = 0
            product_quantity int! = 0
            product_image_path text
            """,
            references={"category_id": "categories", "brand_id": "brands"},
            created="timestamp!",
        ),
        _table(
            "product_tag",
            """
            product_id long!
            tag_id long!
            """,
            [["product_id", "tag_id"]],
            {"product_id": "products", "tag_id": "tags"},
        ),
        _table(
            "adscampaigns",
            """
            campaign_title varchar(255)
            started_at timestamp
            expired_at timestamp
            """,
        ),
        _table(
            "discounts",
            """
            adscampaign_id long
            type discount_type = percent
            value decimal(15,2)
            code varchar(100)
            started_at timestamp(0)
            expired_at timestamp(0)
            """,
            [["code"]],
            {"adscampaign_id": "adscampaigns"},
        ),
        _named("orderstatus", "order_status_name"),
        _named("paymentmethods", "payment_method_name"),
        _named("paymentstatus", "payment_status_name"),
        _named("shippingstatus", "shipping_status_name"),
        _named("shippingmethods", "shipping_method_name"),
        _table(
            "orders",
            """
            user_id long!
            staff_id long!
            address_id long!
            order_amount decimal(15,2)!
            discount_amount decimal(15,2)!
            tax_amount decimal(15,2)!
            total_amount decimal(15,2)!
            discount_id long
            payment_method_id long
            payment_status_id long
            order_status_id long!
            shipping_method_id long
            shipping_status_id long
            shipped_at timestamp(0)
            updated_at timestamp(0)! = now
            """,
            references={
                "user_id": "users",
                "staff_id": "users",
                "discount_id": "discounts",
                "address_id": "addresses",
                "order_status_id": "orderstatus",
                "payment_method_id": "paymentmethods",
                "payment_status_id": "paymentstatus",
                "shipping_method_id": "shippingmethods",
                "shipping_status_id": "shippingstatus",
            },
        ),
        _table(
            "order_status_history",
            """
            order_id long!
            order_status_id long!
            staff_id long!
            comments varchar(500)
            """,
            [["order_id", "order_status_id"]],
            {"order_id": "orders", "staff_id": "users", "order_status_id": "orderstatus"},
        ),
        _table(
            "orderdetails",
            """
            order_id long!
            product_id long!
            quantity int! = 1
            product_price decimal(15,2)!
            product_tax decimal(15,2)!
            subtotal_amount decimal(15,2)!
            unit_cost decimal(15,2) = 0
            """,
            references={"order_id": "orders", "product_id": "products"},
        ),
        _table(
            "transactions",
            """
            order_id long
            transaction_type transaction_type
            amount decimal(15,2)
            status boolean = false
            description text
            """,
            references={"order_id": "orders"},
            created="timestamp(0)",
        ),
    )
}

# The seed rows, in the order of their ids.
SEEDS: dict[str, list[tuple]] = {
    "roles": [
        ("admin", "Administrator"),
        ("staff", "Staff"),
        ("manager", "Manager"),
        ("customer", "Customer"),
    ],
    "orderstatus": [("Pending",), ("Processing",), ("Shipped",), ("Delivered",), ("Cancelled",)],
    "paymentmethods": [("Credit Card",), ("Debit Card",), ("PayPal",), ("Bank Transfer",), ("Cash on Delivery",)],
    "paymentstatus": [("Pending",), ("Authorized",), ("Completed",), ("Failed",), ("Refunded",)],
    "shippingstatus": [
        ("Pending",),
        ("In Transit",),
        ("Out for Delivery",),
        ("Delivered",),
        ("Failed Attempt",),
        ("Returned",),
    ],
    "shippingmethods": [
        ("Standard Shipping",),
        ("Express Shipping",),
        ("Next-Day Delivery",),
        ("Free Shipping",),
        ("Pickup from Store",),
    ],
}

ROLE_ADMIN, ROLE_MANAGER, ROLE_STAFF, ROLE_CUSTOMER = "admin", "manager", "staff", "customer"
STATUS_PENDING = "Pending"
# Where an order may go after a payment.
STATUS_AFTER_SUCCESS = ["Processing", "Shipped", "Delivered"]
STATUS_AFTER_FAILURE = ["Pending", "Cancelled"]
