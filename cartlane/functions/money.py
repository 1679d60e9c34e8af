"""Amounts of an order, as exact decimals.

Every product is kept wide and rounded once, when it is cast to the stored type.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlane.modes import REFERENCE, STRICT, check_mode

MONEY = "decimal(15,2)"
PERCENT = "decimal(4,2)"


def hundredth() -> Column:
    return F.lit(Decimal("0.01"))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def percent_of(amount: Column, percent: Column) -> Column:
    return amount * percent * hundredth()


def line_quantity(stock: Column) -> Column:
    """A tenth of the stock, whole pieces, one at least."""
    return F.greatest(F.lit(1), F.floor(stock / F.lit(10)).cast("int"))


def line_subtotal(price: Column, tax: Column, quantity: Column, mode: str = REFERENCE) -> Column:
    """The line's tax in reference mode; price times quantity in strict mode."""
    if check_mode(mode) == STRICT:
        return price * quantity
    return percent_of(price, tax) * quantity


def tax_sum(price: Column, tax: Column, quantity: Column, mode: str = REFERENCE) -> Column:
    """The tax of an order's lines; reference mode counts one piece of each line only.

    The division by 100 is done once per order: exact decimals allow it.
    """
    part = price * tax * quantity if check_mode(mode) == STRICT else price * tax
    return F.sum(part) * hundredth()


def discount_amount(kind: Column, value: Column, order_amount: Column, mode: str = REFERENCE) -> Column:
    """What a discount takes off.

    Reference mode takes ``order_amount - value`` for a fixed amount; strict mode takes the
    value itself, never more than the order.
    """
    if check_mode(mode) == STRICT:
        fixed = F.least(value, order_amount)
    else:
        fixed = order_amount - value
    return (
        F.when(kind.isNull(), F.lit(Decimal("0")))
        .when(kind == "percent", percent_of(order_amount, value))
        .otherwise(fixed)
    )
