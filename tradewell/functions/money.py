"""Exact money arithmetic of an order line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_total(quantity: Column, price: Column, discount: Column) -> Column:
    """Quantity * price * (1 - discount) in decimals, rounded half up to cents once, at the end.

    Prices and rates have six places and the product holds all twelve, as long as the price is below
    10^8 and the quantity below 10^15. Beyond that the product of the two keeps six places. The total
    is null where a part is, or where it does not fit the 16 digits before the point of the column.
    """
    exact = quantity.try_cast("decimal(15,0)") * price.try_cast("decimal(14,6)") * _rest(discount, "decimal(7,6)")
    gross = F.try_multiply(quantity.try_cast("decimal(19,0)"), price.try_cast("decimal(19,6)"))
    wide = F.try_multiply(gross.try_cast("decimal(26,6)"), _rest(discount, "decimal(11,6)"))
    return F.coalesce(exact.try_cast("decimal(18,2)"), wide.try_cast("decimal(18,2)"))


def _rest(discount: Column, kind: str) -> Column:
    return F.lit(1).cast("decimal(6,5)") - discount.try_cast(kind)


def net_amount(quantity: Column, price: Column, discount: Column) -> Column:
    """The same product before it is rounded to cents, as a decimal so that sums do not depend on order."""
    return (quantity * price * (1 - discount)).try_cast("decimal(28,8)")
