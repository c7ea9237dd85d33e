"""rategauge: listing-price analytics as plain Spark DataFrame operators."""

from rategauge.roles import LISTING, Roles

__all__ = ["LISTING", "Roles"]
