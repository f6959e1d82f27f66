"""Whole-number division. ``/`` goes through doubles, which lose large ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quotient(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))
