"""Naming a value inside an expression or beside the columns of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value's expression written once in the plan however often the body uses it. It may hold no Python function."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def bound(rows: DataFrame, **columns: Column) -> DataFrame:
    """The rows with further columns, each worked out once and where it stands. They come from a generator of one row: filters on them would
    else be put below it, and below a repartition before it, with the columns' expressions written out as often as they use them."""
    return rows.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
