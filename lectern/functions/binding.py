"""Evaluate expressions once per row."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` to a name inside `body`.

    A column used in a lambda is evaluated again for every element; a bound one is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns that later steps use more than once.

    Filters on an ordinary computed column are pushed below it and take a copy of its expression
    along; over several steps the copies multiply. A generator of one row stops that.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
