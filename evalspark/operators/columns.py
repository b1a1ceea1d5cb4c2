"""Columns that are expensive to compute and filtered on afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """As ``withColumns``, but each value is computed once per row.

    A filter on a plain column is pushed below its projection together with the whole
    expression, which is then computed again above. Rows that come out of a generator
    are not filtered below it.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))
