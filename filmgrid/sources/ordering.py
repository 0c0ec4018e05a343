"""Order columns as one text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """Order columns as one text that sorts as they do: nulls first, then by value. Texts, whole numbers, dates, times."""

    def part(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.IntegralType):
            # moved to positive numbers, so that digits of equal length sort by value
            text = F.lpad((value.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.StringType):
            text = value
        else:
            raise ValueError(f"{name} of type {kind.simpleString()} cannot give an order")
        return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))

    # a separator below all printable characters keeps a shorter text before a longer one
    return F.concat_ws("\x01", *[part(c) for c in columns])
