"""Result columns in types every SQL engine shares, for comparing results."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(
    df: DataFrame, places: int = 6, exact: Collection[str] = (), scaled: bool = False
) -> DataFrame:
    """Times without zone, doubles rounded unless named in ``exact``, lists as joined text.

    Decimals become doubles, or with ``scaled`` text with all their places, which shows the scale.
    """

    def convert(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("string" if scaled else "double")
        elif isinstance(field.dataType, T.DoubleType) and field.name not in exact:
            column = F.round(column, places)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",", "")
        return column.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])
