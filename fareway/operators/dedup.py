"""Keep-first deduplication.

``row_number() = 1`` over the key is planned by Spark with a partial
``WindowGroupLimit`` before the shuffle: every map task keeps only its first
row per key, so a hot key (say a third of all rows) reaches the exchange as
one row per task, not as a third of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
              T.BooleanType, T.BinaryType)


def dedup_first(df: DataFrame, keys: list[str | Column], order: list[Column],
                tie_break: bool = True) -> DataFrame:
    """First row per ``keys`` by ``order``.

    With ``tie_break`` every remaining orderable column is appended to the
    order (ascending, nulls last), so the kept row is deterministic even
    when ``order`` ties, and equal across engines.
    """
    order = list(order)
    if tie_break:
        used = {c for c in keys if isinstance(c, str)}
        for f in df.schema.fields:
            if f.name not in used and isinstance(f.dataType, _ORDERABLE):
                order.append(F.col(f"`{f.name}`").asc_nulls_last())
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
