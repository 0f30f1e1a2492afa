"""The vendor-code rule as a registered Arrow (pandas) UDF.

The queries use the native expression ``columns.vendor_code`` (JVM-side,
codegen). This UDF exists for SQL users who call the rule by name; it is
vectorised over Arrow batches, never row at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def vendor_code_udf(vendor_id: pd.Series) -> pd.Series:
    n = vendor_id.astype("Int64") + 1
    prefix = n.mod(3).eq(0).map({True: "s/", False: "e/"})
    body = n.astype("string").str.zfill(3)
    out = prefix.astype("string") + body
    return out.where(n.notna(), None)


def register(spark: SparkSession, name: str = "vendor_code") -> None:
    spark.udf.register(name, vendor_code_udf)
