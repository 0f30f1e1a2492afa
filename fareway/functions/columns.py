"""Column-returning helpers (the reusable SQL macros of the reference).

Everything here builds a Catalyst expression, so it stays inside
whole-stage codegen; nothing runs per row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Payment code labels (code 1..6, anything else 'EMPTY').
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_OTHER = "EMPTY"

# Vendor code to company name; other codes give NULL.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

# Null token used inside surrogate keys (our own, documented choice).
SURROGATE_NULL = "_null_"


def safe_cast(c: ColumnOrName, data_type: str, strict: bool = False) -> Column:
    """NULL instead of an error on bad input; ``strict`` keeps ANSI ``cast``."""
    c = _c(c)
    return c.cast(data_type) if strict else c.try_cast(data_type)


def exact(df: DataFrame, name: str) -> Column:
    """A column whose sums do not depend on the order of their rows.

    Floating point becomes ``decimal(38,20)``: all digits of the shortest text
    that gives the value back, down to 1e-20; sums below 1e18 in size are exact, and
    larger ones raise an error. Other types are exact as they are.
    """
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(f"`{name}`").cast("decimal(38,20)")
    return F.col(f"`{name}`")


def payment_description(c: ColumnOrName) -> Column:
    code = safe_cast(c, "int")
    expr = None
    for k, v in PAYMENT_LABELS.items():
        expr = (F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v)))
    return expr.otherwise(F.lit(PAYMENT_OTHER))


def vendor_name(c: ColumnOrName) -> Column:
    c = _c(c)
    expr = None
    for k, v in VENDOR_NAMES.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def trip_duration_minutes(pickup: ColumnOrName, dropoff: ColumnOrName) -> Column:
    """Minute boundaries crossed between the two timestamps (bigint).

    Matches the boundary-counting ``datediff('minute', a, b)`` of warehouse
    targets: 12:00:59 -> 12:01:00 is one minute.
    """
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(pickup)),
                            F.date_trunc("minute", _c(dropoff)))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed hours as double: whole seconds between the two / 3600."""
    return F.timestamp_diff("SECOND", _c(start), _c(end)).cast("double") / F.lit(3600.0)


def epoch_millis(ts: ColumnOrName) -> Column:
    """Timestamp (LTZ or NTZ, session zone UTC) -> epoch milliseconds."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def from_epoch_millis(ms: ColumnOrName) -> Column:
    return F.timestamp_millis(_c(ms))


def parse_timestamp(text: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text -> timestamp; NULL for text that does not match the pattern."""
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def timestamp_text(ts: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_c(ts), fmt)


def month_sequence(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Array of 'yyyy-MM' for every month from start's month to end's month."""
    s = F.trunc(_c(start).cast("date"), "month")
    e = F.trunc(_c(end).cast("date"), "month")
    months = F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def _hash_text(c: Column, dtype: str) -> Column:
    """Text of a value with all its digits: microseconds without trailing
    zeros, the shortest exact text of a double."""
    if dtype.startswith("timestamp"):
        return c.cast("timestamp_ntz").cast("string")
    return c.cast("string")


def row_hash(cols: list[tuple[Column, str]], binary: bool = False) -> Column:
    """md5 over coalesced text of the columns, no separator (hex or bytes)."""
    parts = [F.coalesce(_hash_text(c, t), F.lit("")) for c, t in cols]
    h = F.md5(F.concat(*parts))
    return F.unhex(h) if binary else h


def surrogate_key(cols: list[tuple[Column, str]]) -> Column:
    """md5 of '-'-joined column text; NULL becomes a fixed token."""
    parts = [F.coalesce(_hash_text(c, t), F.lit(SURROGATE_NULL)) for c, t in cols]
    return F.md5(F.concat_ws("-", *parts))


def vendor_code(vendor_id: ColumnOrName) -> Column:
    """'s/NNN' when vendor_id+1 is divisible by 3, else 'e/NNN' (zero-padded)."""
    n = _c(vendor_id) + 1
    return (F.when(n.isNull(), F.lit(None).cast("string"))
            .when(n % 3 == 0, F.format_string("s/%03d", n))
            .otherwise(F.format_string("e/%03d", n)))


def matches_full(text: ColumnOrName, pattern: str) -> Column:
    """Full-match regex (anchored at both ends)."""
    p = pattern
    if not p.startswith("^"):
        p = "^" + p
    if not p.endswith("$"):
        p = p + "$"
    return _c(text).rlike(p)
