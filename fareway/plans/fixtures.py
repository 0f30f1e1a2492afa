"""Trip-shaped views over the supplied TPC-H-like tables.

The reference computes on city trip files (yellow, green, for-hire), a zone
lookup, payment seeds and a ride event stream. None of that data ships with
it, so these views derive the same shapes from ``lineitem``, ``orders``,
``nation``/``region`` and ``events``. Every column is a plain SQL expression
written once below and rendered for two dialects: Spark (the DataFrames the
operators run on) and DuckDB (the independent oracle). Only the timestamp
shift and the month text differ by dialect.

Money columns of trips are ``decimal(18,2)``; distances are doubles with seven
decimals, and amounts of messages have seven decimals and very different
sizes, so that a cut or an order-dependent sum shows. The views grow linearly with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = "spark"
DUCK = "duckdb"


def _shift(d: str, ts: str, secs: str, micros: str = "") -> str:
    if d == SPARK:
        out = f"timestampadd(SECOND, cast({secs} AS int), {ts})"
        return f"timestampadd(MICROSECOND, cast({micros} AS int), {out})" if micros else out
    out = f"({ts} + to_seconds(cast({secs} AS bigint)))"
    return f"({out} + to_microseconds(cast({micros} AS bigint)))" if micros else out


def _month_text(d: str, ts: str) -> str:
    if d == SPARK:
        return f"date_format({ts}, 'yyyy-MM')"
    return f"strftime({ts}, '%Y-%m')"


def _dec(x: str) -> str:
    return f"cast({x} AS decimal(18,2))"


PICKUP_SECS = "(l_partkey * 37 % 86400)"
DROPOFF_SECS = "(l_partkey * 37 % 86400 + 60 + l_orderkey * 53 % 7200)"
# A quarter of the trips starts within a second, down to the microsecond.
MICROS = "(CASE WHEN l_orderkey % 4 = 1 THEN l_orderkey * 7919 % 1000000 ELSE 0 END)"


def _digits(number: str) -> str:
    """Five more digits and a last 3, below 0.01: no text of a sum ends in a tie."""
    return f"cast({number} % 10000 * 10 + 3 AS decimal(10,0)) * cast(0.0000001 AS decimal(8,7))"


FARE = (
    "CASE WHEN l_orderkey % 97 = 0 THEN cast(0 AS decimal(18,2)) "
    "WHEN l_orderkey % 101 = 0 THEN -cast(l_extendedprice AS decimal(18,2)) "
    "ELSE cast(l_extendedprice AS decimal(18,2)) END"
)

# Service split of lineitem rows and the rows that are loaded twice.
SERVICE_FILTER = {"yellow": "l_orderkey % 3 <> 0", "green": "l_orderkey % 3 = 0"}
DUPLICATE_FILTER = "l_orderkey % 11 = 0"


def trip_columns(d: str, service: str) -> list[tuple[str, str]]:
    """(name, expression) of the raw trip file of one service, in file order."""
    pre = "tpep" if service == "yellow" else "lpep"
    pickup = _shift(d, "l_shipdate", PICKUP_SECS, MICROS)
    dropoff = _shift(d, "l_shipdate", DROPOFF_SECS, MICROS)
    common = {
        "VendorID": "cast(CASE l_suppkey % 4 WHEN 3 THEN NULL ELSE l_suppkey % 4 END AS int)",
        f"{pre}_pickup_datetime": pickup,
        f"{pre}_dropoff_datetime": dropoff,
        "passenger_count": "cast(l_linenumber AS bigint)",
        "trip_distance": f"cast(cast(cast(l_quantity AS decimal(18,2)) + {_digits('l_orderkey')} AS decimal(18,7)) AS double)",
        "RatecodeID": "cast(l_partkey % 6 + 1 AS int)",
        "store_and_fwd_flag": "CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'Y' END",
        "PULocationID": "cast(l_suppkey % 27 AS int)",
        "DOLocationID": "cast(l_partkey % 27 AS int)",
        "payment_type": "cast(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS int)",
        "fare_amount": FARE,
        "extra": _dec("0.50"),
        "mta_tax": _dec("0.50"),
        "tip_amount": _dec("l_discount"),
        "tolls_amount": _dec("l_tax"),
        "ehail_fee": "cast(NULL AS decimal(18,2))",
        "improvement_surcharge": _dec("0.30"),
        "total_amount": _dec(f"({FARE}) + {_dec('l_discount')} + {_dec('l_tax')}"),
        "trip_type": "cast(1 + l_linenumber % 2 AS int)",
        "congestion_surcharge": "cast(NULL AS decimal(18,2))",
        "filename": f"concat('{service}_tripdata_', {_month_text(d, pickup)}, '.csv')",
    }
    if service == "yellow":
        order = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                 "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID",
                 "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
                 "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
                 "filename"]
    else:
        order = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                 "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID",
                 "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
                 "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
                 "total_amount", "payment_type", "trip_type", "congestion_surcharge", "filename"]
    return [(n, common[n]) for n in order]


def fhv_columns(d: str) -> list[tuple[str, str]]:
    return [
        ("dispatching_base_num",
         "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE concat('B', cast(o_custkey % 50 AS string)) END"),
        ("pickup_datetime", "o_orderdate"),
        ("dropOff_datetime", _shift(d, "o_orderdate", "(60 + o_orderkey * 53 % 7200)")),
        ("PUlocationID", "cast(o_custkey % 27 AS int)"),
        ("DOlocationID", "cast(o_orderkey % 27 AS int)"),
        ("SR_Flag", "CASE WHEN o_orderkey % 2 = 0 THEN 1 END"),
        ("Affiliated_base_number", "concat('B', cast(o_custkey % 40 AS string))"),
    ]


ZONE_COLUMNS = [
    ("LocationID", "n_nationkey"),
    ("Borough", "r_name"),
    ("Zone", "n_name"),
    ("service_zone", "CASE WHEN n_regionkey = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END"),
]

# Payment seed rows (code, label) of the two seed variants.
PAYMENT_SEED = [(0, "Flex"), (1, "Credit card"), (2, "Cash")]
PAYMENT_SEED_NO_FLEX = [(1, "Credit card"), (2, "Cash")]


def ride_columns(d: str) -> list[tuple[str, str]]:
    """Ride messages derived from ``events`` (event time kept at micros)."""
    return [
        ("event_id", "event_id"),
        ("event_ts", "ts"),
        ("PULocationID", "cast(user_id % 25 AS int)"),
        ("DOLocationID", "cast(user_id * 7 % 25 AS int)"),
        ("passenger_count", "cast(user_id % 4 + 1 AS int)"),
        ("trip_distance", "value"),
        ("tip_amount", f"cast(cast(value AS decimal(18,2)) * 0.1 + {_digits('event_id * 7')} AS decimal(18,7))"),
        ("total_amount", f"cast(cast(value AS decimal(18,2)) * cast(CASE WHEN event_id % 50 = 0 THEN 10000 ELSE 1 END AS decimal(6,0)) "
                         f"+ {_digits('event_id')} AS decimal(18,7))"),
    ]


# ---------------------------------------------------------------- Spark side

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw trip rows of one service, including the loaded-twice copies.

    One scan: the second copy is produced by a generator, not a second read.
    """
    li = _table(spark, sf_dir, "lineitem").where(SERVICE_FILTER[service])
    copies = li.selectExpr("*", f"explode(if({DUPLICATE_FILTER}, array(0, 1), array(0))) AS _copy")
    return copies.selectExpr(*[f"{e} AS `{n}`" for n, e in trip_columns(SPARK, service)])


def fhv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS `{n}`" for n, e in fhv_columns(SPARK)])


def zones(spark: SparkSession, sf_dir: str, id_as_string: bool = False) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    r = _table(spark, sf_dir, "region")
    cols = [f"{e} AS {c}" for c, e in ZONE_COLUMNS]
    if id_as_string:
        cols[0] = "cast(n_nationkey AS string) AS LocationID"
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").selectExpr(*cols)


def payment_lookup(spark: SparkSession, with_flex: bool = True) -> DataFrame:
    rows = PAYMENT_SEED if with_flex else PAYMENT_SEED_NO_FLEX
    return spark.createDataFrame(rows, "payment_type int, description string")


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in ride_columns(SPARK)])


# ---------------------------------------------------------------- DuckDB side

def _duck_trip_cte(service: str) -> str:
    cond = SERVICE_FILTER[service]
    cols = ",\n    ".join(f'{e} AS "{n}"' for n, e in trip_columns(DUCK, service))
    return (f"{service}_tripdata AS (SELECT\n    {cols}\n  FROM (SELECT * FROM lineitem WHERE {cond} "
            f"UNION ALL SELECT * FROM lineitem WHERE {cond} AND {DUPLICATE_FILTER}) li)")


def _values(rows) -> str:
    return ", ".join(f"({k}, '{v}')" for k, v in rows)


def duck_fixture_ctes() -> str:
    fhv = ", ".join(f'{e} AS "{n}"' for n, e in fhv_columns(DUCK))
    zcols = ", ".join(f"{e} AS {c}" for c, e in ZONE_COLUMNS)
    zcols_s = zcols.replace("n_nationkey AS LocationID", "cast(n_nationkey AS varchar) AS LocationID")
    rcols = ", ".join(f"{e} AS {n}" for n, e in ride_columns(DUCK))
    parts = [
        _duck_trip_cte("yellow"),
        _duck_trip_cte("green"),
        f"fhv_tripdata AS (SELECT {fhv} FROM orders)",
        f"zones AS (SELECT {zcols} FROM nation JOIN region ON n_regionkey = r_regionkey)",
        f"zones_text AS (SELECT {zcols_s} FROM nation JOIN region ON n_regionkey = r_regionkey)",
        f"payment_lookup AS (SELECT * FROM (VALUES {_values(PAYMENT_SEED)}) t(payment_type, description))",
        f"payment_lookup_b AS (SELECT * FROM (VALUES {_values(PAYMENT_SEED_NO_FLEX)}) "
        "t(payment_type_id, payment_type_name))",
        f"rides AS (SELECT {rcols} FROM events)",
    ]
    return ",\n".join(parts)


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the fixture CTEs (and optional more CTEs)."""
    ctes = duck_fixture_ctes()
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
