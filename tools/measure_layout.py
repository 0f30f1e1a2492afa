"""Files and bytes a date-range query reads: plain table vs partitioned +
clustered table (the layout of ``layout_partition_cluster``).

usage: python tools/measure_layout.py [sf_dir]
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from fareway.operators import staging as S
    from fareway.plans import fixtures as fx
    from fareway.session import get_session
    from fareway.sources import writers as W

    spark = get_session("layout", master="local[4]", shuffle_partitions=8)
    y = S.stage_yellow(fx.raw_trips(spark, sf, "yellow")).withColumns({
        "dropoff_date": F.to_date("dropoff_datetime"),
        "dropoff_month": F.trunc(F.to_date("dropoff_datetime"), "month")})
    plain = W.materialize_table(y.repartition(8), "layout_plain")
    part = W.materialize_table(y, "layout_part", partition_by=["dropoff_month"],
                               cluster_by=["dropoff_date", "vendor_id"])
    lo, hi = F.lit("1997-03-01").cast("date"), F.lit("1997-03-15").cast("date")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def read_stats(df):
        files = [r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()]
        size = 0
        for f in files:
            p = jvm.org.apache.hadoop.fs.Path(f)
            size += p.getFileSystem(conf).getFileStatus(p).getLen()
        return len(files), size

    q_plain = plain.where(F.col("dropoff_date").between(lo, hi)).select("vendor_id", "dropoff_date")
    q_part = (part.where(F.col("dropoff_month").between(F.trunc(lo, "month"), F.trunc(hi, "month")))
              .where(F.col("dropoff_date").between(lo, hi)).select("vendor_id", "dropoff_date"))
    fp, bp = read_stats(plain)
    fq, bq = read_stats(q_part)
    out = {"sf": sf, "plain_files_scanned": fp, "plain_bytes_scanned": bp,
           "partitioned_files_scanned": fq, "partitioned_bytes_scanned": bq,
           "same_answer": sorted(map(tuple, q_plain.distinct().collect()))
           == sorted(map(tuple, q_part.distinct().collect()))}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
