"""Write N time-shifted copies of an ``events`` table as a denser ``events.parquet`` folder.

    python tools/make_scaled_events.py <sf_dir> <out_dir> <copies>

Copy k has ``event_id`` offset by k * count and ``ts`` shifted by k * 997 ms
(so copies land in the same windows, making windows denser, not longer).
Done in Spark with ``explode(sequence(0, copies - 1))``; rows are never collected.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sensorwatch.session import local_session  # noqa: E402

if __name__ == "__main__":
    src, out, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session()
    ev = spark.read.parquet(f"{src}/events.parquet")
    count = ev.count()
    scaled = ev.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        (F.col("event_id") + F.col("k") * count).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("k") * F.lit(0.997))).alias("ts"),
        "user_id", "event_type", "value", "props",
    )
    scaled.repartition(16).write.mode("errorifexists").parquet(f"{out}/events.parquet")
    print(spark.read.parquet(f"{out}/events.parquet").count())
