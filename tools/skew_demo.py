"""Hot-key demonstration for the history windows.

One employee receives the orders of a third of all customers; the prior-statistics window is run
once with plain windows and once with the hot-key path, and the rows per window partition are
reported (AQE off so the partition count is fixed).

    python tools/skew_demo.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from hourloom.operators import history as H  # noqa: E402
from hourloom.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    r = o.select(F.col("o_orderkey").alias("id"),
                 F.when(F.col("o_custkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
                 .alias("emp"),
                 F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("v"))
    hot = r.where("emp = 0").count()
    print(f"rows {r.count()}, rows of the hot employee {hot}")
    for label, sk in (("plain windows", None), ("hot-key path", max(1000, hot // 5))):
        out = H.prior_stats(r, ["emp"], ["d", "id"], "v", mean="m", std="s", count="n",
                            skew_rows=sk)
        t = time.time()
        sizes = [x["c"] for x in out.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.count(F.lit(1)).alias("c"), F.sum("m"), F.sum("n")).collect()]
        print(f"{label}: {len(sizes)} window partitions, max rows {max(sizes)}, "
              f"median {sorted(sizes)[len(sizes) // 2]}, {time.time() - t:.2f} s")


if __name__ == "__main__":
    main()
