"""Headline timings; prints one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores  (default: all)

The first three entries repeat the published workload: 4,000,000 generated rows
bulk-inserted into 3 files (about 80 s there), 10,000 of them upserted, 10 deleted.
The rest run over the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import MOR, KeyedTable, TableSpec  # noqa: E402
from tidemark.functions import scratch_dir  # noqa: E402
from tidemark.plans import QUERIES, sales  # noqa: E402
from tidemark.plans.sales import FLAT, PARTITIONED, R, RP  # noqa: E402
from tidemark.sinks import read_manifest, write_manifest  # noqa: E402
from tidemark.sources import generated_records  # noqa: E402

PUBLISHED_ROWS = 4_000_000
PUBLISHED_SECONDS = 80.0
PLANS = (
    "partition_counts",
    "upsert_cow",
    "upsert_nonpartitioned",
    "upsert_event_time",
    "precombine_batch",
    "precombine_window",
    "hard_delete",
    "soft_delete_null",
    "update_where",
    "delete_candidates",
    "evolve_schema",
    "derive_keys",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    folder = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    def new_table(spec):
        return KeyedTable.create(spark, scratch_dir(spark, "bench"), spec)

    # warm the JVM on a small table so that the first timing is not class loading
    small = new_table(TableSpec(keys="id", order_by="sk"))
    small.bulk_insert(generated_records(spark, 0, 1000), n_files=3)
    small.upsert(generated_records(spark, 0, 10, 2))
    run(small.snapshot())

    demo = new_table(TableSpec(keys="id", order_by="sk"))
    records = generated_records(spark, 0, PUBLISHED_ROWS, modified=F.current_timestamp())
    timed("bulk_insert_4m", lambda: demo.bulk_insert(records, n_files=3))
    changes = generated_records(spark, 3_000_000, 10_000, 2, modified=F.current_timestamp())
    timed("upsert_10k_of_4m", lambda: demo.upsert(changes))
    timed("delete_10_of_4m", lambda: demo.delete(spark.range(2_000_000, 2_000_010)))
    timed("count_4m", lambda: run(demo.snapshot().agg(F.count("*"))))

    base = sales.base(spark, sf, "quantity", "flag", "discount", "status")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    flat = new_table(FLAT)
    timed("bulk_insert", lambda: flat.bulk_insert(base.select(*R), n_files=8))
    # about a quarter percent of the rows: returned lines of full quantity, finished
    few = sales.updates(base).filter((F.col("quantity") > 50) & (F.col("status") == "F")).select(*R)
    timed("upsert_quarter_percent", lambda: flat.upsert(few))
    ten = flat.snapshot().orderBy("order_id", "line_id").limit(10).select("order_id", "line_id")
    timed("delete_10_keys", lambda: flat.delete(ten))

    monthly = new_table(PARTITIONED.with_(storage=MOR))
    keyed = sales.with_partitions(base)
    timed("partitioned_insert", lambda: monthly.insert(keyed.select(*RP)))
    moved = sales.updates(keyed).unionByName(sales.inserts(keyed)).select(*RP)
    timed("mor_upsert", lambda: monthly.upsert(moved))
    timed("realtime_read", lambda: run(monthly.snapshot(view="rt")))
    timed("compact", lambda: monthly.compact())
    timed("snapshot_read", lambda: run(monthly.snapshot(view="ro")))
    timed("manifest", lambda: run(read_manifest(spark, write_manifest(monthly), monthly)))

    for name in PLANS:
        timed(name, lambda: run(QUERIES[name](spark, sf)))

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "lineitem_rows": lines,
                "bulk_insert_rows_per_sec": round(PUBLISHED_ROWS / times["bulk_insert_4m"]),
                "speedup_over_published_bulk_insert": round(PUBLISHED_SECONDS / times["bulk_insert_4m"], 2),
            }
        )
    )


if __name__ == "__main__":
    main()
