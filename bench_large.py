"""Time the jobs whose cost grows with the data on many copies of the given events.

    python bench_large.py [folder] [million requests]

Makes the copies below a new scratch folder: a third of the requests ask for one city, and
a third come at one time. Prints one line for each job; nothing is kept.
"""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import functions as F

from bench import one_pass, report_by_report
from meterline import build_session, lookup, repeat_within, running_hit_rate
from meterline.operators.dimension import last_write
from meterline.plans.on_tables import as_full_records, cities, table


def timed(name: str, job) -> None:
    started = time.perf_counter()
    job()
    print(f"{name:44} {time.perf_counter() - started:8.1f} s", flush=True)


def ran(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(folder: str = "/root/testdata/sf0.1", millions: str = "10") -> None:
    scratch = tempfile.mkdtemp(prefix="bench-large-")
    spark = build_session("large", "local[8]", spark__sql__shuffle__partitions="32")
    spark.sparkContext.setLogLevel("OFF")
    events = table(spark, folder, "events")
    copies = max(1, int(float(millions) * 1e6 / events.count()))
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    number = F.xxhash64("event_id", "copy")
    burst = F.to_timestamp(F.lit("2024-01-15 12:00:00"))
    requests = many.select(
        number.alias("request_id"),
        F.when(number % 3 == 0, burst).otherwise(F.col("ts").cast("timestamp")).alias("ts"),
        F.when(F.pmod(number, F.lit(3)) == 1, "Customer#000000042")
        .otherwise(F.format_string("Customer#%09d", F.pmod(number, F.lit(200_000))))
        .alias("city"),
        (F.col("event_type") == "view").alias("hit"),
    )
    requests.write.parquet(f"{scratch}/requests")
    asked = spark.read.parquet(f"{scratch}/requests")
    records = as_full_records(many.filter(F.col("copy") <= max(1, copies // 4)))
    records.write.option("header", True).csv(f"{scratch}/records")
    print(f"{asked.count():,} requests, {copies // 4 * events.count():,} records")

    targets = [f"{scratch}/a", f"{scratch}/b"]
    timed("four reports in one pass", lambda: one_pass(spark, f"{scratch}/records", targets))
    timed("four reports one by one", lambda: report_by_report(spark, f"{scratch}/records", targets))
    log = asked.select("request_id", "ts", "hit")
    timed("running hit rate", lambda: ran(running_hit_rate(log, rows_per_range=500_000)))
    timed("the same, cut in two levels",
          lambda: ran(running_hit_rate(log, rows_per_range=100_000, coarse_ranges=8)))
    plain = asked.select("request_id", "ts", "city")
    timed("repeats within the limit", lambda: ran(repeat_within(plain, rows_per_range=500_000)))
    timed("the same, cut in two levels",
          lambda: ran(repeat_within(plain, rows_per_range=100_000, coarse_ranges=8)))
    known = cities(spark, folder)
    timed("lookup, broadcast", lambda: ran(lookup(asked, known)))
    timed("lookup, shuffled and spread", lambda: ran(lookup(asked, known, max_rows=0)))
    updates = asked.select("city", "request_id", "ts", F.col("hit").cast("string").alias("label"))
    timed("last write per key by max_by",
          lambda: ran(last_write(updates, "city", ["ts", "request_id"], ["label"])))


if __name__ == "__main__":
    main(*sys.argv[1:])
