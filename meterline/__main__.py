"""Run the jobs from the command line or with spark-submit.

    python -m meterline reports RECORDS --mapping MAPPING --target OUT [--target S3A-URI]
    python -m meterline stream RECORDS --mapping MAPPING --target OUT --checkpoints DIR
    python -m meterline load FILES DIMENSION
    python -m meterline put DIMENSION NAME CODE
    python -m meterline find DIMENSION NAME
    python -m meterline stats LOG

Keys of an object store belong in Spark's configuration, not on the command line.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from meterline import (
    BRIEF,
    FULL,
    build_session,
    find,
    load_into,
    load_mapping,
    log_progress,
    prepare,
    put_rows,
    read_cdr,
    read_dimension,
    read_request_log,
    request_stats,
    run_reports,
    start_reports,
    stop_all,
    stream_cdr,
)
from meterline.schemas import DIMENSION, FALLBACK_MAPPING


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="meterline")
    top.add_argument("--master")
    jobs = top.add_subparsers(dest="job", required=True)

    for name in ("reports", "stream"):
        job = jobs.add_parser(name)
        job.add_argument("records")
        job.add_argument("--mapping", required=True)
        job.add_argument("--fallback", action="store_true", help="name two codes if it is absent")
        job.add_argument("--brief", action="store_true", help="three columns instead of 16")
        job.add_argument("--target", action="append", required=True)
        if name == "stream":
            job.add_argument("--checkpoints", required=True)
            job.add_argument("--progress", help="a folder to keep every trigger in")
            job.add_argument("--once", action="store_true", help="end when all files are read")
        else:
            job.add_argument("--single-file", action="store_true")

    job = jobs.add_parser("load")
    job.add_argument("files")
    job.add_argument("dimension")
    job = jobs.add_parser("put")
    for argument in ("dimension", "name", "code"):
        job.add_argument(argument)
    job = jobs.add_parser("find")
    for argument in ("dimension", "name"):
        job.add_argument(argument)
    for name in ("load", "put", "find"):
        jobs.choices[name].add_argument("--table", action="store_true", help="DIMENSION is a table")
    jobs.add_parser("stats").add_argument("log")
    return top


def stored(chosen: argparse.Namespace) -> dict[str, str]:
    """Where the dimension is: a folder of versions, or a table of the catalog."""
    return {"table" if chosen.table else "dimension_path": chosen.dimension}


def main(arguments: list[str] | None = None) -> int:
    chosen = parser().parse_args(arguments)
    spark = build_session("meterline", chosen.master)

    if chosen.job in ("reports", "stream"):
        layout = BRIEF if chosen.brief else FULL
        fallback = FALLBACK_MAPPING if chosen.fallback else None
        mapping = load_mapping(spark, chosen.mapping, fallback)
        if chosen.job == "reports":
            records = prepare(read_cdr(spark, chosen.records, layout), layout)
            run_reports(records, mapping, chosen.target, layout.key_column,
                        single_file=chosen.single_file, show=True)
        else:
            records = prepare(stream_cdr(spark, chosen.records, layout), layout)
            trigger = {"availableNow": True} if chosen.once else {"processingTime": "30 seconds"}
            if chosen.progress:
                log_progress(spark, chosen.progress)
            running = start_reports(
                records, mapping, chosen.target, chosen.checkpoints, layout.key_column,
                trigger=trigger,
            )
            try:
                running.awaitTermination()
            finally:
                stop_all(spark)
    elif chosen.job == "load":
        print(load_into(spark, chosen.files, **stored(chosen)).counters)
    elif chosen.job == "put":
        row = [(chosen.name.strip(), chosen.code.strip())]
        update = spark.createDataFrame(row, DIMENSION).withColumn("write", F.lit(0))
        put_rows(spark, update, "name", ["write"], ["country_code"], **stored(chosen))
    elif chosen.job == "find":
        place = (None, chosen.dimension) if chosen.table else (chosen.dimension, None)
        row = find(read_dimension(spark, *place), "name", chosen.name).first()
        print(row["country_code"] if row else "not found")
        return 0 if row else 1
    else:
        hits = read_request_log(spark, chosen.log).select((F.col("cache_status") == "HIT").alias("hit"))
        print(request_stats(hits).first().asDict())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
