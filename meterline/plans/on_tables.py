"""Every report, load, lookup and stream of the library, run over the given tables.

Each query stands next to the SQL that must give the same rows. ``events`` plays the
billing records and the request log, ``customer``, ``supplier`` and ``part`` play the
keyed dimension, and ``orders`` its updates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.functions import cache_status, convert_amount
from meterline.operators import dimension as dim
from meterline.operators import ordered, reports, requests, rollup
from meterline.operators.prepare import prepare, with_event_time
from meterline.plans.dimension import (
    dimension_from,
    load_dimension,
    load_into,
    put_rows,
    read_loads,
)
from meterline.plans.landed import read_roll_up, refresh_roll_up
from meterline.plans.requests import answer_requests, rate_load
from meterline.plans.revenue import FOLDERS, report_set, reports_from, run_reports
from meterline.schemas import BRIEF, FULL
from meterline.session import cut_lineage, new_folder
from meterline.sinks import (
    land_cdr,
    merge_buckets,
    preview,
    write_changes,
    write_report,
    write_request_log,
    write_version,
)
from meterline.sinks.joined import join_batches, read_batches
from meterline.sources import (
    builtin_mapping,
    empty_dimension,
    load_mapping,
    read_cdr,
    read_dimension,
    read_dimension_files,
    read_landed_cdr,
    read_request_log,
    stream_cdr,
    stream_request_log,
)
from meterline.streaming import (
    join_progress,
    log_progress,
    progress_rows,
    read_complete,
    read_updates,
    start_answers,
    start_lookups,
    start_reports,
    stop_all,
    stream_appended,
    stream_complete,
    stream_messages,
    stream_updates,
    stream_upsert,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def checked_by(sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- billing records made of events ---------------------------------------------------

NAMES = [(0, "Prepaid"), (1, "Postpaid"), (2, "Corporate")]
CODES = {"purchase": 0, "signup": 1, "click": 2, "view": 3}

CDR = """
WITH cdr AS (
  SELECT date_trunc('second', ts) AS t,
         CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1
                         WHEN 'click' THEN 2 WHEN 'view' THEN 3 END AS code,
         TRY_CAST(CAST(value AS DECIMAL(10,3)) AS DECIMAL(6,3)) AS rev
  FROM events)
"""
SLOT = "time_bucket(INTERVAL '15 minutes', t)"
NAMED = """(VALUES (0, 'Prepaid'), (1, 'Postpaid'), (2, 'Corporate')) AS m(c, value)"""
CLOSED = "(SELECT max(t) - INTERVAL '1 day' FROM cdr)"


def pay_type(event_type: Column) -> Column:
    """A code per event type; errors have none and views have one without a name."""
    codes = F.create_map(*[F.lit(part) for pair in CODES.items() for part in pair])
    return F.try_element_at(codes, event_type)


def debit_amount(value: Column) -> Column:
    return (value.cast("decimal(10,3)") * F.lit(10000)).try_cast("decimal(10,3)")


def as_records(events: DataFrame) -> DataFrame:
    """Events in the three columns of the full record layout that reports use."""
    return events.select(
        F.date_format("ts", FULL.time_format).alias("RECORD_DATE"),
        pay_type(F.col("event_type")).alias("PAYTYPE_515"),
        debit_amount(F.col("value")).alias("DEBIT_AMOUNT_42"),
    )


def as_full_records(events: DataFrame) -> DataFrame:
    """Events in all 16 columns, in file order; what events do not have is empty."""
    known = {
        "CUST_LOCAL_START_DATE_15": F.date_format("ts", "yyyyMMddHHmmss").cast("bigint"),
        "CDR_ID_1": F.col("event_id").cast("string"),
        "CDR_TYPE_3": F.col("event_type"),
        "RECORD_DATE": F.date_format("ts", FULL.time_format),
        "PAYTYPE_515": pay_type(F.col("event_type")),
        "DEBIT_AMOUNT_42": debit_amount(F.col("value")),
        "CALLEDPARTYIMSI_495": F.col("user_id").cast("string"),
    }
    columns = [
        known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in FULL.schema
    ]
    return events.select(*columns)


def records(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(as_records(table(spark, folder, "events")))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream; the pattern fits one file as well as a folder of files."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*")


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(as_records(table_stream(spark, folder, "events")))


def plain_times(df: DataFrame, *names: str) -> DataFrame:
    """Times without a zone, as the tables have them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


DAILY_SQL = CDR + """
SELECT CAST(t AS DATE) AS date, CAST(sum(rev) AS DECIMAL(16,3)) AS total_revenue
FROM cdr GROUP BY 1 ORDER BY 1"""

REVENUE_SQL = CDR + f"""
SELECT code AS PAYTYPE_515, CAST(sum(rev) AS DECIMAL(16,3)) AS revenue, {SLOT} AS interval_start
FROM cdr GROUP BY 1, 3 ORDER BY 3, 1"""

MIN_MAX_SQL = CDR + f"""
SELECT code AS PAYTYPE_515, min(rev) AS min_revenue, max(rev) AS max_revenue,
       {SLOT} AS interval_start
FROM cdr GROUP BY 1, 4 ORDER BY 4, 1"""


def named_sql(names: str, having: str = "") -> str:
    return CDR + f"""
SELECT m.value AS value, count(*) AS record_count, CAST(sum(rev) AS DECIMAL(16,3)) AS revenue,
       {SLOT} AS interval_start
FROM cdr LEFT JOIN {names} ON cdr.code = m.c GROUP BY 1, 4 {having} ORDER BY 4, 1"""


NAMED_SQL = named_sql(NAMED)


@checked_by(DAILY_SQL)
def daily_revenue(spark, folder):
    return reports.daily_revenue(records(spark, folder))


@checked_by(REVENUE_SQL)
def interval_revenue(spark, folder):
    return plain_times(reports.interval_revenue(records(spark, folder)), "interval_start")


@checked_by(MIN_MAX_SQL)
def interval_min_max(spark, folder):
    return plain_times(reports.interval_min_max(records(spark, folder)), "interval_start")


@checked_by(NAMED_SQL)
def interval_count_by_name(spark, folder):
    named = reports.interval_count_by_name(records(spark, folder), builtin_mapping(spark, NAMES))
    return plain_times(named, "interval_start")


@checked_by(named_sql("(VALUES (0, 'Prepaid'), (1, 'Postpaid')) AS m(c, value)"))
def interval_count_by_fallback_name(spark, folder):
    mapping = load_mapping(spark, new_folder(spark, "absent") + ".csv", fallback=NAMES[:2])
    named = reports.interval_count_by_name(records(spark, folder), mapping)
    return plain_times(named, "interval_start")


@checked_by(
    named_sql(
        "(VALUES (0, 'Prepaid'), (0, 'Prepaid'), (0, 'Gift'), (1, 'Postpaid')) AS m(c, value)"
    )
)
def interval_count_repeated_codes(spark, folder):
    mapping = builtin_mapping(spark, [NAMES[0], NAMES[0], (0, "Gift"), NAMES[1]])
    named = reports.interval_count_by_name(records(spark, folder), mapping)
    return plain_times(named, "interval_start")


@checked_by(
    named_sql(
        "(SELECT DISTINCT code AS c, event_type AS value FROM (SELECT event_type, "
        "CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 "
        "WHEN 'view' THEN 3 END AS code FROM events) WHERE code IS NOT NULL) AS m"
    )
)
def interval_count_by_file_names(spark, folder):
    path = new_folder(spark, "mapping")
    coded = table(spark, folder, "events").select(
        pay_type(F.col("event_type")).alias("PayType"), F.col("event_type").alias("value")
    )
    coded.filter("PayType IS NOT NULL").distinct().write.option("header", True).csv(path)
    mapping = load_mapping(spark, path, validate_unique=True)
    named = reports.interval_count_by_name(records(spark, folder), mapping)
    return plain_times(named, "interval_start")


@checked_by(CDR + "SELECT t AS timestamp, code AS PAYTYPE_515, rev AS revenue_toman FROM cdr")
def prepared_records(spark, folder):
    prepared = records(spark, folder).select("timestamp", "PAYTYPE_515", "revenue_toman")
    return plain_times(prepared, "timestamp")


@checked_by(CDR + "SELECT count(*) AS record_count FROM cdr")
def record_count(spark, folder):
    return records(spark, folder).agg(F.count("*").alias("record_count"))


@checked_by(CDR + """
SELECT CAST(t AS DATE) AS date, CAST(sum(rev) AS DECIMAL(16,3)) AS total_revenue
FROM cdr GROUP BY 1 ORDER BY 1 LIMIT 10""")
def daily_revenue_preview(spark, folder):
    return preview(reports.daily_revenue(records(spark, folder)), 10)


@checked_by(REVENUE_SQL.replace("ORDER BY 3, 1", "ORDER BY 3, 1 NULLS FIRST LIMIT 10"))
def interval_revenue_preview(spark, folder):
    report = reports.interval_revenue(records(spark, folder))
    return plain_times(preview(report, 10), "interval_start")


@checked_by(MIN_MAX_SQL.replace("ORDER BY 4, 1", "ORDER BY 4, 1 NULLS FIRST LIMIT 20"))
def interval_min_max_preview(spark, folder):
    report = reports.interval_min_max(records(spark, folder))
    return plain_times(preview(report, 20), "interval_start")


def one_pass(spark, folder):
    return report_set(records(spark, folder), builtin_mapping(spark, NAMES))


@checked_by(DAILY_SQL)
def one_pass_daily_revenue(spark, folder):
    return one_pass(spark, folder).daily_revenue


@checked_by(REVENUE_SQL)
def one_pass_interval_revenue(spark, folder):
    return plain_times(one_pass(spark, folder).interval_revenue, "interval_start")


@checked_by(MIN_MAX_SQL)
def one_pass_interval_min_max(spark, folder):
    return plain_times(one_pass(spark, folder).interval_min_max, "interval_start")


@checked_by(NAMED_SQL)
def one_pass_interval_count_by_name(spark, folder):
    return plain_times(one_pass(spark, folder).interval_count_by_name, "interval_start")


TARGETS = ("first", "second")
CLOSED_DAYS = f"(SELECT max(CAST(t AS DATE)) FROM cdr WHERE {SLOT} + INTERVAL '15 minutes' <= {CLOSED})"


def written_sql(closed: bool = False) -> str:
    """All rows of the four reports at both targets, of closed intervals and days if asked."""
    days = f"HAVING CAST(t AS DATE) < {CLOSED_DAYS}" if closed else ""
    slots = f"HAVING {SLOT} + INTERVAL '15 minutes' <= {CLOSED}" if closed else ""
    money = "CAST({} AS DECIMAL(16,3))"
    return CDR + f"""
SELECT target, r.* FROM (VALUES ('first'), ('second')) AS targets(target), (
  SELECT 'daily_revenue' AS report, CAST(CAST(t AS DATE) AS TIMESTAMP) AS starts, NULL AS name,
         NULL::BIGINT AS record_count, {money.format("sum(rev)")} AS amount,
         NULL::DECIMAL(16,3) AS most
  FROM cdr GROUP BY CAST(t AS DATE) {days}
  UNION ALL SELECT 'interval_revenue', {SLOT}, CAST(code AS VARCHAR), NULL,
         {money.format("sum(rev)")}, NULL
  FROM cdr GROUP BY {SLOT}, code {slots}
  UNION ALL SELECT 'interval_min_max', {SLOT}, CAST(code AS VARCHAR), NULL,
         {money.format("min(rev)")}, {money.format("max(rev)")}
  FROM cdr GROUP BY {SLOT}, code {slots}
  UNION ALL SELECT 'interval_count_by_name', {SLOT}, m.value, count(*),
         {money.format("sum(rev)")}, NULL
  FROM cdr LEFT JOIN {NAMED} ON cdr.code = m.c GROUP BY {SLOT}, m.value {slots}) AS r"""


def written_rows(
    spark: SparkSession,
    targets: dict[str, str],
    readers: dict[str, Callable[[str, str], DataFrame]] | None = None,
) -> DataFrame:
    """The four reports written as CSV below each target, in common columns."""

    def read(place: str, schema: str) -> DataFrame:
        reader = spark.read.schema(schema).option("header", True)
        return reader.option("recursiveFileLookup", True).csv(place)

    money, none = "decimal(16,3)", F.lit(None)
    layouts = {
        "daily_revenue": (
            f"date date, total_revenue {money}",
            [F.col("date").cast("timestamp"), none, none, F.col("total_revenue"), none],
        ),
        "interval_revenue": (
            f"PAYTYPE_515 int, revenue {money}, interval_start timestamp",
            [F.col("interval_start"), F.col("PAYTYPE_515"), none, F.col("revenue"), none],
        ),
        "interval_min_max": (
            f"PAYTYPE_515 int, min_revenue {money}, max_revenue {money}, interval_start timestamp",
            [F.col("interval_start"), F.col("PAYTYPE_515"), none, F.col("min_revenue"),
             F.col("max_revenue")],
        ),
        "interval_count_by_name": (
            f"value string, record_count bigint, revenue {money}, interval_start timestamp",
            [F.col("interval_start"), F.col("value"), F.col("record_count"), F.col("revenue"), none],
        ),
    }
    names = {"starts": "timestamp_ntz", "name": "string", "record_count": "bigint",
             "amount": money, "most": money}
    parts = []
    for target, place in targets.items():
        for report, (schema, columns) in layouts.items():
            written = (readers or {}).get(target, read)(f"{place}/{FOLDERS[report]}", schema)
            typed = [
                column.cast(kind).alias(name)
                for column, (name, kind) in zip(columns, names.items(), strict=True)
            ]
            parts.append(
                written.select(F.lit(target).alias("target"), F.lit(report).alias("report"), *typed)
            )
    return reduce(DataFrame.unionByName, parts)


@checked_by(written_sql())
def written_reports(spark, folder):
    """All four reports written as CSV to two targets, and every row read back from both."""
    targets = {name: new_folder(spark, name) for name in TARGETS}
    run_reports(records(spark, folder), builtin_mapping(spark, NAMES), [*targets.values()])
    return written_rows(spark, targets)


@checked_by(CDR + """, daily AS (
  SELECT CAST(t AS DATE) AS date, CAST(sum(rev) AS DECIMAL(16,3)) AS total_revenue
  FROM cdr GROUP BY 1)
SELECT 'first' AS target, * FROM daily UNION ALL SELECT 'second', * FROM daily""")
def daily_revenue_two_targets(spark, folder):
    targets = {name: new_folder(spark, name) for name in ("first", "second")}
    write_report(reports.daily_revenue(records(spark, folder)), [*targets.values()], True)
    both = [
        spark.read.schema("date date, total_revenue decimal(16,3)")
        .option("header", True)
        .csv(path)
        .withColumn("target", F.lit(name))
        for name, path in targets.items()
    ]
    return both[0].unionByName(both[1])


def full_record_files(spark, folder) -> str:
    path = new_folder(spark, "records")
    as_full_records(table(spark, folder, "events")).write.option("header", True).csv(path)
    return path


@checked_by(REVENUE_SQL)
def csv_interval_revenue(spark, folder):
    """From the 16-column text files on."""
    prepared = prepare(read_cdr(spark, full_record_files(spark, folder), strict_header=True))
    return plain_times(reports.interval_revenue(prepared), "interval_start")


@checked_by("""
SELECT CAST(ts AS DATE) AS date, round(sum(CAST(round(value * 1000) AS BIGINT) / 1000), 3)
       AS total_revenue
FROM events GROUP BY 1""")
def csv_brief_daily_revenue(spark, folder):
    """From the three-column text files on: the other time format, divisor and type."""
    path = new_folder(spark, "brief")
    brief = table(spark, folder, "events").select(
        F.date_format("ts", BRIEF.time_format).alias("RECORD_DATE"),
        pay_type(F.col("event_type")).alias("PayType"),
        F.round(F.col("value") * 1000).cast("bigint").alias("Debit_amount_42"),
    )
    brief.write.option("header", True).csv(path)
    daily = reports.daily_revenue(prepare(read_cdr(spark, path, BRIEF), BRIEF))
    return daily.withColumn("total_revenue", F.round("total_revenue", 3))


@checked_by(DAILY_SQL)
def landed_daily_revenue(spark, folder):
    """From the daily Parquet folders on."""
    path = new_folder(spark, "landed")
    land_cdr(records(spark, folder), path)
    return reports.daily_revenue(read_landed_cdr(spark, path))


@checked_by(REVENUE_SQL)
def refreshed_interval_revenue(spark, folder):
    """One day is landed in part at first; when it is landed again, only that day is read."""
    landed, rolled = new_folder(spark, "landed"), new_folder(spark, "rolled")
    prepared = records(spark, folder)
    late = F.to_date("timestamp") == F.lit("2024-01-15")
    land_cdr(prepared.filter(~late | (F.col("PAYTYPE_515") == 0)), landed)
    refresh_roll_up(spark, landed, rolled)
    land_cdr(prepared.filter(late), landed)
    numbers = refresh_roll_up(spark, landed, rolled)
    if numbers["read"] != 1 or numbers["dropped"]:
        raise AssertionError(f"one day was to be read again, not {numbers}")
    made = reports_from(read_roll_up(spark, rolled), builtin_mapping(spark, NAMES))
    return plain_times(made.interval_revenue, "interval_start")


@checked_by("""
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(10,3)) * CAST(0.0001 AS DECIMAL(5,4))
            AS DECIMAL(6,3)) AS revenue
FROM lineitem""")
def converted_decimal_amounts(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        convert_amount(
            F.col("l_extendedprice").cast("decimal(10,3)"), FULL.divisor, FULL.revenue_type
        ).alias("revenue"),
    )


@checked_by("""
SELECT l_orderkey, l_linenumber, round(CAST(floor(l_extendedprice) AS BIGINT) / 1000, 6) AS revenue
FROM lineitem""")
def converted_whole_amounts(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(
            convert_amount(
                F.floor("l_extendedprice").cast("bigint"), BRIEF.divisor, BRIEF.revenue_type
            ),
            6,
        ).alias("revenue"),
    )


def mixed_times(spark, folder) -> DataFrame:
    """Order dates as text: pending orders in one format, all others in the other."""
    text = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", BRIEF.time_format)
    ).otherwise(F.date_format("o_orderdate", FULL.time_format))
    return table(spark, folder, "orders").select("o_orderkey", text.alias("text"))


def parsed_times(spark, folder, pattern) -> DataFrame:
    parsed = with_event_time(mixed_times(spark, folder), "text", pattern)
    return plain_times(parsed.select("o_orderkey", "timestamp"), "timestamp")


@checked_by("SELECT o_orderkey, o_orderdate AS timestamp FROM orders WHERE o_orderstatus <> 'P'")
def parsed_date_first_times(spark, folder):
    return parsed_times(spark, folder, FULL.time_format)


@checked_by("SELECT o_orderkey, o_orderdate AS timestamp FROM orders WHERE o_orderstatus = 'P'")
def parsed_time_first_times(spark, folder):
    return parsed_times(spark, folder, BRIEF.time_format)


# --- keyed dimension ------------------------------------------------------------------


def dimension_files(spark, folder) -> str:
    """Customers, suppliers and parts in three header layouts in one folder.

    Overdrawn customers have no code, suppliers have white space around their names, and
    large parts have nothing in the first of their two name columns.
    """
    path = new_folder(spark, "dimension")
    nation = table(spark, folder, "nation")

    def write(df: DataFrame) -> None:
        df.write.mode("append").options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)

    customers = table(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    write(
        customers.select(
            F.col("c_name").alias("city"),
            F.when(F.col("c_acctbal") >= 0, F.col("n_name")).otherwise("").alias("countyCode"),
        )
    )
    suppliers = table(spark, folder, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    write(
        suppliers.select(
            F.col("n_name").alias("CountryCode"),
            F.concat(F.lit(" \t"), F.col("s_name"), F.lit("  ")).alias("Name"),
            F.col("s_acctbal").alias("balance"),
        )
    )
    parts = table(spark, folder, "part").orderBy("p_partkey")
    write(
        parts.select(
            F.when(F.col("p_size") < 25, F.col("p_name")).otherwise("").alias("city"),
            F.upper("p_name").alias("Name"),
            F.col("p_brand").alias("country_code"),
        )
    )
    return path


FILE_ROWS = """
WITH file_rows AS (
  SELECT c_name AS name, CASE WHEN c_acctbal >= 0 THEN n_name END AS code, 0 AS pos
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT s_name, n_name, 0 FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT CASE WHEN p_size < 25 THEN p_name ELSE upper(p_name) END, p_brand, p_partkey FROM part)
"""


@checked_by(FILE_ROWS + "SELECT name, code AS country_code FROM file_rows WHERE code IS NOT NULL")
def accepted_rows(spark, folder):
    rows = read_dimension_files(spark, dimension_files(spark, folder))
    return rows.filter("accepted").select("name", "country_code")


@checked_by(FILE_ROWS + "SELECT name, code AS country_code FROM file_rows WHERE code IS NULL")
def rejected_rows(spark, folder):
    loaded = load_dimension(spark, dimension_files(spark, folder))
    return loaded.rejected.select("name", "country_code")


@checked_by(FILE_ROWS + """
SELECT count(*) AS total, count(code) AS succeeded, count(*) - count(code) AS failed
FROM file_rows""")
def load_counters(spark, folder):
    return dim.load_counters(read_dimension_files(spark, dimension_files(spark, folder)))


@checked_by(FILE_ROWS + """
SELECT name, arg_max(code, pos) AS country_code FROM file_rows WHERE code IS NOT NULL GROUP BY 1""")
def dimension_of_files(spark, folder):
    rows = read_dimension_files(spark, dimension_files(spark, folder))
    return dimension_from(rows.filter("accepted"))


@checked_by("""
SELECT c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE n_name END
       AS country_code
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def dimension_after_two_loads(spark, folder):
    stored = new_folder(spark, "stored")
    for files in two_loads(spark, folder):
        load_into(spark, files, stored)
    return read_dimension(spark, stored)


@checked_by(FILE_ROWS + """
SELECT 'first' AS load, total, succeeded, failed, name FROM (
  SELECT count(*) AS total, count(code) AS succeeded, count(*) - count(code) AS failed
  FROM file_rows), (SELECT name FROM file_rows WHERE code IS NULL)""")
def kept_load(spark, folder):
    """The counters of a load and the rows that it rejected, read from where they are kept."""
    history = new_folder(spark, "history")
    files, stored = dimension_files(spark, folder), new_folder(spark, "stored")
    for _ in range(2):  # a load that is repeated replaces itself
        load_into(spark, files, stored, history=history, load="first")
    counters, rejected = read_loads(spark, history)
    return rejected.select("load", "name").join(F.broadcast(counters), "load")


def two_loads(spark, folder) -> tuple[str, str]:
    """Files of all customers, then some that change a few of them and add suppliers."""
    first, second = new_folder(spark, "first"), new_folder(spark, "second")
    nation = table(spark, folder, "nation")
    customers = table(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    suppliers = table(spark, folder, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    building = customers.filter("c_mktsegment = 'BUILDING'")
    customers.select(F.col("c_name").alias("city"), F.col("n_name").alias("countyCode")).write.option(
        "header", True
    ).csv(first)
    changed = building.select(
        F.col("c_mktsegment").alias("CountryCode"), F.col("c_name").alias("name")
    ).unionByName(
        suppliers.select(F.col("n_name").alias("CountryCode"), F.col("s_name").alias("name"))
    )
    changed.write.option("header", True).csv(second)
    return first, second


@checked_by("""
SELECT c_name || chr(10) || c_mktsegment AS name, n_name AS country_code
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dimension_with_line_breaks(spark, folder):
    """Names that hold a line break, in quotes."""
    path = new_folder(spark, "breaks")
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    name = F.concat_ws("\n", "c_name", "c_mktsegment").alias("City")
    customers.select(name, F.col("n_name").alias("CountryCode")).write.options(
        header=True, quoteAll=True, escape='"'
    ).csv(path)
    return dimension_from(load_dimension(spark, path).accepted)


@checked_by(SQL["dimension_after_two_loads"])
def dimension_in_a_catalog_table(spark, folder):
    """The same two loads into one table of the catalog that everybody reads."""
    name = f"dimension_{uuid4().hex}"
    empty = empty_dimension(spark)
    empty.write.option("path", new_folder(spark, "table")).format("parquet").saveAsTable(name)
    for files in two_loads(spark, folder):
        load_into(spark, files, table=name)
    return read_dimension(spark, table=name)


UPDATED_KEY = "CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END"
PRIORITIES = f"""
WITH newest AS (
  SELECT {UPDATED_KEY} AS key, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority
  FROM orders GROUP BY 1)
"""


def priorities(orders: DataFrame) -> DataFrame:
    """Orders as updates: the label becomes the order's priority.

    Most have the key of a customer; orders of low priority have keys that no customer has.
    """
    return orders.select(
        F.expr(UPDATED_KEY).alias("key"),
        F.col("o_orderpriority").alias("label"),
        "o_orderdate",
        "o_orderkey",
    )


def segments(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer")
    return customers.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label"))


@checked_by(PRIORITIES + "SELECT key, priority AS label FROM newest")
def last_write_per_key(spark, folder):
    updates = priorities(table(spark, folder, "orders"))
    return dim.last_write(updates, "key", ["o_orderdate", "o_orderkey"], ["label"])


@checked_by(PRIORITIES + """
SELECT coalesce(c_custkey, key) AS key, coalesce(priority, c_mktsegment) AS label
FROM customer FULL JOIN newest ON c_custkey = key""")
def upsert_last_write(spark, folder):
    """Segments of all customers, overwritten and extended by order priorities."""
    updates = priorities(table(spark, folder, "orders"))
    base = segments(spark, folder)
    return dim.upsert(base, updates, "key", ["o_orderdate", "o_orderkey"], ["label"])


@checked_by(SQL["upsert_last_write"])
def upsert_last_write_shuffled(spark, folder):
    """The same without a broadcast, as for updates of very many keys."""
    updates = priorities(table(spark, folder, "orders"))
    base = segments(spark, folder)
    order = ["o_orderdate", "o_orderkey"]
    return dim.upsert(base, updates, "key", order, ["label"], max_rows=0)


@checked_by(SQL["upsert_last_write"])
def upsert_in_buckets(spark, folder):
    """The same updates year by year, into a table of which a merge rewrites some buckets."""
    path = new_folder(spark, "buckets")
    write_version(segments(spark, folder), path)
    updates = priorities(table(spark, folder, "orders"))
    years = F.year("o_orderdate")
    for part in (years < 1993, *[years == year for year in range(1993, 1998)], years > 1997):
        merge_buckets(
            updates.filter(part), path, "key", ["o_orderdate", "o_orderkey"], ["label"], 16, keep=1, min_age=0
        )
    return read_dimension(spark, path)


# Ten days each: of the first month of events, the early, middle and late ones.
THIRDS = [
    "ts < TIMESTAMP_NTZ '2024-01-11'",
    "ts >= TIMESTAMP_NTZ '2024-01-11' AND ts < TIMESTAMP_NTZ '2024-01-21'",
    "ts >= TIMESTAMP_NTZ '2024-01-21'",
]


# --- lookups and their log ------------------------------------------------------------

CITIES = """
WITH cities AS (
  SELECT c_name AS name, n_name AS country_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
requests AS (
  SELECT event_id AS request_id, ts,
         printf(CASE WHEN event_type = 'error' THEN 'Nobody#%09d' ELSE 'Customer#%09d' END,
                user_id) AS city,
         value AS response_time, event_type = 'view' AS hit,
         CASE WHEN event_type = 'view' THEN 'HIT' ELSE 'MISS' END AS cache_status
  FROM events)
"""


def city_requests(events: DataFrame) -> DataFrame:
    """Events as lookup requests; views count as hits, and errors ask for unknown names."""
    pattern = F.when(F.col("event_type") == "error", "Nobody#").otherwise("Customer#")
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(pattern, F.format_string("%09d", "user_id")).alias("city"),
        F.col("value").alias("response_time"),
        (F.col("event_type") == "view").alias("hit"),
        cache_status(F.col("event_type") == "view").alias("cache_status"),
    )


def cities(spark, folder) -> DataFrame:
    """Nations of all customers."""
    customers, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("name"), F.col("n_name").alias("country_code")
    )


def request_table(spark, folder) -> DataFrame:
    return city_requests(table(spark, folder, "events"))


@checked_by(CITIES + """
SELECT request_id, city, country_code, name IS NOT NULL AS found
FROM requests LEFT JOIN cities ON city = name""")
def lookup_all(spark, folder):
    asked = request_table(spark, folder).select("request_id", "city")
    return dim.lookup(asked, cities(spark, folder))


@checked_by(CITIES + """
SELECT request_id, city, country_code, name IS NOT NULL AS found
FROM requests LEFT JOIN cities ON city = name""")
def lookup_all_shuffled(spark, folder):
    """The same without a broadcast, as for a dimension too large for one."""
    asked = request_table(spark, folder).select("request_id", "city")
    return dim.lookup(asked, cities(spark, folder), max_bytes=0, unique="request_id")


@checked_by(CITIES + """
SELECT city, country_code, name IS NOT NULL AS found
FROM requests LEFT JOIN cities ON city = name""")
def lookup_of_keys_alone(spark, folder):
    """Requests that hold nothing but their key, so that many are equal; shuffled."""
    asked = request_table(spark, folder).select("city")
    return dim.lookup(asked, cities(spark, folder), max_bytes=0)


@checked_by(CITIES + """
SELECT request_id, city, country_code, true AS found FROM requests JOIN cities ON city = name""")
def lookup_found(spark, folder):
    asked = request_table(spark, folder).select("request_id", "city")
    return dim.lookup(asked, cities(spark, folder), how="inner")


@checked_by(CITIES + """
SELECT request_id, city FROM requests WHERE city NOT IN (SELECT name FROM cities)""")
def lookup_unfound(spark, folder):
    asked = request_table(spark, folder).select("request_id", "city")
    return dim.lookup(asked, cities(spark, folder), how="left_anti")


@checked_by(CITIES + """
SELECT name, country_code FROM cities WHERE name = 'Customer#000000042'""")
def find_one(spark, folder):
    return dim.find(cities(spark, folder), "name", "Customer#000000042")


PERCENTAGE = "CAST((hits * 20000 + n) // (2 * n) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2))"


@checked_by(CITIES + f"""
SELECT n AS total_requests, hits AS cache_hits, {PERCENTAGE} AS cache_hit_percentage
FROM (SELECT count(*) AS n, count(*) FILTER (hit) AS hits FROM requests)""")
def request_stats(spark, folder):
    return requests.request_stats(request_table(spark, folder))


RUNNING = """
SELECT request_id, ts, count(*) OVER w AS n, count(*) FILTER (hit) OVER w AS hits
FROM requests WINDOW w AS (ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING)"""


@checked_by(CITIES + f"""
SELECT request_id, ts, n AS running_requests, hits AS running_hits,
       {PERCENTAGE} AS cache_hit_percentage
FROM ({RUNNING})""")
def running_hit_rate(spark, folder):
    log = request_table(spark, folder).select("request_id", "ts", "hit")
    return plain_times(ordered.running_hit_rate(log), "ts").drop("hit")


@checked_by(SQL["running_hit_rate"])
def running_hit_rate_in_ranges(spark, folder):
    """The same with many ranges, as for a large log."""
    log = request_table(spark, folder).select("request_id", "ts", "hit")
    return plain_times(ordered.running_hit_rate(log, rows_per_range=500), "ts").drop("hit")


REPEATS = """
SELECT request_id, ts, city, previous_ts,
       coalesce(ts < previous_ts + INTERVAL 600 SECOND, false) AS repeated
FROM (SELECT *, lag(ts) OVER (PARTITION BY city ORDER BY ts, request_id) AS previous_ts
      FROM requests)"""


@checked_by(CITIES + REPEATS)
def repeat_within_ttl(spark, folder):
    asked = request_table(spark, folder).select("request_id", "ts", "city")
    return plain_times(ordered.repeat_within(asked), "ts", "previous_ts")


@checked_by(CITIES + REPEATS)
def repeat_within_ttl_in_ranges(spark, folder):
    """The same with many ranges, as for a large log."""
    asked = request_table(spark, folder).select("request_id", "ts", "city")
    repeats = ordered.repeat_within(asked, rows_per_range=500)
    return plain_times(repeats, "ts", "previous_ts")


# Three of four requests ask for one name.
HOT = CITIES + """,
hot AS (
  SELECT request_id, ts, CASE WHEN request_id % 4 > 0 THEN 'Customer#hot' ELSE city END AS city
  FROM requests)
"""


@checked_by(HOT + REPEATS.replace("FROM requests", "FROM hot"))
def repeat_within_ttl_in_a_tree(spark, folder):
    """One key with most rows, cut in two levels, as where one list of cut points is too short."""
    name = F.when(F.col("request_id") % 4 > 0, "Customer#hot").otherwise(F.col("city"))
    asked = request_table(spark, folder).select("request_id", "ts", name.alias("city"))
    rows = asked.count()
    repeats = ordered.repeat_within(asked, rows_per_range=max(1, rows // 64), coarse_ranges=8)
    return plain_times(repeats, "ts", "previous_ts")


@checked_by(SQL["running_hit_rate"])
def running_hit_rate_of_loads(spark, folder):
    """The log arrives in three loads; each reads only itself and the totals before it."""
    rated, closed = new_folder(spark, "rated"), new_folder(spark, "closed")
    events = table(spark, folder, "events")
    for number, third in enumerate(THIRDS):
        log = city_requests(events.filter(third)).select("request_id", "ts", "hit")
        rate_load(log, f"load{number}", rated, closed)
    return plain_times(spark.read.parquet(rated), "ts").drop("hit", "load")


@checked_by(CITIES + f""",
repeats AS ({REPEATS}),
judged AS (
  SELECT r.request_id, r.ts, r.city, country_code, name IS NOT NULL AS found, response_time,
         (name IS NOT NULL AND repeated) AS hit
  FROM requests r JOIN repeats USING (request_id) LEFT JOIN cities ON r.city = name),
counted AS (
  SELECT *, count(*) OVER w AS n, count(*) FILTER (hit) OVER w AS hits
  FROM judged WINDOW w AS (ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING))
SELECT request_id, ts, city, country_code, found, response_time,
       CASE WHEN hit THEN 'HIT' ELSE 'MISS' END AS cache_status,
       {PERCENTAGE} AS cache_hit_percentage
FROM counted""")
def answered_requests(spark, folder):
    asked = request_table(spark, folder).select("request_id", "ts", "city", "response_time")
    return plain_times(answer_requests(asked, cities(spark, folder)), "ts")


@checked_by(CITIES + """
SELECT city, max(ts) AS last_request FROM requests GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def recent_keys(spark, folder):
    return plain_times(requests.recent_keys(request_table(spark, folder)), "last_request")


@checked_by(CITIES + """
SELECT city, max(ts) AS last_request FROM requests GROUP BY 1 ORDER BY 2, 1 LIMIT 1""")
def oldest_key(spark, folder):
    return plain_times(requests.oldest_key(request_table(spark, folder)), "last_request")


@checked_by(CITIES + """
SELECT time_bucket(INTERVAL '1 day', ts) AS interval_start, cache_status, count(*) AS requests,
       round(avg(response_time), 6) AS mean_response, max(response_time) AS max_response,
       list_sort(list(response_time))[(95 * count(*) + 99) // 100] AS p95_response
FROM requests GROUP BY 1, 2""")
def response_times(spark, folder):
    times = requests.response_times(request_table(spark, folder))
    rounded = times.withColumn("mean_response", F.round("mean_response", 6))
    return plain_times(rounded, "interval_start")


@checked_by(CITIES + """
SELECT interval_start, cache_status, count(*) AS requests,
       round(avg(response_time), 6) AS mean_response, max(response_time) AS max_response,
       true AS rank_is_close
FROM (SELECT date_trunc('day', ts) AS interval_start, * FROM requests
      UNION ALL SELECT NULL, * FROM requests)
GROUP BY 1, 2""")
def response_times_of_a_roll_up(spark, folder):
    """Days and the whole time, from one table of quarter hours with sketches of the quantiles.

    The rank of each quantile is counted in the requests themselves.
    """
    log = request_table(spark, folder)
    return checked_response_times(log, cut_lineage(requests.response_roll_up(log)))


def checked_response_times(log: DataFrame, rolled: DataFrame) -> DataFrame:
    days = requests.response_times_from(rolled)
    always = requests.response_times_from(rolled, width=None)
    times = days.unionByName(always.withColumn("interval_start", F.lit(None).cast("timestamp")))
    starts = F.array(F.date_trunc("day", "ts"), F.lit(None).cast("timestamp"))
    own = log.select(
        F.col("cache_status").alias("status"), F.explode(starts).alias("start"), "response_time"
    )
    inside = (F.col("cache_status") == F.col("status")) & F.col("interval_start").eqNullSafe(
        F.col("start")
    )
    counted = times.join(own, inside).groupBy(*times.columns).agg(
        F.count_if(F.col("response_time") <= F.col("p95_response")).alias("below"),
        F.count_if(F.col("response_time") < F.col("p95_response")).alias("under"),
    )
    off = F.greatest(
        F.col("under") / F.col("requests") - 0.95, 0.95 - F.col("below") / F.col("requests")
    )
    # An exact quantile of few requests is off by up to one of them.
    close = off <= 0.02 + 1 / F.col("requests")
    rounded = counted.withColumn("mean_response", F.round("mean_response", 6))
    judged = rounded.withColumn("rank_is_close", close)
    return plain_times(judged, "interval_start").drop("below", "under", "p95_response")


LOG_SQL = CITIES + f"""
SELECT request_id, r.ts, city, response_time, cache_status,
       CAST({PERCENTAGE} AS DOUBLE) AS cache_hit_percentage
FROM requests r JOIN ({RUNNING}) USING (request_id)"""


def log_files(spark, folder) -> str:
    path = new_folder(spark, "log")
    rated = ordered.running_hit_rate(request_table(spark, folder))
    percentage = F.col("cache_hit_percentage").cast("double")
    write_request_log(rated.withColumn("cache_hit_percentage", percentage), path)
    return path


@checked_by(LOG_SQL)
def request_log_files(spark, folder):
    return plain_times(read_request_log(spark, log_files(spark, folder)), "ts")


# --- streams --------------------------------------------------------------------------

AT_ONCE = {"availableNow": True}


def appended(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run an append query over all there is, and read what it wrote."""
    path = new_folder(spark, "stream")
    query = stream_appended(stream, path, new_folder(spark, "checkpoint"), trigger=AT_ONCE)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@checked_by(CDR + f"""
SELECT CAST(t AS DATE) AS date, CAST(sum(rev) AS DECIMAL(16,3)) AS total_revenue
FROM cdr GROUP BY 1 HAVING CAST(t AS DATE) + INTERVAL '1 day' <= {CLOSED}""")
def stream_daily_append(spark, folder):
    return appended(spark, reports.daily_revenue(record_stream(spark, folder)))


def closed_sql(sql: str, order: str) -> str:
    closed = f"HAVING {SLOT} + INTERVAL '15 minutes' <= {CLOSED}"
    return sql.replace(order, closed)


@checked_by(closed_sql(REVENUE_SQL, "ORDER BY 3, 1"))
def stream_interval_append(spark, folder):
    report = appended(spark, reports.interval_revenue(record_stream(spark, folder)))
    return plain_times(report, "interval_start")


@checked_by(closed_sql(MIN_MAX_SQL, "ORDER BY 4, 1"))
def stream_min_max_append(spark, folder):
    report = appended(spark, reports.interval_min_max(record_stream(spark, folder)))
    return plain_times(report, "interval_start")


@checked_by(closed_sql(NAMED_SQL, "ORDER BY 4, 1"))
def stream_named_append(spark, folder):
    named = reports.interval_count_by_name(
        record_stream(spark, folder), builtin_mapping(spark, NAMES)
    )
    return plain_times(appended(spark, named), "interval_start")


@checked_by(closed_sql(REVENUE_SQL, "ORDER BY 3, 1"))
def stream_csv_interval_append(spark, folder):
    """From the 16-column text files on."""
    source = prepare(stream_cdr(spark, full_record_files(spark, folder)))
    return plain_times(appended(spark, reports.interval_revenue(source)), "interval_start")


@checked_by(closed_sql(NAMED_SQL, "ORDER BY 4, 1"))
def stream_roll_up_by_name(spark, folder):
    """One stream keeps the roll-up; the named report is made from its table."""
    rolled = appended(spark, rollup.roll_up(record_stream(spark, folder)))
    named = reports_from(rolled, builtin_mapping(spark, NAMES)).interval_count_by_name
    return plain_times(named, "interval_start")


@checked_by(written_sql(closed=True))
def stream_written_reports(spark, folder):
    """All four reports of one stream, read once and written as CSV to two targets."""
    targets = {name: new_folder(spark, name) for name in TARGETS}
    start_reports(
        record_stream(spark, folder),
        builtin_mapping(spark, NAMES),
        [*targets.values()],
        new_folder(spark, "checkpoint"),
        trigger=AT_ONCE,
    ).awaitTermination()
    return written_rows(spark, targets)


@checked_by(SQL["upsert_last_write"])
def stream_upsert_last_write(spark, folder):
    """Order priorities arrive as a stream and are merged into a stored dimension."""
    path = new_folder(spark, "stored")
    write_version(segments(spark, folder), path)
    orders = table_stream(spark, folder, "orders")
    order = ["o_orderdate", "o_orderkey"]
    checkpoint = new_folder(spark, "checkpoint")
    stream_upsert(
        priorities(orders), path, checkpoint, "key", order, ["label"], trigger=AT_ONCE
    ).awaitTermination()
    return read_dimension(spark, path)


@checked_by(REVENUE_SQL)
def stream_interval_complete(spark, folder):
    path = new_folder(spark, "complete")
    report = reports.interval_revenue(record_stream(spark, folder))
    order = ["interval_start", "PAYTYPE_515"]
    checkpoint = new_folder(spark, "checkpoint")
    stream_complete(report, path, checkpoint, order, trigger=AT_ONCE).awaitTermination()
    return plain_times(read_complete(spark, path), "interval_start")


@checked_by(MIN_MAX_SQL)
def stream_min_max_update(spark, folder):
    path = new_folder(spark, "updates")
    report = reports.interval_min_max(record_stream(spark, folder))
    checkpoint = new_folder(spark, "checkpoint")
    stream_updates(report, path, checkpoint, trigger=AT_ONCE).awaitTermination()
    current = read_updates(spark, path, ["PAYTYPE_515", "interval_start"])
    return plain_times(current, "interval_start")


@checked_by(SQL["lookup_all"])
def stream_lookup(spark, folder):
    asked = city_requests(table_stream(spark, folder, "events")).select("request_id", "city")
    return appended(spark, dim.lookup(asked, cities(spark, folder)))


@checked_by(LOG_SQL)
def stream_request_log_files(spark, folder):
    log = stream_request_log(spark, log_files(spark, folder), max_files=4)
    return plain_times(appended(spark, log), "ts")


@checked_by(CITIES + """
SELECT request_id, city, response_time, cache_status,
       name IS NOT NULL AS found, country_code FROM requests LEFT JOIN cities ON city = name""")
def stream_lookup_log(spark, folder):
    """Answers of a stream, written as log messages and joined to the cities once more."""
    asked = city_requests(table_stream(spark, folder, "events"))
    answers = dim.lookup(asked, cities(spark, folder))
    path = new_folder(spark, "log")
    stream_messages(
        answers, new_folder(spark, "checkpoint"), path=path, trigger=AT_ONCE
    ).awaitTermination()
    log = read_request_log(spark, path).select(
        "request_id", "city", "response_time", "cache_status"
    )
    return dim.lookup(log, cities(spark, folder))


BATCHES = 160


def progress_sql(batches: int) -> str:
    return f"""
SELECT input_rows, count(*) AS batches, {batches} AS different_ids, 0 AS first_id,
       {batches - 1} AS last_id
FROM (SELECT count(*) AS input_rows FROM events GROUP BY event_id % {batches}) GROUP BY 1"""


@checked_by(progress_sql(BATCHES))
def stream_progress(spark, folder):
    """Every trigger of a stream of many small files, also those Spark itself forgets."""
    return progress_counts(progress_rows(spark, *progress_of_many(spark, folder, BATCHES)))


def progress_of_many(spark, folder, batches: int) -> tuple[str, StreamingQuery]:
    """Where the progress of an ended stream of many batches is kept, and the stream."""
    source, kept = new_folder(spark, "files"), new_folder(spark, "progress")
    parts = table(spark, folder, "events").select((F.col("event_id") % batches).alias("part"), "user_id")
    parts.repartitionById(batches, F.col("part").cast("int")).write.parquet(source)
    stream = spark.readStream.schema(parts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    listener = log_progress(spark, kept)
    try:
        path, checkpoint = new_folder(spark, "stream"), new_folder(spark, "checkpoint")
        query = stream_appended(stream, path, checkpoint, trigger=AT_ONCE)
        query.awaitTermination()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    return kept, query


def progress_counts(rows: DataFrame) -> DataFrame:
    rows = rows.filter("input_rows > 0")
    ids = rows.agg(
        F.count_distinct("batch_id").cast("int").alias("different_ids"),
        F.min("batch_id").cast("int").alias("first_id"),
        F.max("batch_id").cast("int").alias("last_id"),
    )
    counts = rows.groupBy("input_rows").agg(F.count("*").alias("batches"))
    return counts.withColumns({name: F.lit(n) for name, n in ids.first().asDict().items()})


@checked_by(progress_sql(40))
def stream_progress_joined(spark, folder):
    """The same after the files of all triggers were joined into one and then removed."""
    kept, query = progress_of_many(spark, folder, 40)
    for _ in range(2):
        join_progress(spark, kept, least=10, min_age=0)
    return progress_counts(progress_rows(spark, kept, query))


@checked_by(written_sql(closed=True))
def stream_written_reports_joined(spark, folder):
    """Report folders of three batches, joined for one target and as they are for the other."""
    source, add = event_files(spark, folder, THIRDS)
    for number in range(3):
        add(number)
    events = table(spark, folder, "events")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    targets = {name: new_folder(spark, name) for name in TARGETS}
    start_reports(
        prepare(as_records(reader.parquet(source))), builtin_mapping(spark, NAMES),
        [*targets.values()], new_folder(spark, "checkpoint"), trigger=AT_ONCE,
    ).awaitTermination()

    def joined(place: str, schema: str) -> DataFrame:
        for _ in range(2):
            join_batches(spark, place, schema, "csv", least=1, min_age=0)
        return read_batches(spark, place, schema, "csv")

    return written_rows(spark, targets, {"second": joined})


def event_files(spark, folder, wanted: list[str]) -> tuple[str, Callable[[int], None]]:
    """An empty folder and a function that adds the events of one condition as one file."""
    path = new_folder(spark, "files")
    events = table(spark, folder, "events")

    def add(number: int) -> None:
        events.filter(wanted[number]).coalesce(1).write.mode("append").parquet(path)

    return path, add


def files_stream(spark, folder, path: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reports.interval_revenue(prepare(as_records(reader.parquet(path))))


@checked_by(CDR + f"""
SELECT code AS PAYTYPE_515, CAST(sum(rev) AS DECIMAL(16,3)) AS revenue, {SLOT} AS interval_start
FROM cdr WHERE t < TIMESTAMP '2024-01-11' OR t >= TIMESTAMP '2024-01-21' GROUP BY 1, 3
HAVING {SLOT} + INTERVAL '15 minutes' <= {CLOSED}""")
def stream_late_files(spark, folder):
    """Files in the order late, early, middle: a batch is late against those before the last."""
    path, add = event_files(spark, folder, THIRDS)
    for number in (2, 0, 1):
        add(number)
    return plain_times(appended(spark, files_stream(spark, folder, path)), "interval_start")


@checked_by(closed_sql(REVENUE_SQL, "ORDER BY 3, 1"))
def stream_stopped_and_resumed(spark, folder):
    """A query on a timer is stopped after one file and goes on from its checkpoint."""
    path, add = event_files(spark, folder, THIRDS)
    out, checkpoint = new_folder(spark, "stream"), new_folder(spark, "checkpoint")
    add(0)
    stream = files_stream(spark, folder, path)
    first = stream_appended(stream, out, checkpoint, trigger={"processingTime": "1 second"})
    first.processAllAvailable()
    stop_all(spark)
    add(1)
    add(2)
    stream_appended(stream, out, checkpoint, trigger=AT_ONCE).awaitTermination()
    return plain_times(spark.read.schema(stream.schema).parquet(out), "interval_start")


@checked_by(SQL["upsert_last_write"])
def stream_upsert_of_many_batches(spark, folder):
    """Updates of one year after the other, written as changes and compacted now and then."""
    path, source = new_folder(spark, "stored"), new_folder(spark, "updates")
    write_version(segments(spark, folder), path)
    updates = priorities(table(spark, folder, "orders"))
    years = F.year("o_orderdate")
    for part in (years < 1993, *[years == year for year in range(1993, 1998)], years > 1997):
        updates.filter(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_upsert(
        stream, path, new_folder(spark, "checkpoint"), "key", ["o_orderdate", "o_orderkey"],
        ["label"], compact_every=3, trigger=AT_ONCE,
    ).awaitTermination()
    return read_dimension(spark, path)


@checked_by(MIN_MAX_SQL)
def stream_min_max_updates_joined(spark, folder):
    """Changes of several batches, joined every two batches."""
    path, add = event_files(spark, folder, THIRDS)
    for number in range(3):
        add(number)
    schema = table(spark, folder, "events").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    report = reports.interval_min_max(prepare(as_records(source)))
    keys, kept = ["PAYTYPE_515", "interval_start"], new_folder(spark, "updates")
    checkpoint = new_folder(spark, "checkpoint")
    stream_updates(
        report, kept, checkpoint, keys=keys, compact_every=2, trigger=AT_ONCE
    ).awaitTermination()
    return plain_times(read_updates(spark, kept, keys), "interval_start")


@checked_by(SQL["upsert_last_write"])
def stream_upsert_into_buckets(spark, folder):
    """Order priorities arrive as a stream; each batch rewrites the buckets that it touches."""
    path = new_folder(spark, "stored")
    write_version(segments(spark, folder), path)
    orders = table_stream(spark, folder, "orders")
    stream_upsert(
        priorities(orders), path, new_folder(spark, "checkpoint"), "key",
        ["o_orderdate", "o_orderkey"], ["label"], buckets=16, trigger=AT_ONCE,
    ).awaitTermination()
    return read_dimension(spark, path)


# Before the second third of the events, building customers change; before the last, names
# become known that were not.
LIVE = CITIES + """,
versions AS (
  SELECT c_name AS name, n_name AS first_code,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE n_name END AS later_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
unknown AS (SELECT 'Nobody' || substr(c_name, 9) AS name FROM customer),
answers AS (
  SELECT request_id, city,
         CASE WHEN ts < TIMESTAMP '2024-01-11' THEN v.first_code
              WHEN ts < TIMESTAMP '2024-01-21' THEN v.later_code
              ELSE coalesce(v.later_code, CASE WHEN u.name IS NOT NULL THEN 'NOWHERE' END) END
         AS country_code
  FROM requests r LEFT JOIN versions v ON r.city = v.name LEFT JOIN unknown u ON r.city = u.name)
"""


def dimension_updates(spark, folder) -> list[DataFrame]:
    """What is known at first, and two updates of it."""
    customers = table(spark, folder, "customer")
    building = customers.filter("c_mktsegment = 'BUILDING'")
    unknown = F.concat(F.lit("Nobody"), F.substr("c_name", F.lit(9)))
    return [
        cities(spark, folder),
        building.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("country_code")),
        customers.select(unknown.alias("name"), F.lit("NOWHERE").alias("country_code")),
    ]


def live_answers(spark, folder, update: Callable[[DataFrame], object], **dimension) -> DataFrame:
    """One running stream of lookups; the dimension is updated between its batches."""
    source, add = event_files(spark, folder, THIRDS)
    out = new_folder(spark, "answers")
    events = table(spark, folder, "events")
    events.limit(0).write.parquet(source)  # a stream needs its folder
    schema = events.schema
    asked = city_requests(spark.readStream.schema(schema).parquet(source))
    query = start_lookups(
        asked.select("request_id", "city"), out, new_folder(spark, "checkpoint"),
        trigger={"processingTime": "0 seconds"}, **dimension,
    )
    try:
        for number, rows in enumerate(dimension_updates(spark, folder)):
            update(rows)
            add(number)
            query.processAllAvailable()
    finally:
        query.stop()
    answers = spark.read.option("recursiveFileLookup", True).parquet(out)
    return answers.select("request_id", "city", "country_code", "found")


LIVE_SQL = LIVE + """
SELECT request_id, city, country_code, country_code IS NOT NULL AS found FROM answers"""


@checked_by(LIVE_SQL)
def stream_lookup_live(spark, folder):
    """Updates are compacted at once and old versions removed, while the stream goes on."""
    path = new_folder(spark, "stored")

    def update(rows: DataFrame) -> None:
        write_changes(rows, path, "name", compact_every=1, keep=1, min_age=0)

    return live_answers(spark, folder, update, dimension_path=path)


@checked_by(LIVE_SQL)
def stream_lookup_live_in_buckets(spark, folder):
    path = new_folder(spark, "stored")

    def update(rows: DataFrame) -> None:
        merge_buckets(rows, path, "name", ["name"], ["country_code"], 8, keep=1, min_age=0)

    return live_answers(spark, folder, update, dimension_path=path)


@checked_by(LIVE_SQL)
def stream_lookup_live_in_a_catalog_table(spark, folder):
    name = f"dimension_{uuid4().hex}"
    empty = empty_dimension(spark)
    empty.write.option("path", new_folder(spark, "table")).format("parquet").saveAsTable(name)

    def update(rows: DataFrame) -> None:
        put_rows(spark, rows, "name", ["name"], ["country_code"], table=name)

    return live_answers(spark, folder, update, table=name)


@checked_by(SQL["answered_requests"])
def stream_answered_requests(spark, folder):
    """Requests arrive in three files; what is known of earlier ones lies in a state in buckets."""
    source, out, stored = (new_folder(spark, name) for name in ("requests", "answers", "cities"))
    write_version(cities(spark, folder), stored)
    events = table(spark, folder, "events")
    for third in THIRDS:
        events.filter(third).coalesce(1).write.mode("append").parquet(source)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    asked = city_requests(reader.parquet(source)).select("request_id", "ts", "city", "response_time")
    start_answers(
        asked, out, new_folder(spark, "checkpoint"), dimension_path=stored, buckets=8, trigger=AT_ONCE
    ).awaitTermination()
    answers = spark.read.option("recursiveFileLookup", True).parquet(out)
    return plain_times(answers, "ts")


@checked_by(SQL["response_times_of_a_roll_up"])
def stream_response_times(spark, folder):
    """The roll-up as a stream of changes, read as it is at the end."""
    path = new_folder(spark, "rolled")
    log = city_requests(table_stream(spark, folder, "events")).withWatermark("ts", "1 day")
    checkpoint, keys = new_folder(spark, "checkpoint"), ["cache_status", "interval_start"]
    stream_updates(
        requests.response_roll_up(log), path, checkpoint, trigger=AT_ONCE
    ).awaitTermination()
    return checked_response_times(request_table(spark, folder), read_updates(spark, path, keys))
