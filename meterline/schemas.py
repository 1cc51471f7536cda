"""Column layouts of the inputs. Names and types are fixed by the files they describe."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 16 columns of a full call-detail record, in file order.
FULL_CDR = T.StructType(
    [
        T.StructField("ROAMSTATE_519", T.IntegerType()),
        T.StructField("CUST_LOCAL_START_DATE_15", T.LongType()),
        T.StructField("CDR_ID_1", T.StringType()),
        T.StructField("CDR_SUB_ID_2", T.IntegerType()),
        T.StructField("CDR_TYPE_3", T.StringType()),
        T.StructField("SPLIT_CDR_REASON_4", T.StringType()),
        T.StructField("RECORD_DATE", T.StringType()),
        T.StructField("PAYTYPE_515", T.IntegerType()),
        T.StructField("DEBIT_AMOUNT_42", T.DecimalType(10, 3)),
        T.StructField("SERVICEFLOW_498", T.IntegerType()),
        T.StructField("EVENTSOURCE_CATE_17", T.StringType()),
        T.StructField("USAGE_SERVICE_TYPE_19", T.IntegerType()),
        T.StructField("SPECIALNUMBERINDICATOR_534", T.DoubleType()),
        T.StructField("BE_ID_30", T.DoubleType()),
        T.StructField("CALLEDPARTYIMSI_495", T.StringType()),
        T.StructField("CALLINGPARTYIMSI_494", T.StringType()),
    ]
)

# The brief three-column record.
BRIEF_CDR = T.StructType(
    [
        T.StructField("RECORD_DATE", T.StringType()),
        T.StructField("PayType", T.IntegerType()),
        T.StructField("Debit_amount_42", T.LongType()),
    ]
)

# Payment types by code, and the two codes used when no table is given.
MAPPING = T.StructType(
    [T.StructField("PayType", T.IntegerType()), T.StructField("value", T.StringType())]
)
FALLBACK_MAPPING = [(0, "Prepaid"), (1, "Postpaid")]

DIMENSION = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("country_code", T.StringType())]
)

# Header spellings of the dimension files, first non-empty one wins.
DIMENSION_ALIASES = {
    "name": ("city", "City", "name", "Name"),
    "country_code": ("countyCode", "country_code", "CountryCode"),
}

# The log's fields and topic. The id and the time are ours, so that the
# order of requests is known.
REQUEST_LOG = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("city", T.StringType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("cache_status", T.StringType()),
        T.StructField("cache_hit_percentage", T.DoubleType()),
    ]
)
REQUEST_TOPIC = "city_requests"

# Fixed value: seconds after a request during which a repeat of it can be served.
SECONDS_TO_LIVE = 600


@dataclass(frozen=True)
class Layout:
    """How one kind of record file is read and turned into time and money."""

    schema: T.StructType
    time_column: str
    time_format: str
    key_column: str
    amount_column: str
    divisor: int
    revenue_type: str
    trim: bool


# Time formats, divisors and revenue types of the two layouts.
FULL = Layout(
    schema=FULL_CDR,
    time_column="RECORD_DATE",
    time_format="yyyy/MM/dd HH:mm:ss",
    key_column="PAYTYPE_515",
    amount_column="DEBIT_AMOUNT_42",
    divisor=10000,
    revenue_type="decimal(6,3)",
    trim=True,
)

BRIEF = Layout(
    schema=BRIEF_CDR,
    time_column="RECORD_DATE",
    time_format="HH:mm:ss yyyy/MM/dd",
    key_column="PayType",
    amount_column="Debit_amount_42",
    divisor=1000,
    revenue_type="double",
    trim=False,
)
