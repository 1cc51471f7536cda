from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import event_date
from meterline.sources.paths import expand_home


def land_cdr(prepared: DataFrame, path: str) -> None:
    """Keep prepared records as Parquet in one folder per day.

    Later reports then read only the days and columns they need. The rebalance hint joins
    small days into full files and splits a day that holds much of the data. Landing a day
    again replaces it; other days stay.
    """
    dated = prepared.withColumn("event_date", event_date(F.col("timestamp")))
    balanced = dated.hint("rebalance", "event_date")
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date").parquet(expand_home(path))
