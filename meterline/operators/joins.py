"""Left-hand joins that broadcast a side only after measuring it.

A right side that is too large to broadcast is joined by shuffling, with the keys that
occur often on the left spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.session import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key that fills a task has about so many sampled rows, and is a hot one from half as many.
SAMPLES_PER_TASK = 40
_SALT = "__salt"
_TASKS = "__tasks"


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a table is proven small.

    No task reads more than ``max_rows`` and one rows, and the driver receives two numbers.
    Rows that are on the driver anyway need no job.
    """
    row_size = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            row_size = row_size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif field.dataType.typeName() in ("array", "map", "struct"):
            row_size = row_size + F.octet_length(F.to_json(F.struct(field.name)))
    sizes = df.select(row_size.alias("bytes")).limit(max_rows + 1)
    if df.isLocal():
        found = [row["bytes"] for row in sizes.collect()]
        rows, size = len(found), sum(found)
    else:
        rows, size = sizes.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, key: str, partitions: int) -> DataFrame | None:
    """Keys with more rows than a partition should get, and ``__tasks`` to spread each over.

    One pass over a sample; its size follows the number of partitions. The numbers of tasks
    are powers of two. There are at most about two such keys for each partition, and their
    tasks add up to a small multiple of the partitions. Null is no key.
    """
    total = df.count()
    share = min(1.0, partitions * SAMPLES_PER_TASK / max(1, total))
    counts = df.sample(share, seed=23).groupBy(key).agg(F.count("*").alias("__rows"))
    fair = F.col("__rows") * partitions / (total * share)
    # Of a sample, half the rows of a full task are enough, so that hardly any key is missed.
    often = counts.filter(F.col(key).isNotNull() & (fair > (1.0 if share == 1 else 0.5)))
    tasks = F.pow(F.lit(2), F.floor(F.log2(fair)) + 2)
    found = cut_lineage(often.select(key, tasks.cast("int").alias(_TASKS)))
    return None if found.isEmpty() else found


def with_tasks(df: DataFrame, key: str, hot: DataFrame | None, others: int) -> DataFrame:
    if hot is None:
        return df.withColumn(_TASKS, F.lit(others))
    joined = df.join(F.broadcast(hot), key, "left")
    return joined.withColumn(_TASKS, F.coalesce(_TASKS, F.lit(others)))


def with_salt(
    left: DataFrame, key: str, hot: DataFrame | None, others: int, empty: int, unique: str | None
) -> DataFrame:
    """``left`` with ``__salt``, a number below the tasks of its key, the same in every run.

    With ``unique``, a column that tells rows apart, it is a hash of that. Otherwise it is
    drawn at random, so that equal rows are spread too, and written before it is used: a
    task that runs again gets the same rows, but perhaps in another order. A stream is not
    written; there the draw repeats because each task reads its files in order.
    """
    tasks = F.when(F.col(key).isNull(), empty).otherwise(F.col(_TASKS))
    if unique:
        salt = F.pmod(F.xxhash64(unique), tasks)
    else:
        salt = F.floor(F.rand(29) * tasks)
    salted = with_tasks(left, key, hot, others).withColumn(_SALT, salt.cast("int")).drop(_TASKS)
    return salted if unique or left.isStreaming else cut_lineage(salted)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: DataFrame | None = None,
    others: int = 1,
    empty: int = 1,
    unique: str | None = None,
) -> DataFrame:
    """Join with the rows of a key spread over several tasks.

    ``hot`` gives the number of tasks for some keys, ``others`` that for all other keys, and
    ``empty`` that for rows without a key, which match nothing. The right side's rows of a
    key are repeated once per task. ``unique`` is as in ``with_salt``.
    """
    salted_left = with_salt(left, key, hot, others, empty, unique)
    salts = F.explode(F.sequence(F.lit(0), F.col(_TASKS) - 1))
    salted_right = with_tasks(right, key, hot, others).withColumn(_SALT, salts).drop(_TASKS)
    return salted_left.join(salted_right, [key, _SALT], how).drop(_SALT)


def sized_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    stream_tasks: int = 8,
    key_rows: DataFrame | None = None,
    even: bool = False,
    unique: str | None = None,
) -> DataFrame:
    """Join a large left side, batch or stream, to a table on one equal-named key.

    ``how`` is inner, left, left_semi or left_anti. A stream cannot be searched for hot
    keys beforehand, so there every key is spread over ``stream_tasks`` tasks. ``key_rows``
    is searched in place of a left side that is dear to compute, and ``even`` says that no
    key of it can be hot. ``unique`` names a column of the left side that no two rows share;
    with it, spreading a hot key does not write the left side first.
    """
    if fits_broadcast(right, max_rows, max_bytes):
        joined = left.join(F.broadcast(right), key, how)
    elif left.isStreaming:
        joined = salted_join(left, right, key, how, None, stream_tasks, stream_tasks, unique)
    elif even:
        joined = left.join(right, key, how)
    else:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Written, so that both sides of the join see the same numbers.
        found = hot_keys((key_rows if key_rows is not None else left).select(key), key, partitions)
        if found is None and unique is None:
            joined = left.join(right, key, how)
        else:
            joined = salted_join(left, right, key, how, found, empty=partitions, unique=unique)
    added = [] if how in ("left_semi", "left_anti") else right.columns
    return joined.select(*left.columns, *[name for name in added if name != key])
