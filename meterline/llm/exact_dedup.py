"""Exact duplicates by sorting content.

Rows are range-partitioned by the first characters and a hash of their normalised text, at
splitters that Spark samples; each range is sorted by the whole text, so equal texts lie
next to each other and are told apart by comparing whole neighbours. A text held by very
many rows is cut into several ranges by a salt, and the heads of its runs are merged in a
second, small step. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.columns import ascii_lower, hidden, shown, shuffle_partitions
from meterline.session import cut_lineage

# A text needs more than this many rows, and more than a twentieth of a partition, to be cut.
LEAST_HOT_ROWS = 1000
PARTS_OF_PARTITION = 20
PREFIX_CHARS = 16

RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def hot_texts(hashes: DataFrame, rows: int, partitions: int) -> DataFrame:
    """Hashes that many rows share, with the number of salts; at most 20 for each partition."""
    limit = max(LEAST_HOT_ROWS, rows // (PARTS_OF_PARTITION * partitions))
    return (
        hashes.groupBy("_hash")
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select("_hash", F.ceil(F.col("_rows") / limit).cast("int").alias("_salts"))
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=ascii_lower,
) -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal if ``normalise`` makes them identical; a null text counts as empty. Of
    equal texts the row with the smallest (or ``keep="largest"``) id stays; a null id loses
    to any other. If rows repeat both id and text, exactly one of them stays. An empty
    table gives an empty result; columns named as a result are replaced by it.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    source, names = hidden(docs)
    given = {name: k for k, name in names.items()}
    key, text = F.col(given[id_col]), F.coalesce(F.col(given[text_col]), F.lit(""))
    plain = normalise(text)

    hashed = docs.select(F.xxhash64(normalise(F.coalesce(F.col(text_col), F.lit("")))).alias("_hash"))
    hot = cut_lineage(hot_texts(hashed, docs.count(), shuffle_partitions(docs)))
    any_hot = not hot.isEmpty()

    ranged = source.withColumns(
        {"_start": F.left(plain, F.lit(PREFIX_CHARS)), "_hash": F.xxhash64(plain)}
    )
    places = ["_start", "_hash"]
    if any_hot:
        places.append("_salt")
        salt = F.pmod(F.xxhash64(key), F.col("_salts"))
        ranged = ranged.join(F.broadcast(hot), "_hash", "left").withColumn(
            "_salt", F.coalesce(salt, F.lit(0)).cast("int")
        )
    ranged = ranged.repartitionByRange(*places)

    best = key.asc_nulls_last() if keep == "smallest" else key.desc_nulls_last()
    run = W.partitionBy(*places, "_plain").orderBy(best)
    whole = run.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    runs = (
        ranged.withColumn("_plain", plain)
        .withColumns(
            {
                "_head": F.first(key).over(whole),
                "_size": F.count("*").over(whole),
                "_place": F.row_number().over(run),
            }
        )
        .withColumn("text_sha256", F.sha2(F.col("_plain"), 256))
    )
    if not any_hot:
        done = runs.withColumns(
            {"keep_id": F.col("_head"), "group_size": F.col("_size"), "kept": F.col("_place") == 1}
        )
        return shown(done, names, *RESULTS)
    return shown(merged(runs, best_of=F.min if keep == "smallest" else F.max), names, *RESULTS)


def merged(runs: DataFrame, best_of) -> DataFrame:
    """Join the runs of a text that salts have cut; only the heads of such runs are compared."""
    is_head = F.col("_salts").isNotNull() & (F.col("_place") == 1)
    slim = cut_lineage(
        runs.withColumn("_text", F.when(is_head, F.col("_plain"))).drop("_plain", "_start")
    )
    heads = slim.filter(is_head).select("_hash", "_salt", "_head", "_size", "_text")
    groups = heads.groupBy("_text").agg(
        best_of("_head").alias("keep_id"), F.sum("_size").alias("group_size")
    )
    # One row for each run of a hot text: at most 20 and one salts for each partition and key.
    of_runs = heads.join(groups, "_text").select(
        *(F.col(c).alias(f"_of{c}") for c in ("_hash", "_salt", "_head")), "keep_id", "group_size"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in ("_hash", "_salt", "_head")]
    joined = slim.join(F.broadcast(of_runs), same, "left")
    whole: Column = F.col("_of_hash").isNull()
    return joined.withColumns(
        {
            "keep_id": F.when(whole, F.col("_head")).otherwise(F.col("keep_id")),
            "group_size": F.when(whole, F.col("_size")).otherwise(F.col("group_size")),
        }
    ).withColumn(
        "kept", (F.col("_place") == 1) & F.col("_head").eqNullSafe(F.col("keep_id"))
    )


def without_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    found = exact_duplicates(docs, **options)
    return found.filter("kept").select(*docs.columns)
