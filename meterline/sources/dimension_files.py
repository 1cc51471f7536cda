"""Keyed dimension rows from CSV files that do not agree on their header.

All files are read at once by column position. What each position means is looked up per
file in a small table made from the header lines, so neither the number of files nor the
number of different headers adds a job or a plan branch.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import first_non_empty, strip_whitespace
from meterline.operators.joins import sized_join
from meterline.schemas import DIMENSION_ALIASES
from meterline.session import cut_lineage
from meterline.sources.paths import expand_home

# Every cell is parsed, because the parser can lose a quoted cell that follows a skipped one
# made of escaped quotes.
_DIALECT = {"quote": '"', "escape": '"', "columnPruning": False}


# So many files are opened for their first line alone, some at a time; beyond, and where a
# file is slow to open, a text scan on the cluster is faster.
MOST_OPENED, AT_A_TIME = 10_000, 32


def _header_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """One row per file: its first line with visible text.

    Up to ``MOST_OPENED`` files are opened and read up to the end of that line, whatever
    their size; only these lines reach the driver. More files are scanned as text.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    places = listed.select("path", F.col("_metadata.file_path").alias("file_path"))
    known = places.limit(MOST_OPENED + 1).collect()
    if len(known) > MOST_OPENED:
        return _scanned_header_lines(spark, path, pattern)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        headers = [*pool.map(lambda row: _first_line(spark, conf, row.path), known)]
    rows = [(row.file_path, h) for row, h in zip(known, headers, strict=True) if h is not None]
    columns = zip(*rows, strict=True) if rows else ((), ())
    arrays = [pa.array(column, pa.string()) for column in columns]
    # As a table of Arrow it is a local relation, which takes no job to read.
    return spark.createDataFrame(pa.table(arrays, names=["file_path", "header"]))


def _first_line(spark: SparkSession, conf, path: str) -> str | None:
    java = spark._jvm
    place = java.org.apache.hadoop.fs.Path(path)
    codec = java.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    opened = place.getFileSystem(conf).open(place)
    try:
        plain = opened if codec is None else codec.createInputStream(opened)
        lines = java.java.io.BufferedReader(java.java.io.InputStreamReader(plain, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip(" "):
                return line.removeprefix("\ufeff")
        return None
    finally:
        opened.close()


def _scanned_header_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The same by a scan. Only the first split of a file can hold its first line."""
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("value"),
            F.monotonically_increasing_id().alias("line_id"),
        )
        .filter((F.col("block_start") == 0) & (F.length(F.trim("value")) > 0))
    )
    first = lines.groupBy("file_path").agg(F.min_by("value", "line_id").alias("header"))
    return cut_lineage(first.withColumn("header", F.regexp_replace("header", r"^\uFEFF", "")))


def _positions(headers: DataFrame, width: int, names: list[str]) -> DataFrame:
    """Per file the 1-based column of each name.

    Of a repeated name the last column counts; 0 means absent.
    """
    cells = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv("header", cells, _DIALECT)
    backwards = headers.select(
        "file_path",
        F.array(*[parsed[f"c{i}"] for i in reversed(range(width))]).alias("cells"),
    )
    found = [F.coalesce(F.array_position("cells", name), F.lit(0)) for name in names]
    return backwards.select(
        "file_path",
        *[
            F.when(position > 0, width + 1 - position).otherwise(0).cast("int").alias(f"at_{i}")
            for i, position in enumerate(found)
        ],
    )


def _cell(index: int, used: list[int]) -> Column:
    """The cell under the name with this index, for whichever position the file has it at."""
    at = F.col(f"at_{index}")
    branches = [F.when(at == position, F.col(f"c{position - 1}")) for position in used]
    return F.coalesce(*branches) if branches else F.lit(None).cast("string")


def read_dimension_files(
    spark: SparkSession,
    path: str,
    aliases: dict[str, tuple[str, ...]] = DIMENSION_ALIASES,
    pattern: str = "*.csv",
    reject_blank: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Rows of all files in reading order columns, with an ``accepted`` flag.

    Per target column the first non-empty alias wins. A row is rejected if a column is
    missing or empty before white space is stripped, so a cell of blanks only is accepted
    as ``''`` unless ``reject_blank`` is set. ``(file_path, block_start, row_id)`` is unique
    and follows the files by path and the rows of each file.

    A quoted cell may hold line breaks, so a file is read by one task. Files known to have
    none can be split: pass ``multi_line=False``.
    """
    path = expand_home(path)
    headers = _header_lines(spark, path, pattern)
    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0]
    if width is None:
        raise ValueError(f"no file with a header line matches {pattern} in {path}")

    names = [name for spellings in aliases.values() for name in spellings]
    layout = cut_lineage(_positions(headers, width, names))
    used_sets = layout.agg(
        *[F.collect_set(F.nullif(f"at_{i}", F.lit(0))).alias(str(i)) for i in range(len(names))]
    ).first()
    used = [sorted(used_sets[i]) for i in range(len(names))]

    rows = (
        spark.read.schema(", ".join(f"c{i} string" for i in range(width)))
        .options(header=True, pathGlobFilter=pattern, multiLine=multi_line, **_DIALECT)
        .csv(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_id"),
            *[f"c{i - 1}" for i in sorted({i for positions in used for i in positions})],
        )
    )
    located = sized_join(rows, layout, "file_path", "left")

    cells = iter(enumerate(used))
    raw = {
        target: first_non_empty(*[_cell(*next(cells)) for _ in spellings])
        for target, spellings in aliases.items()
    }
    place = ["file_path", "block_start", "row_id"]
    picked = located.select(*place, *[cell.alias(target) for target, cell in raw.items()])
    accepted = reduce(Column.__and__, [F.col(target).isNotNull() for target in aliases])
    if reject_blank:
        blank = [strip_whitespace(F.col(target)) == "" for target in aliases]
        accepted = accepted & ~F.coalesce(reduce(Column.__or__, blank), F.lit(False))
    return picked.withColumn("accepted", accepted).withColumns(
        {target: strip_whitespace(F.col(target)) for target in aliases}
    )
