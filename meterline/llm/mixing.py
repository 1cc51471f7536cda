"""Mixing sources to target weights by a low-discrepancy schedule of blocks.

The documents of a source are laid out one after the other in a shuffled order and cut into
blocks of equally many words. A slot of the mix takes one block. Which source a slot takes it
from is decided by its point of the golden-ratio sequence: the points fill the interval
evenly, so every stretch of the mix has nearly the target shares. The r-th slot of a source
takes its r-th block, beginning again after the last, until its target is reached.

Nothing but ids, sources and numbers of words leaves the scan of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.columns import shuffle_partitions
from meterline.llm.ranking import sums_before
from meterline.operators.joins import sized_join
from meterline.session import cut_lineage

# The weights of the sources in turn, and how often a source may be taken.
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
BLOCK_WORDS = 1024
SEED = 42

# The golden ratio's fraction in units of 1 / 2^38, and the most points that any interval of
# 1 / n needs of it, as a multiple of n, with some to spare.
POINT_BITS, GOLDEN, LOW_BITS = 38, 169_883_889_247, 19
POINTS_PER_SLOT = 3

WORD = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"


def word_count(text: Column) -> Column:
    """Words between blanks: each with the blanks around it becomes one letter."""
    marked = F.regexp_replace(text, WORD, "x")
    return F.when(F.startswith(marked, F.lit("x")), F.char_length(marked)).otherwise(0).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """A written table of _row, _id, _source and size. Sources sort by code point, null last."""
    source = F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1"))
    return cut_lineage(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id_col).alias("_id"),
            source.alias("_source"),
            word_count(F.col(text_col)).alias("size"),
        )
    )


def with_targets(sources: DataFrame, weights: tuple[int, ...], most_times: int) -> DataFrame:
    """``sources`` (_source, source_size) with _weight and target, a written table.

    The targets share all words by weight; no target exceeds ``most_times`` its source's
    size, and what is over goes to the others by weight. Each round finds the level at which
    the rest shares what the full sources leave, until no more become full. All of it is
    whole numbers but for the last division.
    """
    one = sources.withColumn("_all", F.lit(0))
    numbered = sums_before(cut_lineage(one), "_all", ("_source",), F.lit(1).cast("long"), "_number")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_number") % len(weights) + 1).cast("int"))
    stored = cut_lineage(numbered.drop("_all").withColumn("_weight", turn.cast("long")))

    def whole(value: Column) -> Column:
        return value.cast("decimal(19,0)")

    cap = F.col("source_size") * most_times
    total = stored.agg(F.sum("source_size")).first()[0] or 0
    left, weight = None, None
    while True:
        full = F.lit(False)
        if weight:
            full = whole(cap) * whole(F.lit(weight)) < whole(F.col("_weight")) * whole(F.lit(left))
        sums = [F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("_weight")))]
        used, rest = (value or 0 for value in stored.agg(*sums).first())
        if (total - used, rest) == (left, weight):
            break
        left, weight = total - used, rest
    share = (F.col("_weight") * F.lit(left).cast("long")).cast("double") / F.lit(float(weight or 1))
    return cut_lineage(stored.withColumn("target", F.when(full, cap.cast("double")).otherwise(share)))


def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def block_start(block: Column) -> Column:
    """The first word of a block. A source's blocks are equal to within a word, longer ones first."""
    return block * F.col("_least") + F.least(block, F.col("_longer"))


def block_of(word: Column) -> Column:
    """The block of a source that holds the word."""
    first = F.col("_longer") * (F.col("_least") + 1)
    beyond = F.col("_longer") + div(word - first, F.greatest("_least", F.lit(1)))
    return F.when(word < first, div(word, F.col("_least") + 1)).otherwise(beyond)


def with_slots(sources: DataFrame, block_words: int) -> DataFrame:
    """``sources`` with its blocks, _goal (whole words of its target) and _slots, the number of
    blocks that reach the goal; _first_slot counts the slots of the sources before."""
    size, blocks = F.col("source_size"), F.greatest("_blocks", F.lit(1))
    counted = (
        sources.withColumn("_goal", F.floor("target").cast("long"))
        .withColumn("_blocks", div(size + block_words - 1, F.lit(block_words)))
        .withColumns({"_least": div(size, blocks), "_longer": size % blocks})
        .withColumn("_rounds", div(F.col("_goal"), F.greatest(size, F.lit(1))))
    )
    rest = F.col("_goal") - F.col("_rounds") * size
    more = F.when(rest > 0, block_of(rest - 1) + 1).otherwise(0)
    slots = F.col("_rounds") * F.col("_blocks") + more
    stored = cut_lineage(counted.withColumns({"_slots": slots, "_all": F.lit(0)}).drop("_rounds"))
    return cut_lineage(sums_before(stored, "_all", ("_number",), F.col("_slots"), "_first_slot").drop("_all"))


def point(slot: Column) -> Column:
    """The slot's point of the golden-ratio sequence in units of 1 / 2^38, without overflow."""
    low = slot.bitwiseAND((1 << LOW_BITS) - 1)
    high = F.shiftright(slot, LOW_BITS).bitwiseAND((1 << POINT_BITS - LOW_BITS) - 1)
    step = (GOLDEN << LOW_BITS) % (1 << POINT_BITS)
    return (high * step + low * GOLDEN).bitwiseAND((1 << POINT_BITS) - 1)


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of the mix: slot, _number, _rank among the source's slots, and its columns.

    The points fall on as many places as there are slots, of which each source holds its
    own number in a row. Slots beyond a source's number are left out; three points per place
    are enough for every source to get its number. Places and sources meet in ranges of
    places, sorted: a place belongs to the last source that begins at or before it.
    """
    total = sources.agg(F.sum("_slots")).first()[0] or 0
    ranges = max(1, min(total, shuffle_partitions(sources)))
    width = max(1, -(-total // ranges))
    fields = ["_number", "source_size", "_blocks", "_least", "_longer", "_goal", "_slots"]
    ends = F.col("_first_slot") + F.col("_slots") - 1
    touched = F.sequence(div(F.col("_first_slot"), F.lit(width)), div(ends, F.lit(width)))
    starts = sources.filter("_slots > 0").select(
        F.explode(touched.cast("array<int>")).alias("_range"),
        F.col("_first_slot").alias("_place"),
        F.lit(-1).cast("long").alias("slot"),
        F.struct(*fields).alias("_of"),
    )
    slots = sources.sparkSession.range(POINTS_PER_SLOT * total).withColumnRenamed("id", "slot")
    place = F.floor(point(F.col("slot")) / float(1 << POINT_BITS) * total)
    slots = slots.select(
        div(place, F.lit(width)).cast("int").alias("_range"),
        place.alias("_place"),
        "slot",
        F.lit(None).cast(starts.schema["_of"].dataType).alias("_of"),
    )
    before = W.partitionBy("_range").orderBy("_place", "slot").rowsBetween(W.unboundedPreceding, 0)
    spread = starts.unionByName(slots).repartitionById(ranges, F.col("_range"))
    owned = spread.withColumn("_of", F.last("_of", ignorenulls=True).over(before)).filter("slot >= 0")
    chosen = cut_lineage(owned.select("slot", "_of.*"))
    ranked = sums_before(chosen, "_number", ("slot",), F.lit(1).cast("long"), "_rank")
    return ranked.filter(F.col("_rank") < F.col("_slots"))


def pieces_of(docs: DataFrame, seed: int) -> DataFrame:
    """Documents in blocks: _row, _number, _block, _from (in its source) and _words.

    ``docs`` has the source's columns. The order within a source is that of a hash.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    place = F.conv(F.substring(F.sha2(key, 256), 1, 15), 16, 10).cast("long")
    shuffled = cut_lineage(docs.filter("size > 0").withColumn("_shuffled", place))
    order = ("_shuffled", "_id", "_row")
    begun = sums_before(shuffled, "_number", order, F.col("size"), "_begin")
    end = F.col("_begin") + F.col("size")

    blocks = F.explode(F.sequence(block_of(F.col("_begin")), block_of(end - 1)))
    cut = begun.withColumn("_block", blocks)
    start = F.greatest(F.col("_begin"), block_start(F.col("_block")))
    stop = F.least(end, block_start(F.col("_block") + 1))
    return cut.select(
        "_row", "_id", "_number", "_block", "_begin", start.alias("_from"), (stop - start).alias("_words")
    )


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their sources' numbers, and the mix: which words each slot takes.

    The mix has slot, block, the id, _row, start (words of the document before it) and words;
    its slots in order are the mixed data. A null text has no words and is never taken; a
    null source is a source of its own, the last; a null id is shuffled like an empty one.
    Repeated rows are documents each, told apart by ``_row``. Documents of any length are
    cut at the blocks. An empty table gives two empty ones. Other columns are not read.
    """
    measured = sized(docs, id_col, text_col, source_col)
    sums = measured.groupBy("_source").agg(F.sum("size").alias("source_size"))
    sources = with_slots(with_targets(sums, weights, most_times), block_words)
    known = sized_join(measured, sources, "_source")
    pieces = pieces_of(known, seed)
    slots = schedule(sources).withColumn("_block", F.col("_rank") % F.col("_blocks"))
    # The last slot of a source takes only what is missing to its goal.
    whole_rounds = div(F.col("_rank"), F.col("_blocks")) * F.col("source_size")
    missing = F.col("_goal") - whole_rounds - block_start(F.col("_block"))
    slots = slots.select("slot", "_number", "_block", (block_start(F.col("_block")) + missing).alias("_until"))
    joined = slots.join(pieces, ["_number", "_block"])
    words = F.least(F.col("_words"), F.col("_until") - F.col("_from"))
    mix = joined.select(
        "slot", F.col("_block").alias("block"), F.col("_id").alias(id_col), "_row",
        (F.col("_from") - F.col("_begin")).alias("start"), words.alias("words"),
    ).filter("words > 0")
    return known, mix


def mix(docs: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """One row for each document: id, size, source_size, target (both of its source), taken.

    ``options`` are those of ``plan``. Each source's ``taken`` adds up to its target without
    its fraction; of a source all words are taken equally often, or some once more.
    """
    known, taken = plan(docs, id_col, **options)
    sums = taken.groupBy("_row").agg(F.sum("words").alias("taken"))
    counted = known.join(sums, "_row", "left")
    return counted.select(
        F.col("_id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
