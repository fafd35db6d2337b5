"""Frequent itemsets from the items' side: bitmaps of baskets instead of baskets of items.

For baskets with hundreds of items or more, expanding a basket into its itemsets is hopeless, while
the baskets that hold an itemset are few. Baskets are numbered, and the baskets of an itemset are
rows (itemset, chunk, word): bit i of ``word`` stands for basket 64 x chunk + i. An item in a third
of all baskets is many rows of different chunks, so no row and no group of a join is long.

Pairs are found by the baskets that items share; of baskets with more than ``hot`` items, an item
leaves out the ``support - 1`` widest (two items lose at most that many common baskets, and what
they lost is looked up for the pairs that can still be frequent). Longer itemsets join two
that differ in their last item and AND their words. Where itemsets keep most of the baskets of
their prefix, differences are shorter than the bitmaps: once a level's differences have fewer bits,
the search goes on with the words ``prefix & ~itemset``, from which the next differences follow
alone, and the support is that of the prefix less the bits that differ. Both ways are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.pairing import HOT, block_pairs, sharing_pairs
from affinia.plans.numbering import numbered
from affinia.plans.staging import facts, has_rows, spent, stage

BITS = 64


def vertical_itemsets(
    rows: DataFrame, support: int, max_size: int | None = None, hot: int = HOT
) -> DataFrame:
    """(size, items, freq) of all itemsets in at least ``support`` baskets of (basket, item) rows.

    Null baskets and items are left out, and repeated rows count once.
    """
    if support < 1:
        raise ValueError("the support must be 1 or more")
    rows = rows.where("basket IS NOT NULL AND item IS NOT NULL").select("basket", "item").distinct()
    rows = stage(rows, "rows")
    single = stage(
        rows.groupBy("item").agg(F.count("*").alias("freq")).where(F.col("freq") >= support), "level"
    )
    found = [single.select(F.lit(1).alias("size"), F.array("item").alias("items"), "freq")]
    if max_size == 1:
        return found[0]
    rows = stage(rows.join(single.select("item"), "item", "left_semi"), "frequent")

    number = numbered(rows.select("basket").distinct(), ["basket"])
    bit = F.expr(f"shiftleft(1L, cast(number % {BITS} as int))")
    words = stage(
        rows.join(number, "basket")
        .groupBy(F.array("item").alias("items"), F.expr(f"number div {BITS}").alias("chunk"))
        .agg(F.bit_or(bit).alias("word")), "words",
    )
    keyed = rows.withColumn("need", F.lit(support).cast("long"))
    pairs = sharing_pairs(keyed, "item", "basket", hot=hot)
    parents = found[0].select("items", "freq")
    level = stage(pairs.select(
        F.array("item1", "item2").alias("items"), F.col("shared").alias("freq")
    ), "level")
    differs = False
    while has_rows(level):
        size = len(found) + 1
        found.append(level.select(F.lit(size).alias("size"), "items", "freq"))
        if size == max_size:
            break
        if not differs:
            if size == 2:
                own = _own_words(level, words)
            differs = _differences_are_fewer(level, parents)
            if differs:
                own = stage(_differences(level, words, own), "words")
        parents, words = level, own
        if differs:
            level, own = _by_differences(level, own, support)
        else:
            level, own = _by_words(own, support)
    return reduce(DataFrame.union, found)


def _prefix() -> Column:
    return F.slice("items", 1, F.size("items") - 1)


def _last() -> Column:
    return F.element_at("items", -1)


def _own_words(level: DataFrame, words: DataFrame) -> DataFrame:
    """The words of pairs, from those of their items."""
    first = words.select(F.col("items").alias("_first"), "chunk", F.col("word").alias("_one"))
    second = words.select(F.col("items").alias("_second"), "chunk", F.col("word").alias("_two"))
    both = F.col("_one").bitwiseAND(F.col("_two"))
    return stage(
        level.select("items", F.slice("items", 1, 1).alias("_first"), F.slice("items", 2, 1).alias("_second"))
        .join(first, "_first").join(second, ["_second", "chunk"])
        .select("items", "chunk", both.alias("word")).where("word <> 0"), "words",
    )


def _differences_are_fewer(level: DataFrame, parents: DataFrame) -> bool:
    """Whether the sets of a level miss fewer baskets of their prefixes than they keep."""
    above = parents.select(F.col("items").alias("_prefix"), F.col("freq").alias("_above"))
    sums = level.withColumn("_prefix", _prefix()).join(above, "_prefix").agg(
        F.sum("freq").alias("kept"), F.sum(F.col("_above") - F.col("freq")).alias("missed")
    )
    known = facts(sums)
    return known["missed"] < known["kept"]


def _differences(level: DataFrame, words: DataFrame, own: DataFrame) -> DataFrame:
    """For every set of a level, the words of its prefix without its own."""
    above = words.select(F.col("items").alias("_prefix"), "chunk", F.col("word").alias("_above"))
    missed = F.col("_above").bitwiseAND(F.bitwise_not(F.coalesce("word", F.lit(0).cast("long"))))
    return (
        level.select("items", _prefix().alias("_prefix")).join(above, "_prefix")
        .join(own, ["items", "chunk"], "left")
        .select("items", "chunk", missed.alias("word")).where("word <> 0")
    )


def _by_words(own: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """The next level and its words, from sets that share a prefix and a basket."""
    sets = own.select(_prefix().alias("_prefix"), "chunk", "items", _last().alias("_last"), "word")
    longer = sets.select("_prefix", "chunk", F.col("_last").alias("_next"), F.col("word").alias("_word"))
    joint = stage(
        sets.join(longer, ["_prefix", "chunk"]).where("_last < _next")
        .select(
            F.concat("items", F.array("_next")).alias("items"), "chunk",
            F.col("word").bitwiseAND(F.col("_word")).alias("word"),
        ).where("word <> 0"), "joint",
    )
    level = stage(
        joint.groupBy("items").agg(F.sum(F.bit_count("word").cast("long")).alias("freq"))
        .where(F.col("freq") >= support), "level",
    )
    kept = stage(joint.join(level.select("items"), "items", "left_semi"), "words")
    spent(joint)
    return level, kept


def _by_differences(level: DataFrame, missed: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """The next level and its differences, from two sets with the same prefix.

    A set PXY lacks, of the baskets of PX, those that PY lacks and PX does not.
    """
    sets = level.select(_prefix().alias("_prefix"), _last().alias("tail"), "items", "freq")
    pairs = stage(block_pairs(sets, ["_prefix"], "tail", ["items", "freq"]).select(
        F.concat("items1", F.array("tail2")).alias("items"), F.col("items1").alias("_x"),
        F.col("items2").alias("_y"), "freq1",
    ), "candidates")
    of_y = missed.select(F.col("items").alias("_y"), "chunk", F.col("word").alias("_wy"))
    of_x = missed.select(F.col("items").alias("_x"), "chunk", F.col("word").alias("_wx"))
    more = F.col("_wy").bitwiseAND(F.bitwise_not(F.coalesce("_wx", F.lit(0).cast("long"))))
    lacks = stage(
        pairs.select("items", "_x", "_y").join(of_y, "_y").join(of_x, ["_x", "chunk"], "left")
        .select("items", "chunk", more.alias("word")).where("word <> 0"), "lacks",
    )
    bits = lacks.groupBy("items").agg(F.sum(F.bit_count("word").cast("long")).alias("_bits"))
    after = stage(
        pairs.join(bits, "items", "left")
        .select("items", (F.col("freq1") - F.coalesce("_bits", F.lit(0))).alias("freq"))
        .where(F.col("freq") >= support), "level",
    )
    kept = stage(lacks.join(after.select("items"), "items", "left_semi"), "words")
    spent(lacks, pairs)
    return after, kept
