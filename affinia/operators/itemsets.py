"""Frequent itemsets: basket models, level-wise candidates, and two-phase (SON) mining.

Baskets stay in long form, one row per (basket, item), and so do the occurrences of frequent
itemsets, one row per (itemset, basket). The next level joins two occurrences in one basket, which
lists only itemsets that really occur. Baskets with very many items are not expanded that way: they
are asked for the Apriori candidates instead, by joining the occurrences of a candidate's parents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.pairing import HOT, block_pairs, pairs_of, sharing_pairs
from affinia.plans.staging import facts, has_rows, stage


def baskets(
    pairs: DataFrame, by: str = "basket", item: str = "item", min_rows: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Distinct (basket, item) rows, grouped by either column of ``pairs``.

    ``min_rows`` keeps baskets with strictly more raw rows, repeated rows included; their rows are
    shuffled once, to ``tasks`` tasks where the caller knows how many.
    """
    pairs = pairs.where(F.col(by).isNotNull() & F.col(item).isNotNull())
    pairs = pairs.select(F.col(by).alias("basket"), F.col(item).alias("item"))
    if min_rows is None:
        return pairs.groupBy("basket", "item").agg(F.count("*").alias("_rows")).drop("_rows")
    # Both sides read one shuffle by basket, where rows are made distinct and counted; items are
    # counted as they are not null, so that the side of the counts shuffles no other columns.
    pairs = pairs.repartition(*[tasks] if tasks else [], "basket")
    rows = pairs.groupBy("basket", "item").agg(F.count("*").alias("_rows")).drop("_rows")
    active = pairs.groupBy("basket").agg(F.count("item").alias("_rows")).where(
        F.col("_rows") > min_rows
    )
    return rows.join(active.select("basket"), "basket", "left_semi")


def frequent_itemsets(
    rows: DataFrame, support: int, max_size: int | None = None, hot: int = HOT
) -> DataFrame:
    """All itemsets in at least ``support`` baskets, level by level: (size, items, freq)."""
    keyed = _staged(rows).withColumn("need", F.lit(support).cast("long"))
    return _levels(keyed, [], max_size, hot).select("size", "items", "freq")


def _staged(rows: DataFrame) -> DataFrame:
    """The (basket, item) rows as a table, as every level reads them; a caller may have staged them."""
    if getattr(rows, "staged_at", None):
        return rows
    return stage(rows.select("basket", "item"), "baskets")


def son_candidates(
    rows: DataFrame,
    support: int,
    chunks: int,
    chunk: Column | None = None,
    max_size: int | None = None,
    hot: int = HOT,
) -> DataFrame:
    """Phase one: itemsets frequent in some chunk of baskets at its share of the support.

    ``chunk`` maps a basket to 0..chunks-1; by default a hash of the basket. The local limit is
    the smallest whole number not below ``support * chunk baskets / all baskets``. Chunks too small
    for a limit of at least two baskets are joined with the next smallest, as nearly every set of
    items would be frequent there; the itemsets of phase two are the same for any chunks.
    """
    if chunk is None:
        chunk = F.pmod(F.xxhash64("basket"), F.lit(chunks))
    rows = _staged(rows)
    chunked = rows.withColumn("chunk", chunk.cast("int"))
    sizes = chunked.groupBy("chunk").agg(F.count_distinct("basket").alias("n"))
    sizes = sizes.groupBy().agg(
        F.sum("n").alias("all"),
        F.map_from_entries(F.collect_list(F.struct("chunk", "n"))).alias("n"),
    )
    known = facts(sizes)
    if not known["n"]:
        return _no_itemsets(rows).select("size", "items")
    joined = _large_chunks(known["n"], support)
    sizes = {}
    for own, n in known["n"].items():
        sizes[joined[own]] = sizes.get(joined[own], 0) + n
    chunk_of = F.create_map(*[F.lit(v) for entry in joined.items() for v in entry])
    need = F.create_map(
        *[F.lit(v) for c, n in sizes.items() for v in (c, -(-support * n // known["all"]))]
    )
    keyed = chunked.withColumn("chunk", chunk_of[F.col("chunk")]).withColumn(
        "need", need[F.col("chunk")].cast("long")
    )
    return _levels(keyed, ["chunk"], max_size, hot).select("size", "items").distinct()


def _large_chunks(sizes: dict[int, int], support: int) -> dict[int, int]:
    """The chunk that each chunk is joined into, so that every limit is two baskets or more."""
    total = sum(sizes.values())
    left = sorted((n, [c]) for c, n in sizes.items())
    while len(left) > 1 and support * left[0][0] < 2 * total:
        (n, own), (more, others) = left[:2]
        left = sorted([(n + more, others + own), *left[2:]])
    return {c: members[0] for _, members in left for c in members}


def son_frequent(
    rows: DataFrame,
    support: int,
    chunks: int,
    chunk: Column | None = None,
    max_size: int | None = None,
    hot: int = HOT,
) -> DataFrame:
    """Phase two: the candidates of phase one that reach the support over all baskets."""
    rows = _staged(rows)
    candidates = stage(son_candidates(rows, support, chunks, chunk, max_size, hot), "candidates")
    return count_candidates(rows, candidates, support, hot)


def count_candidates(
    rows: DataFrame, candidates: DataFrame, support: int, hot: int = HOT
) -> DataFrame:
    """(size, items, freq) of the candidates found in at least ``support`` baskets.

    ``candidates`` (size, items) must contain the subsets of its members, as phase one's do.
    """
    keyed = _staged(rows).withColumn("need", F.lit(support).cast("long"))
    return _levels(keyed, [], None, hot, candidates).orderBy("size", "items")


def apriori_candidates(frequent: DataFrame, size: int, by: list[str] = ()) -> DataFrame:
    """Itemsets of ``size`` all of whose (size - 1)-subsets are in ``frequent`` (by…, items, freq).

    Members are ranked by how many frequent sets contain them, rarest first, and two sets join on
    all but the last of that order. A member found in a third of all sets therefore ends up last
    nearly everywhere, and a group of sets with one prefix stays near the square root of all sets.
    Returns (by…, items, probe, other): the candidate and the two sets it was joined from, the
    rarer one as ``probe``.
    """
    by = list(by)
    frequent = frequent.select(*by, "items", "freq")
    members = frequent.withColumn("item", F.explode("items"))
    degree = members.groupBy(*by, "item").agg(F.count("*").alias("degree"))
    ranked = (
        members.join(degree, [*by, "item"])
        .groupBy(*by, "items", "freq")
        .agg(F.sort_array(F.collect_list(F.struct("degree", "item"))).alias("_ranked"))
        .select(
            *by, "items", "freq",
            F.slice("_ranked", 1, size - 2).alias("_prefix"),
            F.element_at("_ranked", -1).alias("_tail"),
        )
    )
    joined = block_pairs(ranked, [*by, "_prefix"], "_tail", ["items", "freq"])
    rarer_first = F.col("freq1") <= F.col("freq2")
    candidates = joined.select(
        *by,
        F.array_sort(F.array_union("items1", "items2")).alias("items"),
        F.when(rarer_first, F.col("items1")).otherwise(F.col("items2")).alias("probe"),
        F.when(rarer_first, F.col("items2")).otherwise(F.col("items1")).alias("other"),
    )
    subsets = F.array_except(
        F.transform("items", lambda x: F.array_remove("items", x)), F.array("probe", "other")
    )
    kept = (
        candidates.withColumn("_subset", F.explode(subsets))
        .join(
            frequent.select(*by, F.col("items").alias("_subset")), [*by, "_subset"], "left_semi"
        )
        .groupBy(*by, "items", "probe", "other")
        .agg(F.count("*").alias("_found"))
        .where(F.col("_found") == size - 2)
    )
    return kept.drop("_found")


def _levels(
    rows: DataFrame, by: list[str], max_size: int | None, hot: int,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """Level-wise search over (by…, basket, item, need) rows, among ``candidates`` if given.

    Candidates also end the search at their largest size, and leave out what is in none of them:
    items before pairs are listed, and occurrences before they are extended.
    """
    itemset, basket = [*by, "items"], [*by, "basket"]

    def of_size(size: int) -> DataFrame:
        return candidates.where(F.col("size") == size).select("items")

    def allowed(df: DataFrame, size: int) -> DataFrame:
        return df if candidates is None else df.join(of_size(size), "items", "left_semi")

    def wanted(df: DataFrame, size: int) -> DataFrame:
        if candidates is None:
            return df
        subsets = F.transform("items", lambda x: F.array_remove("items", x))
        used = of_size(size).select(F.explode(subsets).alias("items")).distinct()
        return df.join(used, "items", "left_semi")

    found = [stage(allowed(_singletons(rows, by), 1), "level")]
    single = wanted(found[0], 2).select(*by, F.col("items")[0].alias("item"))
    rows = rows.join(single, [*by, "item"], "left_semi")
    sizes = rows.groupBy(*basket).agg(F.count("*").alias("_holders"))
    known = pairs_of(sizes)
    any_large, large = known["most"] > hot, None
    if any_large:
        large = stage(sizes.where(F.col("_holders") > hot).select(*basket), "large")

    occurrences, size = None, 2
    while max_size is None or size <= max_size:
        if candidates is not None and not has_rows(of_size(size)):
            break
        if size == 2:
            pairs = sharing_pairs(rows, "item", "basket", by, hot, known).select(
                *by, F.array("item1", "item2").alias("items"), F.col("shared").alias("freq"), "need"
            )
            level = stage(allowed(pairs, 2), "level")
        else:
            if size == 3:
                pairs = wanted(found[-1], 3)
                occurrences = stage(_pair_occurrences(rows, pairs, by, large), "occurrences")
            else:
                occurrences = wanted(occurrences, size)
            ordinary = occurrences
            if any_large:
                ordinary = occurrences.join(large, basket, "left_anti")
            joint = allowed(_extended(ordinary, by, size), size)
            if any_large:
                asked = allowed(stage(apriori_candidates(found[-1], size, by), "candidates"), size)
                in_large = occurrences.join(large, basket, "left_semi")
                joint = joint.union(_joint_occurrences(in_large, asked, by))
            joint = stage(joint, "occurrences")
            level = stage(_frequent(joint.groupBy(*itemset, "need")), "level")
            occurrences = joint.join(level.select(*itemset), itemset, "left_semi")
        if not has_rows(level):
            break
        found.append(level)
        size += 1
    levels = [f.select(*by, F.size("items").alias("size"), "items", "freq") for f in found]
    return reduce(DataFrame.union, levels)


def _frequent(groups) -> DataFrame:
    return groups.agg(F.count("*").alias("freq")).where("freq >= need")


def _singletons(rows: DataFrame, by: list[str]) -> DataFrame:
    counted = _frequent(rows.groupBy(*by, "item", "need"))
    return counted.select(*by, F.array("item").alias("items"), "freq", "need")


def _pair_occurrences(
    rows: DataFrame, pairs: DataFrame, by: list[str], large: DataFrame | None
) -> DataFrame:
    """(by…, items, need, basket): the baskets that hold both members of each pair.

    Ordinary baskets list their own pairs; large baskets are asked for the given pairs instead.
    """
    basket = [*by, "basket"]
    out = [*by, "items", "need", "basket"]
    pairs = pairs.select(
        *by, "items", F.col("items")[0].alias("item1"), F.col("items")[1].alias("item2")
    )
    ordinary = rows if large is None else rows.join(large, basket, "left_anti")
    # Both sides with the same columns, shuffled once.
    first = ordinary.select(*basket, "need", F.col("item").alias("item1"))
    listed = (
        first.join(first.withColumnRenamed("item1", "item2"), [*basket, "need"])
        .where("item1 < item2")
        .join(pairs, [*by, "item1", "item2"])
        .select(*out)
    )
    if large is None:
        return listed
    big = rows.join(large, basket, "left_semi")
    asked = pairs.join(big.withColumnRenamed("item", "item1"), [*by, "item1"]).join(
        big.select(*basket, F.col("item").alias("item2")), [*basket, "item2"], "left_semi"
    )
    return listed.union(asked.select(*out))


def _extended(occurrences: DataFrame, by: list[str], size: int) -> DataFrame:
    """Itemsets of ``size`` that occur in a basket together with two of their frequent subsets.

    Both sides of the join have the same columns, so that Spark shuffles them once.
    """
    key = [*by, "need", "basket", "_prefix"]
    sets = occurrences.withColumn("_prefix", F.slice("items", 1, size - 2)).select(
        *key, F.element_at("items", -1).alias("_last")
    )
    longer = sets.withColumnRenamed("_last", "_next")
    return (
        sets.join(longer, key)
        .where("_last < _next")
        .select(*by, F.concat("_prefix", F.array("_last", "_next")).alias("items"), "need", "basket")
    )


def _joint_occurrences(occurrences: DataFrame, candidates: DataFrame, by: list[str]) -> DataFrame:
    """(by…, items, need, basket): the baskets shared by both parents of each candidate."""
    probe = occurrences.withColumnRenamed("items", "probe")
    other = occurrences.select(*by, F.col("items").alias("other"), "basket")
    return (
        candidates.join(probe, [*by, "probe"])
        .join(other, [*by, "other", "basket"], "left_semi")
        .select(*by, "items", "need", "basket")
    )


def _no_itemsets(rows: DataFrame) -> DataFrame:
    empty = rows.where("false")
    return empty.select(F.lit(0).alias("size"), F.array("item").alias("items"),
                        F.lit(0).cast("long").alias("freq"))
