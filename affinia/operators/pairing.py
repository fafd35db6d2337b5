"""Pairs of entities that share features, counted exactly and without hot groups.

Users sharing items, items sharing baskets and sets sharing elements are one problem: which two
entities share at least ``need`` features? A feature held by f entities contributes f² / 2 pairs,
so one feature held by a third of all entities would dominate the job.

Two exact devices keep that away:

* Of its hot features (more than ``hot`` holders) every entity withholds the ``need - 1`` hottest.
  All entities withhold from the same end of one global order, so the common features two entities
  lose are a subset of what one of them withheld: at most ``need - 1``. Every qualifying pair still
  meets on another feature; the withheld features are probed afterwards, for those pairs only.
* A group that must still be paired is cut into blocks, and the pairs of blocks become separate
  join keys, so no task ever holds more than two blocks of one group.

Where the pairs that meet are many times the rows (measured first), they are not joined and shuffled
but counted in a grid of entity blocks (``grid``), which moves a fixed number of copies of each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from affinia.operators import grid
from affinia.plans.numbering import numbered
from affinia.plans.staging import facts, stage

HOT = 2000
BLOCK = 2000
#: Pairs a row, and pairs in all, from which they are counted in a grid.
MANY = 8
FEW_PAIRS = 2_000_000
#: Whole numbers below it are their own codes in a grid; where fewer rows than this share can meet
#: others, the rest is filtered out before.
WIDE = (1 << 31) - 1
MOSTLY = 0.75


def block_pairs(
    rows: DataFrame, keys: list[str], entity: str, carry: list[str] = (), block: int = BLOCK,
    largest: int | None = None,
) -> DataFrame:
    """The (e1 < e2) pairs of entities that meet in a group given by ``keys``.

    Carried columns come out suffixed 1 and 2. Groups above ``block`` members are spread over
    (blocks² / 2) join keys. For callers that have already kept hot groups out or small;
    ``largest`` is a known bound on the size of a group.
    """
    one, two = f"{entity}1", f"{entity}2"
    if largest is not None and largest <= block:
        first = rows.select(*keys, *[F.col(c).alias(f"{c}1") for c in [entity, *carry]])
        second = rows.select(*keys, *[F.col(c).alias(f"{c}2") for c in [entity, *carry]])
        return first.join(second, keys).where(F.col(one) < F.col(two))
    large = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > block)
        .select(*keys, F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    )
    last = F.coalesce(F.col("_blocks"), F.lit(1)) - 1
    placed = rows.join(large, keys, "left").select(
        *keys, entity, *carry,
        last.alias("_last"),
        F.pmod(F.xxhash64(entity), last + 1).cast("int").alias("_block"),
    )

    def side(n: int, low: Column, high: Column) -> DataFrame:
        fields = [F.col(c).alias(f"{c}{n}") for c in [entity, *carry]]
        return placed.select(*keys, *fields, low.alias("_low"), high.alias("_high"))

    left = side(1, F.col("_block"), F.explode(F.sequence("_block", "_last")))
    right = side(2, F.explode(F.sequence(F.lit(0), F.col("_block"))), F.col("_block"))
    joined = left.join(right, [*keys, "_low", "_high"]).where(
        (F.col("_low") < F.col("_high")) | (F.col(one) < F.col(two))
    )
    ordered = F.col(one) < F.col(two)
    out = []
    for c in [entity, *carry]:
        out.append(F.when(ordered, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(f"{c}1"))
        out.append(F.when(ordered, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(f"{c}2"))
    return joined.select(*keys, *out)


def sharing_pairs(
    rows: DataFrame, entity: str, feature: str, by: list[str] = (), hot: int = HOT,
    size: dict | None = None,
) -> DataFrame:
    """Entity pairs with at least ``need`` common features.

    ``rows`` holds distinct (by…, entity, feature) and a column ``need``, constant within ``by``.
    Returns (by…, entity1, entity2, shared, need) with the exact count in ``shared``. ``size`` is
    ``pairs_of`` the holders of every feature, where the caller knows.
    """
    by = list(by)
    one, two = f"{entity}1", f"{entity}2"
    holders = rows.groupBy(*by, feature).agg(F.count("*").alias("_holders"))
    if size is None:
        holders = stage(holders, "holders")
        size = pairs_of(holders)
    any_hot = size["most"] > hot

    kept, meeting, lists = rows, holders, None
    if any_hot:
        hot_features = holders.where(F.col("_holders") > hot)
        withheld = stage(_withheld(rows, hot_features, by, entity, feature), "withheld")
        kept = rows.join(withheld.select(*by, entity, feature), [*by, entity, feature], "left_anti")
        lists = withheld.groupBy(*by, entity).agg(F.collect_list(feature).alias("_held"))
        meeting = stage(kept.groupBy(*by, feature).agg(F.count("*").alias("_holders")), "meeting")
        size = pairs_of(meeting)
    if crowded(size):
        met = _met_in_grid(kept, meeting, lists, by, entity, feature, size["rows"])
    else:
        met = (
            block_pairs(
                kept, [*by, feature, "need"], entity, largest=None if any_hot else hot
            )
            .groupBy(*by, one, two, "need")
            .agg(F.count("*").alias("shared"))
        )
    if not any_hot:
        return met.where("shared >= need")

    possible = (
        met.join(lists.withColumnsRenamed({entity: one, "_held": "_held1"}), [*by, one], "left")
        .join(lists.withColumnsRenamed({entity: two, "_held": "_held2"}), [*by, two], "left")
        .withColumns({c: F.coalesce(c, F.expr("array()")) for c in ("_held1", "_held2")})
        .where(F.col("shared") >= F.col("need") - F.greatest(F.size("_held1"), F.size("_held2")))
    )
    pair = [*by, one, two]
    possible = stage(possible, "possible")
    probes = possible.select(
        *pair, F.col(two).alias("_other"), F.explode(F.array_except("_held1", "_held2")).alias("_x")
    ).union(
        possible.select(
            *pair, F.col(one).alias("_other"),
            F.explode(F.array_except("_held2", "_held1")).alias("_x"),
        )
    )
    holds = kept.select(*by, F.col(entity).alias("_other"), F.col(feature).alias("_x"))
    probed = (
        probes.join(holds, [*by, "_other", "_x"], "left_semi")
        .groupBy(*pair)
        .agg(F.count("*").alias("_probed"))
    )
    both = F.size(F.array_intersect("_held1", "_held2"))
    return (
        possible.join(probed, pair, "left")
        .withColumn("shared", F.col("shared") + both + F.coalesce("_probed", F.lit(0)))
        .where("shared >= need")
        .select(*by, one, two, "need", "shared")
    )


def pairs_of(meeting: DataFrame) -> dict:
    """The ``rows`` and ``pairs`` that meet and the ``most`` at a feature, from the ``_holders`` of each."""
    n = F.col("_holders").cast("double")
    return facts(meeting.agg(
        F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).alias("pairs"),
        F.coalesce(F.sum("_holders"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("_holders"), F.lit(0)).alias("most"),
    ))


def crowded(size: dict) -> bool:
    """Whether pairs are better counted in a grid than joined."""
    return size["pairs"] > max(FEW_PAIRS, MANY * size["rows"])


def _met_in_grid(
    kept: DataFrame, meeting: DataFrame, lists: DataFrame | None, by: list[str], entity: str,
    feature: str, rows: int,
) -> DataFrame:
    """(by…, entity1, entity2, need, shared) of the pairs that can still reach their ``need``.

    Entities with fewer than ``need`` features, and features of one entity, take no part. Numbers
    follow the order of the entities, so that they tell the first of a pair; whole numbers that are
    small enough are their own.
    """
    kinds = {c: kept.schema[c].dataType for c in (entity, feature, "need")}
    if not by and lists is None and all(isinstance(k, IntegralType) for k in kinds.values()):
        coded, need = _coded_by_value(kept, meeting, entity, feature)
        if coded is not None:
            found = stage(grid.shared_counts(coded, rows), "met")
            ends = [F.col(f"e{i}").cast(kinds[entity]).alias(f"{entity}{i}") for i in (1, 2)]
            return found.select(*ends, F.lit(need).cast(kinds["need"]).alias("need"), "shared")
    own, least = [*by, entity], F.col("need")
    sizes = kept.groupBy(*own, "need").agg(F.count("*").alias("_size"))
    if lists is not None:
        held = lists.select(*own, F.size("_held").alias("_held"))
        sizes = sizes.join(held, own, "left").withColumn("_held", F.coalesce("_held", F.lit(0)))
        least = F.col("need") - F.col("_held")
    able = sizes.where(F.col("_size") >= least).select(*own, "need", least.alias("_least"))
    numbers = stage(numbered(able, own, "_e"), "entities")
    features = stage(
        numbered(meeting.where("_holders > 1").select(*by, feature), [*by, feature], "_f"), "features"
    )
    coded = (
        kept.select(*own, feature).join(features, [*by, feature])
        .join(numbers.select(*own, "_e", "_least"), own)
        .select(F.col("_e").alias("e"), F.col("_f").alias("f"), F.col("_least").alias("x"))
    )
    found = stage(grid.shared_counts(coded, rows), "met")
    found = found.withColumnsRenamed({"e1": "_e1", "e2": "_e2"})
    first = numbers.select(F.col("_e").alias("_e1"), *by, F.col(entity).alias(f"{entity}1"), "need")
    second = numbers.select(F.col("_e").alias("_e2"), F.col(entity).alias(f"{entity}2"))
    return found.join(first, "_e1").join(second, "_e2").select(
        *by, f"{entity}1", f"{entity}2", "need", "shared"
    )


def _coded_by_value(
    kept: DataFrame, meeting: DataFrame, entity: str, feature: str
) -> tuple[DataFrame | None, int]:
    """The rows (e, f, x) for the grid, none where values need more than four bytes, and ``need``.

    Rows that can meet nobody only cost their copies; they go where they are many, as it takes a
    shuffle of all rows to find them.
    """
    kept = kept.where(F.col(entity).isNotNull() & F.col(feature).isNotNull())
    sizes = stage(kept.groupBy(entity, "need").agg(F.count("*").alias("_n")), "sizes")
    sides = [
        (entity, sizes.withColumn("_able", F.col("_n") >= F.col("need"))),
        (feature, meeting.withColumn("_n", F.col("_holders")).withColumn("_able", F.col("_n") > 1)),
    ]
    coded, need = kept, facts(sizes.agg(F.max("need").alias("need")))["need"]
    for key, counted in sides:
        known = facts(counted.agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.sum("_n").alias("rows"),
            F.sum(F.when(F.col("_able"), F.col("_n"))).alias("able"),
        ))
        if known["rows"] is None or known["low"] <= -WIDE or known["high"] >= WIDE:
            return None, need
        if (known["able"] or 0) < MOSTLY * known["rows"]:
            coded = coded.join(counted.where("_able").select(key), key, "left_semi")
    return coded.select(F.col(entity).alias("e"), F.col(feature).alias("f"), F.col("need").alias("x")), need


def _withheld(
    rows: DataFrame, hot_features: DataFrame, by: list[str], entity: str, feature: str
) -> DataFrame:
    """The up to ``need - 1`` hottest hot features of every entity."""
    most = rows.agg(F.max("need")).first()[0]
    hottest_first = Window.partitionBy(*by, entity).orderBy(F.desc("_holders"), F.desc(feature))
    return (
        rows.join(hot_features, [*by, feature])
        .withColumn("_rank", F.row_number().over(hottest_first))
        .where(F.col("_rank") < most)
        .where(F.col("_rank") < F.col("need"))
        .select(*by, entity, feature)
    )
