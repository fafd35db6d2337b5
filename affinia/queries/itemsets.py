from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators import itemsets, vertical
from affinia.plans import views

SUPPORT = 5
CHUNKS = 2
PAIR_SUPPORT = 25
MIN_ROWS = 4
# Suppliers as baskets: hundreds of orders each, few baskets an order.
ITEM_SUPPORT = 3


def _named(df: DataFrame) -> DataFrame:
    """Items as names, in their order: on the way numbers are narrower."""
    return df.withColumn("items", F.array_sort(F.col("items").cast("array<string>")))


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("items", F.concat_ws(",", "items")).withColumnRenamed("items", "itemset")


def _by_order(spark: SparkSession, sf: str, min_rows: int | None = None) -> DataFrame:
    return itemsets.baskets(views.order_suppliers(spark, sf), min_rows=min_rows)


def _chunk():
    return F.pmod(F.col("basket"), F.lit(CHUNKS))


def _mined(rows: DataFrame) -> DataFrame:
    """Two-phase itemset mining."""
    mined = itemsets.son_frequent(rows, SUPPORT, CHUNKS, _chunk())
    return _joined(_named(mined).orderBy("size", "items"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Two-phase itemset mining."""
    return _mined(_by_order(spark, sf))


def _apriori(spark: SparkSession, sf: str) -> DataFrame:
    frequent = itemsets.frequent_itemsets(_by_order(spark, sf), PAIR_SUPPORT, max_size=2)
    pairs = frequent.where("size = 2")
    return _joined(_named(itemsets.apriori_candidates(pairs, 3).select("items")))


def _by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    rows = itemsets.baskets(views.basket_pairs(spark, sf), by="item", item="basket")
    return _joined(vertical.vertical_itemsets(rows, ITEM_SUPPORT))


QUERIES = {
    "baskets_by_user": lambda spark, sf: itemsets.baskets(
        views.basket_pairs(spark, sf), by="basket", item="item"
    ),
    "baskets_by_item": lambda spark, sf: itemsets.baskets(
        views.basket_pairs(spark, sf), by="item", item="basket"
    ),
    "baskets_min_rows": lambda spark, sf: itemsets.baskets(
        views.basket_pairs(spark, sf), min_rows=MIN_ROWS
    ),
    "apriori_candidates": _apriori,
    "son_candidates": lambda spark, sf: _joined(_named(
        itemsets.son_candidates(_by_order(spark, sf), SUPPORT, CHUNKS, _chunk())
    )),
    "son_frequent": lambda spark, sf: _mined(_by_order(spark, sf)),
    "son_frequent_active": lambda spark, sf: _mined(_by_order(spark, sf, MIN_ROWS)),
    "frequent_itemsets_by_item": _by_supplier,
    "frequent_itemsets": lambda spark, sf: _joined(_named(
        itemsets.frequent_itemsets(_by_order(spark, sf), SUPPORT)
    )),
}

_BASKETS = """
b AS MATERIALIZED (SELECT DISTINCT l_orderkey::VARCHAR AS basket, l_suppkey::VARCHAR AS item
                   FROM lineitem)
"""

_LEVELS = """
f1 AS MATERIALIZED (SELECT item AS a, count(*) AS freq FROM b GROUP BY 1 HAVING count(*) >= {s}),
f2 AS MATERIALIZED (
  SELECT x.item AS a, y.item AS b, count(*) AS freq
  FROM b x JOIN b y ON x.basket = y.basket AND x.item < y.item
  GROUP BY 1, 2 HAVING count(*) >= {s}),
f3 AS MATERIALIZED (
  SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq
  FROM b x JOIN b y ON x.basket = y.basket AND x.item < y.item
           JOIN b z ON x.basket = z.basket AND y.item < z.item
  GROUP BY 1, 2, 3 HAVING count(*) >= {s}),
f4 AS MATERIALIZED (
  SELECT x.item AS a, y.item AS b, z.item AS c, w.item AS d, count(*) AS freq
  FROM b x JOIN b y ON x.basket = y.basket AND x.item < y.item
           JOIN b z ON x.basket = z.basket AND y.item < z.item
           JOIN b w ON x.basket = w.basket AND z.item < w.item
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= {s})
"""

_FREQUENT = f"WITH {_BASKETS}, {_LEVELS}"

_UNION = """
SELECT 1 AS size, a AS itemset, freq FROM f1
UNION ALL SELECT 2, a || ',' || b, freq FROM f2
UNION ALL SELECT 3, a || ',' || b || ',' || c, freq FROM f3
UNION ALL SELECT 4, a || ',' || b || ',' || c || ',' || d, freq FROM f4
"""

_ALL_FREQUENT = _FREQUENT.format(s=SUPPORT) + _UNION

_ACTIVE = f"""
b AS MATERIALIZED (
  SELECT DISTINCT l_orderkey::VARCHAR AS basket, l_suppkey::VARCHAR AS item FROM lineitem
  WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > {MIN_ROWS}))
"""


def _chunk_level(size: int) -> str:
    """Itemsets of one size that reach the chunk's share of the support in some chunk."""
    names = "xyzw"[:size]
    joins = "".join(
        f" JOIN b {n} ON x.basket = {n}.basket AND {p}.item < {n}.item"
        for p, n in zip(names, names[1:])
    )
    itemset = " || ',' || ".join(f"{n}.item" for n in names)
    return (
        f"SELECT DISTINCT {size} AS size, itemset FROM (SELECT chunk, {itemset} AS itemset, "
        f"count(*) AS freq FROM b x{joins} JOIN c ON c.chunk = x.basket::BIGINT % {CHUNKS} "
        f"GROUP BY 1, 2 HAVING count(*) * any_value(total) >= {SUPPORT} * any_value(n))"
    )


ORACLES = {
    "baskets_by_user": """
SELECT DISTINCT l_orderkey::VARCHAR AS basket, l_suppkey::VARCHAR AS item FROM lineitem""",
    "baskets_by_item": """
SELECT DISTINCT l_suppkey::VARCHAR AS basket, l_orderkey::VARCHAR AS item FROM lineitem""",
    "baskets_min_rows": """
SELECT DISTINCT l_orderkey::VARCHAR AS basket, l_suppkey::VARCHAR AS item FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 4)""",
    "apriori_candidates": _FREQUENT.format(s=PAIR_SUPPORT) + """
SELECT p.a || ',' || p.b || ',' || q.b AS itemset
FROM f2 p JOIN f2 q ON p.a = q.a AND p.b < q.b JOIN f2 r ON r.a = p.b AND r.b = q.b""",
    "son_candidates": f"""
WITH {_BASKETS},
c AS MATERIALIZED (
  SELECT chunk, n, sum(n) OVER () AS total
  FROM (SELECT basket::BIGINT % {CHUNKS} AS chunk, count(DISTINCT basket) AS n FROM b GROUP BY 1))
""" + " UNION ALL ".join(_chunk_level(size) for size in (1, 2, 3, 4)),
    "son_frequent": _ALL_FREQUENT,
    "son_frequent_active": f"WITH {_ACTIVE}, {_LEVELS.format(s=SUPPORT)} {_UNION}",
    "frequent_itemsets": _ALL_FREQUENT,
    "frequent_itemsets_by_item": f"""
WITH RECURSIVE b AS MATERIALIZED (
  SELECT DISTINCT l_suppkey AS basket, l_orderkey::VARCHAR AS item FROM lineitem
  WHERE l_orderkey IN (
    SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= {ITEM_SUPPORT})),
pairs AS MATERIALIZED (
  SELECT x.item AS one, y.item AS two FROM b x JOIN b y ON x.basket = y.basket AND x.item < y.item
  GROUP BY 1, 2 HAVING count(*) >= {ITEM_SUPPORT}),
found AS (
  SELECT 2 AS size, one || ',' || two AS itemset, one AS prefix, two AS last, x.basket
  FROM pairs JOIN b x ON x.item = one JOIN b y ON y.item = two AND x.basket = y.basket
  UNION ALL
  SELECT size, itemset, prefix, last, basket FROM (
    SELECT x.size + 1 AS size, x.itemset || ',' || y.last AS itemset, x.itemset AS prefix,
           y.last AS last, x.basket AS basket,
           count(*) OVER (PARTITION BY x.itemset || ',' || y.last) AS n
    FROM found x JOIN found y ON x.prefix = y.prefix AND x.basket = y.basket AND x.last < y.last)
  WHERE n >= {ITEM_SUPPORT})
SELECT 1 AS size, item AS itemset, count(*) AS freq FROM b GROUP BY 2
UNION ALL SELECT size, itemset, count(*) FROM found GROUP BY 1, 2""",
}
