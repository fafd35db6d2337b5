"""Results that must not depend on how the work is dealt out."""

import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["son_frequent", "lsh_similar_pairs", "cf_item_predict"])
def test_same_rows_for_any_number_of_partitions(spark, name):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append(sorted(map(str, registered.queries()[name](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] and found[0] == found[1]
