from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from eventlake import adapters, schemas
from eventlake.operators import cleaning

SF_DIR = "/root/testdata/sf0.001"


def test_silver_of_the_edge_rows(edge_bronze):
    silver = cleaning.clean(edge_bronze)
    assert silver.columns == schemas.SILVER.fieldNames()
    assert [f.dataType for f in silver.schema] == [f.dataType for f in schemas.SILVER]
    start = datetime(2024, 1, 2)
    kept = {(r.ingestion_timestamp - start).seconds: r for r in silver.collect()}
    assert sorted(kept) == [0, 2, 3, 4, 5, 7, 10, 11]
    assert kept[2].event_type == "view"
    assert kept[3].event_timestamp == datetime(2024, 1, 1, 10)
    assert kept[4].event_timestamp == datetime(2024, 1, 1, 10, 59, 59, 999999)


def test_normalising_first_merges_spellings(edge_bronze):
    assert cleaning.clean(edge_bronze, normalize_first=True).count() == 7


def test_duplicates_keep_the_first_arrival(edge_bronze):
    kept = cleaning.drop_duplicates(edge_bronze)
    assert kept.columns == edge_bronze.columns
    assert sorted(r.offset for r in kept.collect()) == [0, *range(2, 12), 14, 15]


def test_same_row_count_as_drop_duplicates(edge_bronze):
    builtin = edge_bronze.dropDuplicates(cleaning.DUPLICATE_KEY)
    assert cleaning.drop_duplicates(edge_bronze).count() == builtin.count()


def test_deduplication_is_idempotent(edge_bronze):
    once = cleaning.drop_duplicates(edge_bronze)
    assert rows(cleaning.drop_duplicates(once)) == rows(once)


def test_cleaning_order_does_not_matter(edge_bronze):
    """Filtering before deduplication, as done, gives what filtering after it gives."""
    late = (
        cleaning.drop_duplicates(edge_bronze)
        .filter("user_id IS NOT NULL AND lower(trim(event_type)) IN ('view', 'cart', 'purchase')")
        .filter("try_to_timestamp(event_timestamp) IS NOT NULL")
    )
    assert sorted(r.offset for r in late.collect()) == [0, 2, 3, 4, 5, 7, 10, 11]
    assert cleaning.clean(edge_bronze).count() == late.count()


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    bronze = adapters.redelivered_bronze(spark, SF_DIR)
    expected = rows(cleaning.clean(bronze))
    shuffled = bronze.repartition(partitions, F.rand(partitions))
    assert rows(cleaning.clean(shuffled)) == expected


def test_one_key_with_a_third_of_all_rows(spark):
    bronze = adapters.bronze(spark, SF_DIR)
    hot = bronze.filter("offset = 0").drop("offset")
    first, last = (F.lit(n).cast("bigint") for n in (1_000_000_000, 1_000_000_499))
    later = F.explode(F.sequence(first, last))
    copies = hot.select("*", later.alias("offset"))
    together = bronze.unionByName(copies)
    assert rows(cleaning.clean(together)) == rows(cleaning.clean(bronze))


def test_dropped_rows_are_counted_on_the_way(edge_bronze):
    counts = cleaning.DropCounts()
    assert len(cleaning.clean(edge_bronze, counts=counts).collect()) == 8
    assert counts.get() == {"rows_read": 17, "no_user": 3, "unknown_type": 2, "bad_time": 1}
