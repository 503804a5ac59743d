"""Publishing a table in one catalog step: a failed job changes nothing, open readers finish, versions are kept by count."""

import os

import pytest
from pyspark.sql import functions as F

from loadcast.plans import gold
from loadcast.sources import writers


@pytest.fixture()
def db(spark, tmp_path):
    name = "lc_publish"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).select("id").collect())


def test_a_job_that_dies_leaves_the_old_rows(spark, db):
    t = f"{db}.facts"
    writers.write_table(spark.range(5), t)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 990, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="killed"):
        writers.write_table(broken, t)
    assert ids(spark, t) == [0, 1, 2, 3, 4] and len(writers.versions(spark, t)) == 1
    with pytest.raises(ValueError, match="check"):
        writers.publish(spark.range(9), t, check=lambda df: df.count() < 5)
    assert ids(spark, t) == [0, 1, 2, 3, 4]


def test_open_readers_finish_and_old_versions_go(spark, db):
    t = f"{db}.facts"
    writers.write_table(spark.range(3), t)
    reader = spark.table(t)
    assert reader.count() == 3
    writers.write_table(spark.range(7), t)
    assert reader.count() == 3 and spark.table(t).count() == 7
    for n in range(8, 12):
        writers.write_table(spark.range(n), t)
    assert len(writers.versions(spark, t)) == writers.KEPT_VERSIONS and spark.table(t).count() == 11


def test_columns_may_change_and_partitions_prune(spark, db):
    t = f"{db}.facts"
    writers.write_table(spark.range(3), t)
    writers.write_table(spark.range(10).select((F.col("id") % 2).alias("part"), F.col("id").alias("value")), t, partition_by=["part"])
    df = spark.table(t).filter("part = 1")
    assert df.columns == ["part", "value"] and df.count() == 5
    assert "PartitionFilters: [isnotnull(part" in df._jdf.queryExecution().executedPlan().toString()


def test_a_plain_table_is_replaced_and_a_table_may_read_itself(spark, db):
    t = f"{db}.facts"
    spark.range(4).write.saveAsTable(t)
    writers.write_table(spark.table(t).filter("id > 1"), t)
    assert ids(spark, t) == [2, 3]
    writers.write_table(spark.table(t).unionAll(spark.range(1)), t)
    assert ids(spark, t) == [0, 2, 3]


def test_create_gold_table_by_select(spark, db):
    gold.create_gold_table(spark, f"{db}.g", "SELECT id, id * 2 AS twice FROM range(4)")
    gold.create_gold_table(spark, f"{db}.g", "SELECT id FROM range(2)")
    assert ids(spark, f"{db}.g") == [0, 1]
    writers.write_table(spark.range(2), f"{db}.plain", mode="append")
    writers.write_table(spark.range(2), f"{db}.plain", mode="append")
    assert spark.table(f"{db}.plain").count() == 4 and not os.path.exists("spark-warehouse/facts")
