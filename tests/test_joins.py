"""Which sides of a join are broadcast."""

from pyspark.sql import functions as F

from loadcast.operators import joins


def hinted(df):
    return df._jdf.queryExecution().analyzed().toString().startswith("ResolvedHint")


def test_sides_are_broadcast_by_their_measured_bytes(spark):
    """Few rows may be many bytes: the driver holds what is broadcast."""
    ids = spark.range(2000).join(spark.range(2000), "id")  # estimated as the product of its sides
    wide = ids.withColumn("text", F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 1000)))
    assert not hinted(joins.bounded(wide, max_bytes=1 << 20)) and hinted(joins.bounded(wide, max_bytes=4 << 20))
    assert hinted(joins.bounded(ids, max_bytes=1 << 20)) and not hinted(joins.bounded(ids, max_bytes=1 << 20, max_rows=1999))


def test_row_bytes_of_any_type(spark):
    df = spark.sql("SELECT 1 AS a, 'äb' AS `b.c`, CAST(NULL AS string) AS d, array(1, 22) AS e, map('k', 1) AS f, unhex('0102') AS g, current_date() AS h")
    assert df.select(joins.row_bytes(df)).first()[0] == 8 * 8 + 3 + len("[1, 22]") + len("{k -> 1}") + 2


def test_a_large_file_is_measured_before_it_is_broadcast(spark, tmp_path):
    table = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    table.coalesce(1).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    size = joins.estimated_bytes(stored)
    assert size < 40_000 * (24 + 64)
    assert not hinted(joins.bounded(stored, max_bytes=size + 1)) and hinted(joins.bounded(stored, max_bytes=8 << 20))
