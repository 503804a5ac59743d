"""Physical-plan properties of the registered queries: no single-partition window over rows,
no cartesian / nested-loop joins, no Python UDFs, filters reach the scan, one exchange for features."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from loadcast import registry
from loadcast.operators import index, splits

QUERIES = {n: q for n, q in entry.queries().items() if n in registry.queries()}
LEARNING = {"gbt_forecast", "gbt_forecast_rows", "category_codes", "boosted_splits"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LEARNING))
def test_no_cartesian_nested_loop_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["global_lag_features", "drop_head_global", "hourly_features", "hourly_features_per_group",
                                  "gold_hourly_with_weather",
                                  "supplier_daily_features_blocked", "calendar_hourly"])
def test_rows_never_funnel_into_one_partition(spark, name):
    """SinglePartition exchanges may only carry a keyless partial aggregate (one row per task)
    or the per-bucket count table of a row index (one row per day)."""
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = "\n".join(lines[i + 1:i + 3])
            assert "HashAggregate(keys=[]" in child or "_bkt" in child, f"{name}: {child}"


def test_hourly_features_use_one_exchange_one_window(spark):
    text = plan(QUERIES["hourly_features_per_group"](spark, SF_SMALL))
    window_part = text.split("Window")[0]
    assert text.count("Window [") + text.count("Window(") >= 1
    assert len(re.findall(r"\bWindow\b", text)) == 1, text
    assert "hashpartitioning(group_id" in text
    assert window_part.count("Exchange") == 0


def test_gold_broadcasts_every_dimension(spark):
    text = plan(QUERIES["gold_hourly_with_weather"](spark, SF_SMALL))
    facts = re.sub(r"InMemoryRelation.*", "", text)
    assert len(re.findall(r"BroadcastHashJoin .*LeftOuter", facts)) >= 5 and "BroadcastNestedLoopJoin" not in facts


def test_time_filter_is_pushed_to_the_scan(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("ts", "timestamp_utc")
    text = plan(splits.split_window(events.select("timestamp_utc", "value"), "2024-01-10", "2024-01-12", ts_type="timestamp_ntz"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_row_index_has_no_single_partition_row_exchange(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    text = plan(index.row_index(events, "ts"))
    rows_side = text.split("BroadcastExchange")[0]
    assert "SinglePartition" not in rows_side


@pytest.mark.parametrize("name", ["hourly_features", "weather_features_split", "forward_fill_split", "global_lag_features"])
def test_index_join_reuses_the_row_number_partitioning(spark, name):
    """NULL-safe keys are plain columns, so the numbered rows are not shuffled again for the offsets join."""
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"Exchange hashpartitioning\(coalesce\(", text), name


def test_default_feature_window_is_partitioned_by_group_and_block(spark):
    text = plan(QUERIES["hourly_features"](spark, SF_SMALL))
    assert re.search(r"Exchange hashpartitioning\(group_id#\d+, _blk#\d+L?,", text), "blocked window not keyed by (group, block)"


def test_since_filter_reaches_the_scan(spark):
    from loadcast.plans import features
    from loadcast.sources import testviews as tv

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("ts").alias("timestamp_utc"), (F.col("user_id") % 3).cast("int").alias("group_id"),
        F.col("value").alias("target_consumption"))
    text = plan(features.hourly_features(events, since="2024-01-29 00:00:00", ts_type=tv.TS, gap_free=True))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-01T00:00)]" in text, text[-2000:]


def test_metrics_start_no_job_while_building(spark):
    names = ("model_comparison", "evaluate_forecast", "gold_hourly_with_weather_sql")
    for name in names:
        QUERIES[name](spark, SF_SMALL)  # table footers are read once per application
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "plans only")
    try:
        for name in names:
            QUERIES[name](spark, SF_SMALL)
        assert list(tracker.getJobIdsForGroup("build-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)


def test_hot_null_weather_key_is_split_over_tasks(spark):
    """Half of all rows have no key: positions of the split form come from (key, day) parts."""
    from loadcast.plans import weather

    rows = spark.range(8000).select(
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, int(id div 2))").alias("timestamp_utc"),
        F.when(F.col("id") % 2 == 0, "HEL").alias("weather_key"), F.col("id").cast("double").alias("temperature"))
    split = weather.drop_latest_horizon(rows, 48, split=True)
    text = plan(split)
    assert not re.search(r"Exchange hashpartitioning\(weather_key#\d+, \d+\)", text)
    assert re.search(r"Exchange hashpartitioning\([^)]*_bkt", text)
    assert sorted(map(str, split.collect())) == sorted(map(str, weather.drop_latest_horizon(rows, 48).collect()))


def test_gold_reads_every_side_once_and_keeps_the_facts_in_place(spark, tmp_path):
    from loadcast.plans import gold
    from loadcast.sources import testviews as tv

    frames = {"consumption": QUERIES["hourly_features"](spark, SF_SMALL), "groups": QUERIES["parse_group_label"](spark, SF_SMALL),
              "calendar": QUERIES["calendar_hourly"](spark, SF_SMALL), "bridge": tv.bridge(spark, SF_SMALL),
              "weather": QUERIES["weather_features"](spark, SF_SMALL)}
    tables = {}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gold-build", "plan only")
    try:
        out = gold.build_gold(**tables, weather_mode="join")
        text = plan(out)
        assert list(tracker.getJobIdsForGroup("gold-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert text.count("FileScan parquet") == len(frames)  # every side is read once
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
    assert out.count() == frames["consumption"].count()


@pytest.mark.parametrize("salts", [1, 4])
def test_sparse_left_join_spreads_rows_without_a_key(spark, salts):
    from loadcast.operators import joins

    left = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("k"), F.lit(1).alias("t"), F.lit(3).alias("_salt"))
    right = spark.range(6).select(F.col("id").alias("k"), F.lit(1).alias("t"), (F.col("id") * 10).alias("v"))
    spread = joins.left_join_sparse(left, right, ["k", "t"], salts, max_bytes=0)
    key = lambda df: sorted(map(str, df.select("id", "k", "t", "_salt", "v").collect()))
    assert key(spread) == key(left.join(right, ["k", "t"], "left")) == key(joins.left_join_sparse(left, right, ["k", "t"]))
    text = plan(spread)
    assert "Union" in text and ("_salt_" in text) == (salts > 1)
    shuffled = [r["n"] for r in spread.filter("k is null").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(shuffled) > 1 and max(shuffled) <= 10000 / 2  # the rows that match nothing stay where they were read
