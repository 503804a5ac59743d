"""Properties from the test strategy: round trips, partitions of the timeline, gold grain, and
the golden inference-weather timeline with the pipeline's own dates."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from loadcast.operators import reshape
from loadcast.plans import features, weather
from loadcast.sources import testviews as tv

Q = entry.queries()


def test_unpivot_then_pivot_is_identity(spark):
    wide = tv.consumption_wide(spark, SF_SMALL)
    long = reshape.to_long(wide, ts_type="string")  # keep measured_at text for the round trip
    back = reshape.to_wide(long, "timestamp_utc", "group_id", "target_consumption", tv.GROUP_IDS, agg="first")
    back = back.withColumnRenamed("timestamp_utc", "measured_at").select(*wide.columns)
    assert back.exceptAll(wide).count() == 0 and wide.exceptAll(back).count() == 0


def test_train_and_inference_partition_the_post_head_rows(spark):
    feats = Q["hourly_features"](spark, SF_SMALL)
    train = Q["split_half_open"](spark, SF_SMALL)
    infer = Q["null_target_inference"](spark, SF_SMALL)
    keys = ["timestamp_utc", "group_id"]
    later = feats.filter(F.col("timestamp_utc") >= F.lit(tv.INFER_END).cast(tv.TS))
    assert train.count() + infer.count() + later.count() == feats.count()
    assert train.select(keys).union(infer.select(keys)).union(later.select(keys)).distinct().count() == feats.count()
    assert infer.filter(F.col("target_consumption").isNotNull()).count() == 0


def test_gold_keeps_the_consumption_grain(spark):
    for name in ("gold_hourly_with_weather", "gold_hourly_without_weather", "gold_hourly_weather_null", "gold_monthly"):
        g = Q[name](spark, SF_SMALL)
        assert g.count() == g.select("timestamp_utc", "group_id").distinct().count(), name
    assert Q["gold_hourly_with_weather"](spark, SF_SMALL).count() == Q["split_half_open"](spark, SF_SMALL).count()
    assert Q["gold_monthly"](spark, SF_SMALL).count() == Q["unpivot_wide_to_long"](spark, SF_SMALL).count()


def test_t6_inference_weather_timeline(spark):
    """Observations 09-21T00..09-30T00, latest dropped -> last obs 09-29T23; spine 09-15..09-30T23
    (384 h), 336 dropped -> 48 rows per key; the 09-30 rows are missing (flag 1) and filled."""
    start = dt.datetime(2024, 9, 21)
    raw = spark.createDataFrame(
        [((start + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ"), "helsinki", str(float(h)), "1.0", "0.0")
         for h in range(217)],
        "timestamp string, city string, TA_PT1H_AVG string, WS_PT1H_AVG string, PRA_PT1H_ACC string")
    prepared = weather.prepare_weather_inference(raw, ts_type="timestamp_ntz")
    assert prepared.agg(F.max("timestamp_utc")).first()[0] == dt.datetime(2024, 9, 29, 23)
    feats = weather.weather_features(prepared, "2024-09-15 00:00:00", "2024-09-30 23:00:00", ts_type="timestamp_ntz")
    rows = {r["timestamp_utc"]: r for r in feats.collect()}
    assert len(rows) == 48 and min(rows) == dt.datetime(2024, 9, 29)
    day30 = [r for t, r in rows.items() if t.day == 30]
    assert len(day30) == 24 and all(r["temperature_missing_flag"] == 1 for r in day30)
    assert all(r["temperature_missing_flag"] == 0 for t, r in rows.items() if t.day == 29)
    # lag 24 on 09-30 reads 09-29 observations; lag 24 at 09-30T23 + 24h would be the filled 09-29T23 value
    assert rows[dt.datetime(2024, 9, 30, 5)]["temp_lag_24"] == float(8 * 24 + 5)
    split = weather.weather_features(prepared, "2024-09-15 00:00:00", "2024-09-30 23:00:00", ts_type="timestamp_ntz",
                                     block_rows=200)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, feats.collect()))


def test_t2_weather_null_window_is_empty_in_the_pipeline_dates(spark):
    start = dt.datetime(2024, 9, 21)
    obs = spark.createDataFrame([("HEL", start + dt.timedelta(hours=h), 1.0) for h in range(216)],
                                "weather_key string, timestamp_utc timestamp_ntz, temperature double")
    feats = weather.weather_features(obs, "2024-09-22 00:00:00", "2024-09-30 23:00:00", ts_type="timestamp_ntz")
    assert feats.count() == 0
