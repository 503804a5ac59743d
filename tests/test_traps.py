"""One test per semantic trap of the modelled jobs (see README, 'Semantics kept')."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.functions import (
    assemble_timestamp, decimal_comma_to_double, double_to_decimal_comma, key_from_prefix, normalize_name, tolerant_double,
)
from loadcast.operators import spine
from loadcast.plans import calendar, deliver, evaluate, features, gold, weather

T0 = dt.datetime(2024, 1, 1)


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()[0]


def test_t2_weather_null_spine_too_short_gives_empty_features(spark):
    obs = spark.createDataFrame([("HEL", T0 + dt.timedelta(hours=h), 1.0) for h in range(216)],
                                "weather_key string, timestamp_utc timestamp_ntz, temperature double")
    out = weather.weather_features(obs, "2024-01-01 00:00:00", "2024-01-09 23:00:00", ts_type="timestamp_ntz")
    assert out.count() == 0  # 216 hours per key, 336 dropped


def test_t7_duplicate_observations_multiply_grid_rows(spark):
    obs = spark.createDataFrame([("HEL", T0, 1.0), ("HEL", T0, 2.0)], "weather_key string, timestamp_utc timestamp_ntz, temperature double")
    dense = spine.densify(obs, ["weather_key"], "2024-01-01 00:00:00", "2024-01-01 02:00:00", ts_type="timestamp_ntz")
    assert dense.count() == 4


def test_t8_null_description_is_not_a_holiday(spark):
    raw = spark.createDataFrame([("2024-01-17", None, None), ("2024-01-06", "Epiphany", False)],
                                "timestamp string, desc string, working_day boolean")
    out = calendar.expand_calendar_hourly(raw, ts_type="timestamp_ntz")
    assert out.count() == 48
    assert {tuple(r) for r in out.groupBy("desc").agg(F.max("is_holiday")).collect()} == {(None, 0), ("Epiphany", 1)}
    sat = out.filter(F.col("desc") == "Epiphany").select("day_of_week", "is_weekend").distinct().collect()
    assert [tuple(r) for r in sat] == [(6, 1)]


def test_t9_strict_cast_fails_on_decimal_comma_and_tolerant_cast_nulls(spark):
    with pytest.raises(PySparkException):
        one(spark, F.col("x").cast("double"), value="12,5")
    assert one(spark, decimal_comma_to_double("x"), value="-3,01") == -3.01
    assert one(spark, decimal_comma_to_double("x", on_error="null"), value="1,2,3") is None


def test_t10_nan_text_stays_nan(spark):
    assert math.isnan(one(spark, tolerant_double("x"), value="NaN"))
    assert one(spark, tolerant_double("x"), value="-") is None
    assert one(spark, tolerant_double("x", nan_as_null=True), value="NaN") is None


def test_t11_null_date_part_gives_null_timestamp(spark):
    df = spark.createDataFrame([(2024, None, 5, "7:00"), (2021, 1, 1, "0:00")], "y int, m int, d int, h string")
    got = [r[0] for r in df.select(assemble_timestamp("y", "m", "d", "h", "timestamp_ntz")).collect()]
    assert got == [None, dt.datetime(2021, 1, 1, 0, 0)]


def test_t12_decimal_columns_are_exported_with_comma(spark):
    df = spark.createDataFrame([(1, 2.5)], "id int, v double").withColumn("d", F.lit("3.25").cast("decimal(5,2)"))
    row = deliver.decimal_comma_projection(df).first()
    assert (row["id"], row["v"], row["d"]) == (1, "2,5", "3,25")


def test_t13_scientific_rendering_kept_unless_scale(spark):
    assert one(spark, double_to_decimal_comma("x"), "x double", 1.0e-5) == "1,0E-5"
    assert one(spark, double_to_decimal_comma("x", scale=6), "x double", 1.0e-5) == "0,000010"
    assert one(spark, double_to_decimal_comma("x", scale=2), "x double", 12345678.5) == "12345678,50"


def test_t17_full_name_normaliser(spark):
    assert one(spark, normalize_name("x"), value=" HÄMEENLINNA ") == "hameenlinna"
    assert one(spark, normalize_name("x"), value="Åbo") == "abo"
    assert one(spark, key_from_prefix(normalize_name("x"), weather.WEATHER_KEYS), value="Jyväskylä") == "JYV"
    assert one(spark, key_from_prefix(normalize_name("x"), weather.WEATHER_KEYS), value="Åbo") is None


def _eval_frames(spark, actuals, preds, base):
    schema = "timestamp_utc timestamp_ntz, group_id int, target_consumption double"
    a = spark.createDataFrame([(T0 + dt.timedelta(hours=h), g, v) for h, g, v in actuals], schema)
    b = spark.createDataFrame([(T0 + dt.timedelta(hours=h) - dt.timedelta(days=7), g, v) for h, g, v in base], schema)
    p = spark.createDataFrame([(T0 + dt.timedelta(hours=h), g, "m", v) for h, g, v in preds],
                              "timestamp_utc timestamp_ntz, group_id int, model string, target_consumption double")
    return p, a, b


def test_t18_t19_inner_joins_zero_actuals_and_zero_baseline_mape(spark):
    # group 2 has no baseline -> dropped; actual 0 -> excluded from MAPE but not from MAE
    p, a, b = _eval_frames(spark, [(0, 1, 10.0), (1, 1, 0.0), (0, 2, 5.0)],
                           [(0, 1, 11.0), (1, 1, 1.0), (0, 2, 5.0)],
                           [(0, 1, 10.0), (1, 1, 2.0)])
    r = evaluate.evaluate(p, a, b, with_counts=True).first()
    assert r["matched_rows"] == 2
    assert r["prediction_MAE"] == pytest.approx(1.0)
    assert r["baseline_MAE"] == pytest.approx(1.0)
    assert r["prediction_MAPE_percent"] == pytest.approx(10.0)
    assert r["baseline_MAPE_percent"] == pytest.approx(0.0)
    assert r["FVA_percent"] is None  # baseline MAPE 0 -> NULL, not an error


def test_t3_gap_parameter_removes_in_window_leakage(spark):
    rows = [(1, T0 + dt.timedelta(hours=h), float(h)) for h in range(400)]
    df = spark.createDataFrame(rows, "group_id int, timestamp_utc timestamp_ntz, target_consumption double")
    leak = features.hourly_features(df, gap=1).orderBy("timestamp_utc").first()
    free = features.hourly_features(df, gap=48).orderBy("timestamp_utc").first()
    assert leak["rolling_mean_168"] == pytest.approx(sum(range(168, 336)) / 168)
    assert free["rolling_mean_168"] == pytest.approx(sum(range(121, 289)) / 168)


def test_t20_monthly_ids_come_from_predictions(spark):
    schema = "timestamp_utc timestamp_ntz, group_id int, target_consumption double"
    hist = spark.createDataFrame([(T0, 1, 1.0), (T0, 2, 2.0)], schema)
    pred = spark.createDataFrame([(T0 + dt.timedelta(days=40), 1, 3.0)], schema)
    actual, predicted, combined = deliver.monthly_deliverables(hist, pred, ts_type="timestamp_ntz")
    assert actual.columns == ["measured_at", "1"] and combined.count() == 2


def test_t22_session_time_zone_is_pinned(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    raw = spark.createDataFrame([("2024-03-31", "weekend", False)], "timestamp string, desc string, working_day boolean")
    assert calendar.expand_calendar_hourly(raw).count() == 24  # no DST day stretched over two dates


def test_weather_null_variant_keeps_bridge_and_blanks_weather(spark):
    schema = "timestamp_utc timestamp_ntz, group_id int, target_consumption double, " + ", ".join(
        f"{c} double" for c in features.FEATURE_COLUMNS)
    fact = spark.createDataFrame([(T0, 1, None, *([1.0] * 7))], schema)
    groups = spark.createDataFrame([(1, "a", "b", "c", "d", "e", "f")],
                                   "group_id int, macro_region string, region string, municipality string, segment string, "
                                   "product_type string, consumption_bucket string")
    cal = calendar.expand_calendar_hourly(
        spark.createDataFrame([("2024-01-01", "x", True)], "timestamp string, desc string, working_day boolean"),
        ts_type="timestamp_ntz")
    bridge = spark.createDataFrame([(1, "HEL")], "group_id int, weather_key string")
    out = gold.build_gold(fact, groups, cal, bridge=bridge, weather_mode="null").first()
    assert out["weather_key"] == "HEL" and out["temperature_missing_flag"] is None and out["temp_lag_24"] is None
    assert out["hour_of_day"] == 0


def test_iso_offsets_are_applied_when_parsing(spark):
    from loadcast.functions import to_ts
    df = spark.createDataFrame([("2024-01-05T07:00:00Z",), ("2024-01-05T09:00:00+02:00",), ("2024-01-05 07:00:00",)], "x string")
    got = {r[0] for r in df.select(to_ts("x", "timestamp_ntz")).collect()}
    assert got == {dt.datetime(2024, 1, 5, 7, 0)}


def test_t1_densify_option_makes_lags_temporal(spark):
    rows = [(1, T0 + dt.timedelta(hours=h), float(h)) for h in range(400) if h != 350]
    df = spark.createDataFrame(rows, "group_id int, timestamp_utc timestamp_ntz, target_consumption double")
    pos = {r["timestamp_utc"]: r for r in features.hourly_features(df).collect()}
    tmp = {r["timestamp_utc"]: r for r in features.hourly_features(
        df, densify=("2024-01-01 00:00:00", "2024-01-17 15:00:00"), ts_type="timestamp_ntz").collect()}
    t = T0 + dt.timedelta(hours=360)
    assert tmp[t]["consumption_lag_48"] == 312.0          # 48 hours earlier
    assert pos[t]["consumption_lag_48"] == 311.0          # 48 rows earlier (one hour missing)
    assert tmp[T0 + dt.timedelta(hours=350)]["target_consumption"] is None


def test_pivot_id_collection_is_bounded(spark):
    from loadcast.operators.reshape import sorted_distinct_ids
    df = spark.range(50).withColumnRenamed("id", "group_id")
    assert sorted_distinct_ids(df, max_ids=50) == list(range(50))
    with pytest.raises(ValueError):
        sorted_distinct_ids(df, max_ids=49)
