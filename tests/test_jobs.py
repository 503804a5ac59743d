"""The medallion flow end to end on tables derived from the smallest driver tables."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import canonical_rows
from conftest import SF_SMALL
from loadcast.plans import jobs, weather
from loadcast.sources import testviews as tv
from loadcast.sources.writers import write_table


def rows(df):
    return canonical_rows(df.columns, [tuple(r) for r in df.collect()])


def test_medallion_flow(spark, tmp_path):
    L = jobs.Layers(bronze="lc_bronze", silver="lc_silver", gold="lc_gold", results="lc_results", deliverables="lc_deliv",
                    locations={db: str(tmp_path / db) for db in ("lc_bronze", "lc_silver", "lc_gold", "lc_results", "lc_deliv")})
    L.create(spark)
    w = jobs.Windows(inference_start=tv.INFER_START, inference_end=tv.INFER_END, baseline_start=tv.BASE_START,
                     baseline_end=tv.BASE_END, future_end=tv.FUTURE_END, train_weather=(tv.WX_MIN, tv.WX_MAX),
                     inference_weather=(tv.WX_MIN, tv.WX_MAX), inference_weather_null=("2024-01-22 00:00:00", tv.WX_MAX),
                     ts_type=tv.TS)
    b = lambda n: f"lc_bronze.{n}"
    write_table(tv.consumption_wide(spark, SF_SMALL), b("consumption_data_raw"))
    write_table(tv.price_raw(spark, SF_SMALL), b("price_data_raw"))
    write_table(tv.calendar_raw(spark, SF_SMALL), b("calendar_data_raw"))
    write_table(tv.groups_raw(spark, SF_SMALL), b("groups_data_raw"))
    write_table(tv.weather_inference_raw(spark, SF_SMALL), b("weather_hourly_inference_raw"))
    write_table(weather.build_weather_long(tv.weather_landing(spark, SF_SMALL), "source_table"), b("weather_data_long"))
    write_table(tv.bridge(spark, SF_SMALL), "lc_silver.group_weather_map")

    jobs.consumption_job(spark, b("consumption_data_raw"), w, L, scale=2)
    jobs.price_job(spark, b("price_data_raw"), w, L)
    jobs.weather_job(spark, b("weather_data_long"), b("weather_hourly_inference_raw"), w, L)
    jobs.calendar_job(spark, b("calendar_data_raw"), b("calendar_data_raw"), w, L)
    jobs.groups_job(spark, b("groups_data_raw"), L)
    assert len(jobs.gold_job(spark, L, "lc_silver.group_weather_map")) == 7

    # the table flow gives the same gold rows as the single-plan query
    gold = spark.table("lc_gold.hourly_training_dataset_with_weather")
    assert rows(gold) == rows(entry.queries()["gold_hourly_with_weather"](spark, SF_SMALL))
    # partition pruning on the split column
    plan = spark.table("lc_silver.consumption_hourly_training_clean")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    # weather-null: spine too short -> every weather feature NULL, bridge kept
    null_wx = spark.table("lc_gold.hourly_inference_dataset_weather_null")
    assert null_wx.filter(F.col("temp_lag_24").isNotNull() | F.col("temperature_missing_flag").isNotNull()).count() == 0
    assert null_wx.filter(F.col("weather_key").isNotNull()).count() > 0
    assert rows(null_wx) == rows(jobs.null_exogenous_inference(spark, L))

    model = jobs.train_job(spark, L, "hourly", "without_weather", False, str(tmp_path / "models"), max_iter=2,
                           cutoff=tv.VALID_CUTOFF)
    out = jobs.predict_job(spark, L, str(tmp_path / "models"), "hourly", "without_weather")  # the saved model
    assert rows(spark.table(f"lc_results.{out}")) == rows(model.predict(spark.table("lc_gold.hourly_inference_dataset_without_weather")))
    preds = [r[0] for r in spark.table(f"lc_results.{out}").select("target_consumption").collect()]
    assert len(preds) == 48 * tv.N_GROUPS and all(math.isfinite(p) for p in preds)
    metrics = jobs.evaluate_job(spark, L, {"without_weather": out}).collect()
    assert [m["model"] for m in metrics] == ["without_weather"]

    jobs.hourly_deliverable_job(spark, L, out)
    assert spark.table("lc_deliv.consumption_deliverables_hourly").count() == 48

    mmodel = jobs.train_job(spark, L, "monthly", "", False, str(tmp_path / "models"), max_iter=2, cutoff=tv.VALID_CUTOFF)
    jobs.predict_job(spark, L, mmodel, "monthly", "")
    jobs.monthly_deliverable_job(spark, L, w)
    combined = spark.table("lc_results.consumption_monthly_combined")
    assert combined.count() == 3 and len(combined.columns) == 1 + tv.N_GROUPS  # Jan actual; Jan + Feb predicted
    jobs.export_job(spark, "lc_deliv.consumption_deliverables_monthly", str(tmp_path / "export"), ["measured_at"],
                    decimal_comma=True, single_file=True)
    done = jobs.export_all(spark, L, str(tmp_path / "exports"), names=("hourly_training_dataset_without_weather",
                                                                       "consumption_deliverables_hourly"))
    back = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "exports" / "consumption_deliverables_hourly_csv"))
    assert len(done) == 2 and back.count() == 48
    assert any("," in (r[1] or "") for r in back.collect())  # decimal comma
    for db in ("lc_bronze", "lc_silver", "lc_gold", "lc_results", "lc_deliv"):
        spark.sql(f"DROP DATABASE {db} CASCADE")
