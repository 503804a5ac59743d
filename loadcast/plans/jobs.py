"""Table-to-table jobs of the medallion flow (silver -> gold -> models -> results -> deliverables).

Every job reads tables, writes tables (``mode='overwrite'``) and returns nothing but the
names it wrote; written tables cut the lineage between jobs, so a lost executor only
recomputes work of the running job. All dates are parameters (``Windows``)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.operators import reshape, splits
from loadcast.plans import calendar, deliver, evaluate, features, gold, groups, ml, price, weather
from loadcast.sources.writers import export_csv, write_table


@dataclass
class Windows:
    # Fixed values (defaults): the pipeline's inference, baseline, future and weather windows.
    inference_start: str = "2024-09-29 00:00:00"
    inference_end: str = "2024-10-01 00:00:00"
    baseline_start: str = "2024-09-22 00:00:00"
    baseline_end: str = "2024-09-24 00:00:00"
    future_end: str = "2025-10-01 00:00:00"
    train_weather: tuple[str, str] = ("2021-01-01 00:00:00", "2024-09-30 23:00:00")
    inference_weather: tuple[str, str] = ("2024-09-15 00:00:00", "2024-09-30 23:00:00")
    inference_weather_null: tuple[str, str] = ("2024-09-22 00:00:00", "2024-09-30 23:00:00")
    ts_type: str = "timestamp"


@dataclass
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    results: str = "results"
    deliverables: str = "deliverables"
    locations: dict[str, str] = field(default_factory=dict)  # database -> shared storage path

    def create(self, spark: SparkSession) -> None:
        for db in (self.bronze, self.silver, self.gold, self.results, self.deliverables):
            loc = self.locations.get(db)
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`" + (f" LOCATION '{loc}'" if loc else ""))


def _t(db: str, name: str) -> str:
    return f"`{db}`.`{name}`"


def _view(spark: SparkSession, name: str, df_sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {df_sql}")


# ------------------------------------------------------------------ silver


def consumption_job(spark: SparkSession, raw_table: str, w: Windows, L: Layers, scale: int | None = None,
                    wide: bool | None = None) -> list[str]:
    """Wide raw -> long -> features computed once, written partitioned by ``split``
    (train / inference / later); training, inference (NULL target), actuals and baseline are
    views that prune partitions. Monthly history and the 12-month future grid are written too.
    ``scale`` and ``wide``: as in ``hourly_features``; by default nothing is assumed about the readings' decimals."""
    long = reshape.to_long(spark.table(raw_table), ts_type=w.ts_type)
    ts = F.col("timestamp_utc")
    start, end = (F.lit(x).cast(w.ts_type) for x in (w.inference_start, w.inference_end))
    split = F.when(ts < start, "train").when(ts < end, "inference").otherwise("later")
    feats = features.hourly_features(long, scale=scale, wide=wide).withColumn("split", split)
    base = _t(L.silver, "consumption_hourly_features")
    write_table(feats, base, partition_by=["split"])
    cols = ", ".join(["timestamp_utc", "group_id", "target_consumption", *features.FEATURE_COLUMNS])
    cols_null = cols.replace("target_consumption", "CAST(NULL AS DOUBLE) AS target_consumption")
    _view(spark, _t(L.silver, "consumption_hourly_training_clean"), f"SELECT {cols} FROM {base} WHERE split = 'train'")
    _view(spark, _t(L.silver, "consumption_hourly_inference_clean"), f"SELECT {cols_null} FROM {base} WHERE split = 'inference'")
    _view(spark, _t(L.results, "consumption_hourly_actuals"), f"SELECT {cols} FROM {base} WHERE split = 'inference'")
    _view(spark, _t(L.results, "consumption_hourly_baseline"),
          f"SELECT {cols} FROM {base} WHERE split = 'train' AND timestamp_utc >= CAST('{w.baseline_start}' AS {w.ts_type}) "
          f"AND timestamp_utc < CAST('{w.baseline_end}' AS {w.ts_type})")
    hist, future = features.monthly_train_inference(long, w.inference_end, w.future_end, ts_type=w.ts_type)
    write_table(hist, _t(L.silver, "consumption_monthly_training_clean"))
    write_table(future, _t(L.silver, "consumption_monthly_inference_clean"))
    return [base, "consumption_monthly_training_clean", "consumption_monthly_inference_clean"]


def price_job(spark: SparkSession, raw_table: str, w: Windows, L: Layers) -> None:
    feats = price.price_features(spark.table(raw_table), ts_type=w.ts_type)
    train, infer = price.split_price(feats, w.inference_start, w.inference_end, ts_type=w.ts_type)
    write_table(train, _t(L.silver, "price_training_clean"))
    write_table(infer, _t(L.silver, "price_inference_clean"))


def weather_job(spark: SparkSession, landing_long_table: str, inference_raw_table: str, w: Windows, L: Layers,
                block_rows: int | None = 65_536) -> None:
    """Training features from the long landing table (C6-C8) and both inference variants (C5, C7).
    Default: the split plan (fill and positions per key and day, lags per block), which holds for any key length,
    the NULL key of all unknown cities included; ``block_rows=None`` puts one key in one task, for many short keys."""
    split = block_rows is not None
    obs = weather.prepare_weather_training(spark.table(landing_long_table), w.ts_type)
    feats = weather.weather_features(obs, *w.train_weather, ts_type=w.ts_type, block_rows=block_rows)
    write_table(weather.drop_latest_horizon(feats, split=split), _t(L.silver, "weather_training_clean"))
    inf = weather.prepare_weather_inference(spark.table(inference_raw_table), w.ts_type, split=split)
    write_table(weather.weather_features(inf, *w.inference_weather, ts_type=w.ts_type, block_rows=block_rows),
                _t(L.silver, "weather_inference_clean"))
    write_table(weather.weather_features(inf, *w.inference_weather_null, ts_type=w.ts_type, block_rows=block_rows),
                _t(L.silver, "weather_inference_null_clean"))


def calendar_job(spark: SparkSession, raw_table: str, monthly_raw_table: str, w: Windows, L: Layers) -> None:
    hourly = calendar.expand_calendar_hourly(spark.table(raw_table), ts_type=w.ts_type)
    train, infer = calendar.split_calendar_hourly(hourly, w.inference_start, w.inference_end, ts_type=w.ts_type)
    write_table(train, _t(L.silver, "calendar_hourly_training_clean"))
    write_table(infer, _t(L.silver, "calendar_hourly_inference_clean"))
    write_table(hourly, _t(L.silver, "calendar_monthly_training_clean"))
    write_table(calendar.expand_calendar_hourly(spark.table(monthly_raw_table), ts_type=w.ts_type),
                _t(L.silver, "calendar_monthly_inference_clean"))


def groups_job(spark: SparkSession, raw_table: str, L: Layers) -> None:
    write_table(groups.parse_groups(spark.table(raw_table)), _t(L.silver, "group_data_clean"))


# ------------------------------------------------------------------ gold

GOLD_VARIANTS = {
    # name: (consumption, price, weather, calendar, weather_mode)
    "hourly_training_dataset_with_weather": ("consumption_hourly_training_clean", "price_training_clean",
                                             "weather_training_clean", "calendar_hourly_training_clean", "join"),
    "hourly_inference_dataset_with_weather": ("consumption_hourly_inference_clean", "price_inference_clean",
                                              "weather_inference_clean", "calendar_hourly_inference_clean", "join"),
    "hourly_inference_dataset_weather_null": ("consumption_hourly_inference_clean", "price_inference_clean",
                                              "weather_inference_null_clean", "calendar_hourly_inference_clean", "join"),
    "hourly_training_dataset_without_weather": ("consumption_hourly_training_clean", "price_training_clean", None,
                                                "calendar_hourly_training_clean", "none"),
    "hourly_inference_dataset_without_weather": ("consumption_hourly_inference_clean", "price_inference_clean", None,
                                                 "calendar_hourly_inference_clean", "none"),
    "monthly_training_dataset": ("consumption_monthly_training_clean", None, None, "calendar_monthly_training_clean", "none"),
    "monthly_inference_dataset": ("consumption_monthly_inference_clean", None, None, "calendar_monthly_inference_clean", "none"),
}


def gold_job(spark: SparkSession, L: Layers, bridge_table: str, variants=tuple(GOLD_VARIANTS)) -> list[str]:
    s = lambda n: spark.table(_t(L.silver, n))
    written = []
    for name in variants:
        cons, pr, wx, cal, mode = GOLD_VARIANTS[name]
        df = gold.build_gold(
            s(cons), s("group_data_clean"), s(cal), price=s(pr) if pr else None, weather=s(wx) if wx else None,
            bridge=spark.table(bridge_table) if mode != "none" else None, weather_mode=mode,
            hourly_features=name.startswith("hourly"),
        )
        write_table(df, _t(L.gold, name))
        written.append(name)
    return written


# ------------------------------------------------------------------ models, results, deliverables


def train_job(spark: SparkSession, L: Layers, frequency: str, variant: str, include_weather: bool, model_root: str,
              max_iter: int = 1000, cutoff: str | None = None, training_variant: str | None = None) -> ml.Forecaster:
    """Train on ``gold.{frequency}_training_dataset[_{training_variant or variant}]``; save under
    ``model_root/{frequency}[_{variant}]``. ``cutoff`` defaults to the frequency's validation cutoff.
    (The weather-null model trains on the with-weather training set.)"""
    tv = training_variant if training_variant is not None else variant
    source = f"{frequency}_training_dataset" + (f"_{tv}" if tv else "")
    model = ml.train_forecaster(spark.table(_t(L.gold, source)), ml.categorical_columns(include_weather),
                                cutoff=cutoff or ml.validation_cutoff(frequency), max_iter=max_iter)
    model.save(f"{model_root}/{ml.artifact_name(frequency, variant)}")
    return model


def predict_job(spark: SparkSession, L: Layers, model: ml.Forecaster | str, frequency: str, variant: str) -> str:
    """Score the inference dataset with a forecaster, or with the one that ``train_job`` saved under the given root."""
    if isinstance(model, str):
        model = ml.Forecaster.load(f"{model}/{ml.artifact_name(frequency, variant)}")
    source = f"{frequency}_inference_dataset" + (f"_{variant}" if variant else "")
    out = f"consumption_{frequency}_predictions" + (f"_{variant}" if variant else "")
    write_table(model.predict(spark.table(_t(L.gold, source))), _t(L.results, out))
    return out


def evaluate_job(spark: SparkSession, L: Layers, prediction_tables: dict[str, str]) -> DataFrame:
    """One joined, grouped job over all prediction tables (``{model: table}``)."""
    preds = [spark.table(_t(L.results, t)).select("timestamp_utc", "group_id", F.lit(m).alias("model"), "target_consumption")
             for m, t in prediction_tables.items()]
    union = preds[0]
    for p in preds[1:]:
        union = union.unionByName(p)
    return evaluate.evaluate(union, spark.table(_t(L.results, "consumption_hourly_actuals")),
                             spark.table(_t(L.results, "consumption_hourly_baseline")))


def hourly_deliverable_job(spark: SparkSession, L: Layers, prediction_table: str) -> None:
    preds = spark.table(_t(L.results, prediction_table)).select("timestamp_utc", "group_id", "target_consumption")
    write_table(deliver.hourly_deliverable(preds), _t(L.deliverables, "consumption_deliverables_hourly"))


def monthly_deliverable_job(spark: SparkSession, L: Layers, w: Windows) -> None:
    hist = spark.table(_t(L.gold, "monthly_training_dataset"))
    preds = spark.table(_t(L.results, "consumption_monthly_predictions"))
    actual, pred, combined = deliver.monthly_deliverables(hist, preds, ts_type=w.ts_type)
    write_table(actual, _t(L.results, "consumption_monthly_actuals"))
    write_table(pred, _t(L.deliverables, "consumption_deliverables_monthly"))
    write_table(combined, _t(L.results, "consumption_monthly_combined"))


def export_job(spark: SparkSession, table: str, path: str, order_by, decimal_comma: bool = False,
               single_file: bool = False) -> None:
    """Dataset / deliverable CSV export (``;`` + decimal comma for deliverables)."""
    export_csv(spark.table(table), path, order_by, sep=";" if decimal_comma else ",", single_file=single_file,
               decimal_comma=decimal_comma)


# Exported datasets -> (layer attribute, sort keys, decimal-comma deliverable).
EXPORTS = {
    "consumption_hourly_actuals": ("results", ("group_id", "timestamp_utc"), False),
    "hourly_inference_dataset_weather_null": ("gold", ("group_id", "timestamp_utc"), False),
    "hourly_inference_dataset_with_weather": ("gold", ("group_id", "timestamp_utc"), False),
    "hourly_training_dataset_with_weather": ("gold", ("group_id", "timestamp_utc"), False),
    "hourly_inference_dataset_without_weather": ("gold", ("group_id", "timestamp_utc"), False),
    "hourly_training_dataset_without_weather": ("gold", ("group_id", "timestamp_utc"), False),
    "consumption_monthly_combined": ("results", ("measured_at",), False),
    "monthly_inference_dataset": ("gold", ("group_id", "timestamp_utc"), False),
    "monthly_training_dataset": ("gold", ("group_id", "timestamp_utc"), False),
    "consumption_deliverables_hourly": ("deliverables", ("measured_at",), True),
    "consumption_deliverables_monthly": ("deliverables", ("measured_at",), True),
}


def export_all(spark: SparkSession, L: Layers, root: str, names=tuple(EXPORTS), single_file: bool = False) -> list[str]:
    """Every dataset/deliverable as an ordered CSV folder under ``root/<name>_csv``. Multi-file
    (range-partitioned, files in order) unless ``single_file``."""
    written = []
    for name in names:
        layer, order, comma = EXPORTS[name]
        table = _t(getattr(L, layer), name)
        export_job(spark, table, f"{root}/{name}_csv", list(order), decimal_comma=comma, single_file=single_file)
        written.append(name)
    return written


def null_exogenous_inference(spark: SparkSession, L: Layers) -> DataFrame:
    """The weather-null inference set built directly: bridge kept, weather columns NULL."""
    src = spark.table(_t(L.gold, "hourly_inference_dataset_with_weather"))
    return splits.null_exogenous(src, {"temperature_missing_flag": "int", "temp_lag_24": "double",
                                       "temp_lag_48": "double", "temp_lag_168": "double"})
