"""Readers, payload parsers and writers on small files in a temporary folder."""

import datetime as dt
import glob

import pytest
import json
import math

from pyspark.sql import functions as F

from loadcast.plans import ml, weather
from loadcast.sources import payloads, readers, writers

T0 = dt.datetime(2024, 1, 1)


def test_semicolon_csv_with_bom_and_crlf(spark, tmp_path):
    p = tmp_path / "groups.csv"
    p.write_bytes("﻿group_id;group_label\r\n28;South | A | X | Private | Heat | Low\r\n29;North | B\r\n".encode())
    df = readers.read_csv(spark, str(p), "group_id int, group_label string", sep=";")
    assert df.columns == ["group_id", "group_label"]
    assert [tuple(r) for r in df.orderBy("group_id").collect()] == [(28, "South | A | X | Private | Heat | Low"), (29, "North | B")]


def test_landing_directory_one_scan_with_keys_from_file_names(spark, tmp_path):
    header = ",".join([weather.STATION, weather.YEAR, weather.MONTH, weather.DAY, weather.TIME_UTC, weather.TEMPERATURE,
                       weather.PRECIPITATION, weather.WIND])
    for name, temp in [("Helsinki_kaisaniemi.csv", "1.5"), ("tampere.csv", "-"), ("unknown.csv", "2.0")]:
        (tmp_path / name).write_text(f"{header}\nst,2024,1,5,7:00,{temp},0.0,1.0\n", encoding="utf-8")
    schema = (f"`{weather.STATION}` string, `{weather.YEAR}` int, `{weather.MONTH}` int, `{weather.DAY}` int, "
              f"`{weather.TIME_UTC}` string, `{weather.TEMPERATURE}` string, `{weather.PRECIPITATION}` string, `{weather.WIND}` string")
    landing = readers.read_landing_dir(spark, str(tmp_path), schema, weather.WEATHER_KEYS)
    long = weather.build_weather_long(landing, "source_name")
    assert {(r["weather_key"], r["temperature"]) for r in long.collect()} == {("HEL", 1.5), ("TAM", None)}
    with pytest.warns(UserWarning, match="POR"):
        missing = weather.check_prefix_coverage(long)
    assert "HEL" not in missing and "POR" in missing
    obs = weather.prepare_weather_training(long, "timestamp_ntz")
    assert {r["timestamp_utc"] for r in obs.collect()} == {dt.datetime(2024, 1, 5, 7)}


def test_calendar_json_payload(spark):
    payload = json.dumps({"2024-01-01": {"desc": "New Year", "working_day": False},
                          "2024-01-02": {"desc": "working day", "working_day": True}})
    rows = payloads.calendar_payload_rows(spark.createDataFrame([(payload,)], "payload string")).collect()
    assert sorted(tuple(r) for r in rows) == [("2024-01-01", "New Year", False), ("2024-01-02", "working day", True)]


def test_weather_xml_payload(spark):
    def series(param, values):
        pts = "".join(f"<wml2:point><wml2:MeasurementTVP><wml2:time>{t}</wml2:time><wml2:value>{v}</wml2:value>"
                      "</wml2:MeasurementTVP></wml2:point>" for t, v in values)
        return f'<wml2:MeasurementTimeseries gml:id="obs-obs-1-1-{param}">{pts}</wml2:MeasurementTimeseries>'
    docs = [("helsinki", series("TA_PT1H_AVG", [("2024-01-01T00:00:00Z", "1.5"), ("2024-01-01T01:00:00Z", "NaN")])),
            ("helsinki", series("WS_PT1H_AVG", [("2024-01-01T00:00:00Z", "3.0")]))]
    out = payloads.weather_xml_rows(spark.createDataFrame(docs, "city string, xml string")).orderBy("timestamp").collect()
    assert [tuple(r) for r in out] == [("2024-01-01T00:00:00Z", "helsinki", "1.5", "3.0", None),
                                       ("2024-01-01T01:00:00Z", "helsinki", "NaN", None, None)]


def test_export_csv_sorted_single_file_decimal_comma(spark, tmp_path):
    df = spark.createDataFrame([(2, 1.25), (1, 3.5)], "id int, v double")
    out = tmp_path / "single"
    writers.export_csv(df, str(out), ["id"], sep=";", single_file=True, decimal_comma=True)
    files = glob.glob(f"{out}/part-*.csv")
    assert len(files) == 1
    assert open(files[0]).read().splitlines() == ["id;v", "1;3,5", "2;1,25"]
    multi = tmp_path / "multi"
    writers.export_csv(spark.range(1000).withColumnRenamed("id", "k"), str(multi), ["k"], partitions=4)
    back = spark.read.option("header", True).csv(str(multi)).select(F.col("k").cast("int"))
    assert back.count() == 1000


def test_write_table_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(T0, "train", 1.0), (T0, "inference", None)], "timestamp_utc timestamp_ntz, split string, v double")
    writers.write_table(df, "loadcast_test_split", partition_by=["split"], path=str(tmp_path / "t"))
    back = spark.table("loadcast_test_split").filter("split = 'train'")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE loadcast_test_split")


def test_forecaster_trains_predicts_and_round_trips(spark, tmp_path):
    rows = [(T0 + dt.timedelta(hours=h), g, f"s{g % 2}", float(h % 24) + g, float((h - 1) % 24) + g if h else None)
            for g in range(3) for h in range(96)]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, group_id int, segment string, "
                                     "target_consumption double, lag1 double")
    model = ml.train_forecaster(df, ["group_id", "segment"], cutoff="2024-01-04 00:00:00", max_iter=3, max_depth=3)
    assert len(model.validation_errors) == 3 and model.validation_mae == min(model.validation_errors)
    # the last round's error is that of predictions from a model of all rounds on the rows before the cutoff
    early = ml.train_forecaster(df.filter("timestamp_utc < '2024-01-04'"), ["group_id", "segment"], max_iter=3, max_depth=3)
    late = df.filter("timestamp_utc >= '2024-01-04'")
    scored = early.predict(late.withColumn("target_consumption", F.lit(None).cast("double"))).alias("p").join(
        late.alias("a"), ["timestamp_utc", "group_id"])
    direct = scored.agg(F.avg(F.abs(F.col("p.target_consumption") - F.col("a.target_consumption")))).first()[0]
    assert math.isclose(direct, model.validation_errors[-1], rel_tol=1e-9)
    pred = model.predict(df.withColumn("target_consumption", F.lit(None).cast("double")))
    vals = [r[0] for r in pred.select("target_consumption").collect()]
    assert len(vals) == 288 and all(v is not None and math.isfinite(v) for v in vals)
    model.save(str(tmp_path / "m"))
    again = ml.Forecaster.load(str(tmp_path / "m"))
    assert (again.categoricals, again.numeric, again.validation_errors) == (model.categoricals, model.numeric, model.validation_errors)
    assert sorted(map(tuple, again.predict(df).collect())) == sorted(map(tuple, model.predict(df).collect()))
    assert ml.artifact_name("hourly", "with_weather") == "hourly_with_weather"


def test_stop_rule_keeps_the_best_round_within_patience():
    assert ml.stop_round([], 2) == 0
    assert ml.stop_round([5.0, 4.0, 4.0, 3.0], 3) == 4
    assert ml.stop_round([5.0, 4.0, 4.5, 4.2, 1.0], 2) == 2   # two rounds without a gain: round 5 is never reached
    assert ml.stop_round([5.0, 4.0, 4.5, 4.2, 1.0], 3) == 5
    assert ml.stop_round([4.0, 4.0], 9) == 1                  # the earlier of ties


def test_ordinal_columns_are_the_callers_choice(spark):
    """40 groups as an ordered code need no 41 bins; as a nominal feature they get them, at any number of labels."""
    rows = [(T0 + dt.timedelta(hours=h), g, float(g % 5 + h % 3)) for g in range(40) for h in range(12)]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, group_id int, target_consumption double")
    coded = ml.train_forecaster(df, ["group_id"], max_iter=2, max_depth=3, ordinal=["group_id"], feature_subset="all")
    assert [s.__class__.__name__ for s in coded.model.stages][:2] == ["SQLTransformer", "VectorAssembler"]
    assert coded.predict(df).filter(F.col("target_consumption").isNull()).count() == 0
    assert coded.model.stages[-1].getOrDefault("maxBins") == 32
    nominal = ml.train_forecaster(df, ["group_id"], max_iter=2, max_depth=3, feature_subset="all")
    assert nominal.model.stages[-1].getOrDefault("maxBins") == 41


def test_weather_xml_directory(spark, tmp_path):
    def doc(param, pts):
        body = "".join(f"<wml2:point><wml2:MeasurementTVP><wml2:time>{t}</wml2:time><wml2:value>{v}</wml2:value>"
                       "</wml2:MeasurementTVP></wml2:point>" for t, v in pts)
        return f'<wml2:MeasurementTimeseries gml:id="obs-obs-1-1-{param}">{body}</wml2:MeasurementTimeseries>'
    for city, temp in (("helsinki", "1.5"), ("oulu", "-3.0")):
        (tmp_path / f"{city}.xml").write_text(
            "<wfs:FeatureCollection>" + doc("TA_PT1H_AVG", [("2024-01-01T00:00:00Z", temp)])
            + doc("WS_PT1H_AVG", [("2024-01-01T00:00:00Z", "2.0")]) + "</wfs:FeatureCollection>")
    parsed = readers.read_weather_xml_dir(spark, str(tmp_path))
    rows = sorted(tuple(r) for r in payloads.timeseries_rows(parsed).collect())
    assert rows == [("2024-01-01T00:00:00Z", "helsinki", "1.5", "2.0", None), ("2024-01-01T00:00:00Z", "oulu", "-3.0", "2.0", None)]


def test_catalog_prefix_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lc_landing LOCATION '{tmp_path / 'landing'}'")
    df = spark.createDataFrame([("st", "1.0")], "station string, temp string")
    for name in ("helsinki_kaisaniemi", "TURKU_artukainen", "misc_station"):
        writers.write_table(df, f"lc_landing.{name}")
    out, missing = readers.load_prefixed_tables(spark, "lc_landing", ["HEL", "TUR", "POR"])
    assert sorted(r["weather_key"] for r in out.collect()) == ["HEL", "TUR"] and missing == ["POR"]
    spark.sql("DROP DATABASE lc_landing CASCADE")
