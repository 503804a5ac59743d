"""Landed API payloads parsed by Spark: calendar JSON (date -> attributes) and weather XML
(WaterML 2 time-value pairs). Each payload is one row of a text column; rows parse in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

CALENDAR_PAYLOAD_SCHEMA = "map<string, struct<desc: string, working_day: boolean>>"

# The weather parameters requested per city.
WEATHER_PARAMETERS = ("TA_PT1H_AVG", "WS_PT1H_AVG", "PRA_PT1H_ACC")

# WaterML element names (namespace prefixes are part of the tag names).
TIMESERIES_XML_SCHEMA = StructType([
    StructField("_gml:id", StringType()),
    StructField("wml2:point", ArrayType(StructType([
        StructField("wml2:MeasurementTVP", StructType([
            StructField("wml2:time", StringType()),
            StructField("wml2:value", StringType()),
        ])),
    ]))),
])


def calendar_payload_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``{"2024-01-01": {"desc": ..., "working_day": ...}, ...}`` -> rows ``timestamp, desc, working_day``."""
    entries = F.explode(F.from_json(F.col(payload), CALENDAR_PAYLOAD_SCHEMA))
    return df.select(entries.alias("timestamp", "v")).select("timestamp", "v.desc", "v.working_day")


def weather_xml_rows(df: DataFrame, xml: str = "xml", city: str = "city",
                     parameters=WEATHER_PARAMETERS) -> DataFrame:
    """One ``wml2:MeasurementTimeseries`` document per row -> one row per (city, time) with one
    string column per parameter. The parameter is the last ``-`` token of the series ``gml:id``."""
    parsed = df.select(F.col(city).alias("city"), F.from_xml(F.col(xml), TIMESERIES_XML_SCHEMA).alias("ts"))
    return timeseries_rows(parsed, parameters)


def timeseries_rows(parsed: DataFrame, parameters=WEATHER_PARAMETERS) -> DataFrame:
    """``(city, ts struct)`` parsed series -> one row per (city, time), one column per parameter."""
    param = F.element_at(F.split(F.col("ts.`_gml:id`"), "-"), -1)
    points = parsed.select("city", param.alias("param"), F.explode("ts.`wml2:point`").alias("p"))
    tvp = points.select(
        "city", "param",
        F.col("p.`wml2:MeasurementTVP`.`wml2:time`").alias("timestamp"),
        F.col("p.`wml2:MeasurementTVP`.`wml2:value`").alias("value"),
    )
    return tvp.groupBy("timestamp", "city").pivot("param", list(parameters)).agg(F.max("value"))


def timeseries_xml(param_id: Column, times: Column, values: Column) -> Column:
    """Render one ``wml2:MeasurementTimeseries`` document from arrays of times and values
    (used to land payloads as text; the inverse of ``weather_xml_rows``)."""
    tvp = F.transform(
        F.arrays_zip(times.alias("t"), values.alias("v")),
        lambda e: F.concat(
            F.lit("<wml2:point><wml2:MeasurementTVP><wml2:time>"), e["t"],
            F.lit("</wml2:time><wml2:value>"), e["v"], F.lit("</wml2:value></wml2:MeasurementTVP></wml2:point>"),
        ),
    )
    return F.concat(
        F.lit('<wml2:MeasurementTimeseries gml:id="'), param_id, F.lit('">'),
        F.array_join(tvp, ""), F.lit("</wml2:MeasurementTimeseries>"),
    )
