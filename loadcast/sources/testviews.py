"""Adapters from the driver's test tables to the input shapes of the modelled jobs.

``events`` (2024-01-01 .. 2024-01-30, hourly buckets) stands in for the hourly sources
(consumption, price, weather), ``customer``/``nation``/``region`` for group metadata,
``orders`` for monthly history, ``lineitem`` for a large daily per-supplier series.
Every view is derived from whole tables; timestamps stay ``timestamp_ntz`` like the files.
Every stand-in source takes all events (consumption, price, inference weather feed, landed station
tables); group ids map users to 12 groups by ``user_id % 12`` without dropping any row. Nothing is
sampled or capped.
The same shapes are defined in SQL for the DuckDB oracle (``loadcast.oracle``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions import trunc_ts
from loadcast.operators.joins import estimated_bytes
from loadcast.operators.reshape import to_long, to_wide
from loadcast.operators.spine import spine_between

TS = "timestamp_ntz"
N_GROUPS = 12
TASK_BYTES = 2 * 1024 * 1024  # of a large table's wanted columns, by its size estimate, for one task
GROUP_IDS = list(range(N_GROUPS))

# Fixed test parameters: windows inside the events span (the jobs take them as arguments).
INFER_START, INFER_END = "2024-01-29 00:00:00", "2024-01-31 00:00:00"
BASE_START, BASE_END = "2024-01-22 00:00:00", "2024-01-24 00:00:00"
VALID_CUTOFF = "2024-01-25 00:00:00"
FUTURE_END = "2024-02-07 00:00:00"
WX_MIN, WX_MAX = "2024-01-01 00:00:00", "2024-01-30 23:00:00"
MONTHLY_CUTOFF = "2000-01-01 00:00:00"

# Fixed test fixture values: calendar descriptions of special days.
SPECIAL_DAYS = {"2024-01-01": "New Year's Day", "2024-01-06": "Epiphany", "2024-01-17": None}
# Fixed test fixture values: city spellings of the inference weather feed (by user_id % 5).
CITIES = ["helsinki", "Jyväskylä", " HÄMEENLINNA ", "tampere", "Åbo"]
# Fixed test fixture values: landing tables (name, station) of the training weather (by user_id % 5).
LANDING_TABLES = [
    ("helsinki_kaisaniemi", "Helsinki Kaisaniemi"),
    ("TAMPERE_HARMALA", "Tampere Härmälä"),
    ("Turku_Artukainen", "Turku Artukainen"),
    ("oulu_lentoasema", "Oulu lentoasema"),
    ("muu_asema", "Muu asema"),
]
# Fixed test fixture values: product types and consumption buckets of group labels.
PRODUCTS = ["Heat pump", "Direct electric", "District heat", "Solar", "Basic"]
BUCKETS = ["Low", "Medium", "High"]
# Fixed test fixture values: group -> weather key bridge (by group_id % 5); VAA has no weather rows.
BRIDGE_KEYS = ["HEL", "TAM", "TUR", "OUL", "VAA"]


_READS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table (one resolved scan per application and path: plans are immutable, so
    the same read is shared by every view instead of re-resolving the file each time)."""
    key = (spark.sparkContext.applicationId, id(spark), f"{sf_dir}/{name}.parquet")
    if key not in _READS:
        _READS[key] = spark.read.parquet(key[2])
    return _READS[key]


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        trunc_ts("hour", "ts", TS).alias("h"), "user_id", "event_type", "event_id",
        F.col("value").cast("decimal(12,2)").alias("v"),
    )


def _pick(values: list, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _fmt(c: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> F.Column:
    return F.date_format(F.col(c), pattern)


def consumption_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``measured_at`` text + one double column per group ('0'..'11'); every hour of the span
    is a row, a group without events in an hour is a NULL cell."""
    eh = event_hours(spark, sf_dir)
    cells = eh.groupBy("h", (F.col("user_id") % N_GROUPS).cast("int").alias("g")).agg(F.sum("v").cast("double").alias("v"))
    wide = to_wide(cells, "h", "g", "v", GROUP_IDS)
    hours = spine_between(eh.agg(F.min("h").alias("lo"), F.max("h").alias("hi")), "lo", "hi", name="h", ts_type=TS)
    return hours.join(wide, "h", "left").select(_fmt("h").alias("measured_at"), *[F.col(f"`{g}`") for g in GROUP_IDS])


def consumption_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(consumption_wide(spark, sf_dir), ts_type=TS)


def price_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of all events as decimal-comma text (hours without events have no row)."""
    eh = event_hours(spark, sf_dir)
    p = eh.groupBy("h").agg(F.sum("v").alias("s"))
    return p.select(_fmt("h").alias("measured_at"), F.regexp_replace(F.col("s").cast("string"), r"\.", ",").alias("eur_per_mwh"))


def calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day of the events span: ``timestamp`` (date text), ``desc``, ``working_day``."""
    d = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    day = F.date_format("d", "yyyy-MM-dd")
    desc = F.when(F.dayofweek("d").isin(1, 7), F.lit("weekend")).otherwise(F.lit("working day"))
    for date, name in SPECIAL_DAYS.items():
        desc = F.when(day == date, F.lit(name).cast("string")).otherwise(desc)
    return d.select(day.alias("timestamp"), desc.alias("desc")).withColumn("working_day", F.col("desc") == "working day")


def _temperature_text(value, first_event) -> F.Column:
    return (
        F.when(first_event % 17 == 0, F.lit("-"))
        .when(first_event % 23 == 0, F.lit("NaN"))
        .otherwise(value.cast("string"))
    )


def weather_inference_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped rows: ISO ``timestamp`` with Z, ``city`` as spelled by the feed, text values."""
    eh = event_hours(spark, sf_dir).withColumn("city", _pick(CITIES, F.col("user_id")))
    agg = eh.groupBy("h", "city").agg(F.max("v").alias("t"), F.min("event_id").alias("e"))
    return agg.select(
        _fmt("h", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "city",
        _temperature_text(F.col("t"), F.col("e")).alias("TA_PT1H_AVG"),
        F.lit("1.0").alias("WS_PT1H_AVG"), F.lit("0.0").alias("PRA_PT1H_ACC"),
    )


def weather_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landing tables in one frame (``source_table`` = table name), station-file columns."""
    eh = event_hours(spark, sf_dir)
    names = [t for t, _ in LANDING_TABLES]
    stations = [s for _, s in LANDING_TABLES]
    eh = eh.withColumns({"source_table": _pick(names, F.col("user_id")), "station": _pick(stations, F.col("user_id"))})
    agg = eh.groupBy("h", "source_table", "station").agg(F.max("v").alias("t"), F.min("event_id").alias("e"))
    return agg.select(
        "source_table",
        F.col("station").alias("Havaintoasema"),
        F.year("h").alias("Vuosi"), F.month("h").alias("Kuukausi"), F.dayofmonth("h").alias("Päivä"),
        F.concat(F.hour("h").cast("string"), F.lit(":00")).alias("Aika [UTC]"),
        _temperature_text(F.col("t"), F.col("e")).alias("Lämpötilan keskiarvo [°C]"),
        F.lit("0.0").alias("Tunnin sademäärä [mm]"),
        F.lit("1.0").alias("Keskituulen nopeus [m/s]"),
    )


def groups_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``group_id`` = customer key, six-part label region | nation | name | segment | product | bucket
    (every 50th customer from 7 on has only four parts)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    k = F.col("c_custkey")
    four = [F.col("r_name"), F.col("n_name"), F.col("c_name"), F.col("c_mktsegment")]
    label = F.when(k % 50 == 7, F.concat_ws(" | ", *four)).otherwise(
        F.concat_ws(" | ", *four, _pick(PRODUCTS, k), _pick(BUCKETS, k))
    )
    return j.select(k.cast("int").alias("group_id"), label.alias("group_label"))


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("group_id"), _pick(BRIDGE_KEYS, F.col("c_custkey")).alias("weather_key"))


def orders_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly-history stand-in: (timestamp_utc, group_id, target_consumption decimal)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("timestamp_utc"),
        (F.col("o_custkey") % N_GROUPS).cast("int").alias("group_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("target_consumption"),
    )


def supplier_daily(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Large keyed series: daily shipped quantity per supplier (days without shipments absent), ``dealt`` by supplier.

    Nearly every line is a group of its own, so lines are dealt before they are summed, to tasks whose number follows the
    table's size: a task's memory is the same at any size."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier_id"), F.col("l_shipdate").alias("day"), "l_quantity")
    tasks = max(spark.sparkContext.defaultParallelism, -(-estimated_bytes(li) // TASK_BYTES))
    daily = li.repartition(tasks, "supplier_id", "day").groupBy("supplier_id", "day").agg(
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("quantity")
    )
    return daily.repartition(tasks, "supplier_id") if dealt else daily
