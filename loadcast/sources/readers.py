"""Table and file readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadcast.functions import key_from_prefix


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a path in ``fmt`` (the scan prunes columns and pushes filters)."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
             header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a declared schema (no inference pass). A UTF-8 BOM and CRLF line ends are
    handled by the reader; ``mode='FAILFAST'`` fails the job on a malformed record."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_landing_dir(spark: SparkSession, path: str, schema: StructType | str, prefixes: Sequence[str],
                     sep: str = ",", fmt: str = "csv") -> DataFrame:
    """One scan over a directory of per-station files (instead of one scan per table + unions).
    ``source_name`` is the file name; ``weather_key`` its case-insensitive prefix (NULL if none)."""
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", sep)
    df = reader.load(path)
    name = F.col("_metadata.file_name")
    return df.withColumns({"source_name": name, "weather_key": key_from_prefix(name, prefixes)})


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables in a database (catalog metadata, no data read)."""
    return [t.name for t in spark.catalog.listTables(database)]


def match_prefixes(names: Sequence[str], prefixes: Sequence[str]) -> dict[str, list[str]]:
    """``{prefix: [names starting with it, case-insensitively]}`` for every prefix."""
    return {p: [n for n in names if n.upper().startswith(p.upper())] for p in prefixes}


def load_prefixed_tables(spark: SparkSession, database: str, prefixes: Sequence[str], key: str = "weather_key",
                         name_col: str = "source_table") -> tuple[DataFrame, list[str]]:
    """Catalog form of the landing read: every table whose name starts with a prefix, unioned
    by name with ``key`` = the prefix and ``name_col`` = the table. Returns the frame and the
    prefixes without a table; raises when no table matched. (Files: ``read_landing_dir``.)"""
    matched = match_prefixes(list_tables(spark, database), prefixes)
    frames = [
        spark.table(f"{database}.{t}").withColumns({key: F.lit(p), name_col: F.lit(t)})
        for p in prefixes for t in matched[p]
    ]
    if not frames:
        raise ValueError(f"{database} has no table for any of {', '.join(prefixes)}")
    missing = [p for p in prefixes if not matched[p]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), missing


def read_weather_xml_dir(spark: SparkSession, path: str) -> DataFrame:
    """One scan over landed WaterML files (one per city, ``<city>.xml``): rows = time series,
    ``city`` from the file name. Feed to ``payloads.weather_xml_rows`` via ``xml`` = raw text, or
    use the parsed struct directly."""
    from loadcast.sources.payloads import TIMESERIES_XML_SCHEMA

    df = (spark.read.format("xml").option("rowTag", "wml2:MeasurementTimeseries").option("mode", "FAILFAST")
          .schema(TIMESERIES_XML_SCHEMA).load(path))
    city = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    return df.select(city.alias("city"), F.struct(*[F.col(f"`{f}`") for f in TIMESERIES_XML_SCHEMA.fieldNames()]).alias("ts"))
