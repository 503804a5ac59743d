"""Table and CSV writers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from loadcast.plans.deliver import decimal_comma_projection


KEPT_VERSIONS = 2  # of a published table, the current one included


def _root(spark: SparkSession, name: str) -> str:
    """Folder of a table's versions: below its database's location."""
    parts = [p.strip("`") for p in name.split(".")]
    db = parts[0] if len(parts) > 1 else spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_versions/{parts[-1]}"


def versions(spark: SparkSession, name: str) -> list[str]:
    """Folders of the complete versions of a published table, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark, name))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(s.getPath()) for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS"))]
    return sorted(done, key=lambda p: p.rsplit("/", 1)[1])


def publish(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
            check: Callable[[DataFrame], bool] | None = None, keep: int = KEPT_VERSIONS) -> str:
    """Replace a table's rows in one catalog step; returns the new version's folder.

    The rows go to a folder of their own; when the job has ended and ``check`` (if given) accepts what was
    written, the view ``name`` is pointed at it. Until then, and whatever fails or is killed, readers see the old rows; readers with
    an open plan finish on the old folder, which stays until ``keep`` newer ones are there. A folder that a killed job
    left has no ``_SUCCESS`` mark and is never a version. A plain table of that name (from before) is dropped right before the
    first view is made. Two writers of one table are not ordered: the last one to finish wins."""
    spark = df.sparkSession
    path = f"{_root(spark, name)}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    if check is not None and not check(spark.read.format(fmt).load(path)):
        raise ValueError(f"{name}: the new version did not pass its check and was not published ({path})")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{c}`" for c in df.columns)  # partition columns keep their place
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {fmt}.`{path}`")
    for old in versions(spark, name)[:-max(1, keep)]:
        if not old.endswith(path.rsplit("/", 1)[1]):
            at = spark._jvm.org.apache.hadoop.fs.Path(old)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return path


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, path: str | None = None) -> None:
    """Overwrite (by default) a table, atomically by ``publish``; ``partition_by`` enables partition pruning for later
    time/split filters. Another ``mode``, or a ``path`` (an external table at a shared location), writes a plain table by the
    DataFrame writer, whose overwrite drops the old table first."""
    if mode == "overwrite" and not path:
        publish(df, name, fmt, partition_by)
        return
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str], sep: str = ",", single_file: bool = False,
               decimal_comma: bool = False, scale: int | None = None, partitions: int | None = None) -> None:
    """Ordered CSV with a header. Default: a globally sorted multi-file export (range
    partitioned, files in order). ``single_file=True`` funnels the sorted rows through one
    task - only for deliverables known to be small."""
    out = decimal_comma_projection(df, scale) if decimal_comma else df
    if partitions:
        out = out.repartitionByRange(partitions, *order_by)
    out = out.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
