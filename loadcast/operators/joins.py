"""Joins against dimensions and global series with a *checked* broadcast bound.

Catalyst broadcasts a side whose estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans on measured sizes. ``bounded`` adds a hint where the optimized plan's size estimate (file and table statistics, no job)
is small: estimates of filters, projections, windows and aggregates are at most those of their input, joins count as
the product, and a generator (``explode``) as ``PER_ROW`` rows for one; an unknown size is never small. So small tables need no job. A side
that is still to be computed may be small all the same: ``bounded_all`` persists such sides (memory, spilling to disk; lost blocks are
computed again), measures their rows and bytes in one job and hints those within ``max_rows`` and ``max_bytes``; the join reads the
blocks that the measuring made, so every side runs once. Files are compressed, so a table's estimate is trusted up to ``max_bytes /
PACKED`` only. Anything larger stays a shuffle join that AQE may still turn round."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

MAX_BYTES = 64 * 1024 * 1024
MAX_ROWS = 2_000_000
PER_ROW = 512  # rows a generator is taken to make of one
PACKED = 16  # times that a file's rows may be larger than the file


def estimated_bytes(df: DataFrame) -> int:
    """Size of the result by the optimized plan's statistics; starts no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    generators = plan.toString().count("Generate ")
    return int(str(plan.stats().sizeInBytes())) * PER_ROW ** generators


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as joins and broadcasts hold it: a word per column, and the text of strings and other columns of variable length."""
    size = F.lit(8 * (1 + len(df.columns)))
    for c in df.schema:
        if not isinstance(c.dataType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
            at = F.col(f"`{c.name}`")
            text = at if isinstance(c.dataType, (StringType, BinaryType)) else at.cast("string")
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size.cast("bigint")


def bounded(df: DataFrame, max_bytes: int = MAX_BYTES, max_rows: int = MAX_ROWS) -> DataFrame:
    """``bounded_all`` for one side."""
    return bounded_all({"side": df}, max_bytes, max_rows)["side"]


def bounded_all(frames: dict[str, DataFrame], max_bytes: int = MAX_BYTES, max_rows: int = MAX_ROWS) -> dict[str, DataFrame]:
    """``broadcast(df)`` for every side that is checked to be small, else the side as it is (persisted, where it was measured). ACTION only
    for sides whose estimate is above ``max_bytes / PACKED``: one job measures them all (partial-aggregated, one row per task)."""
    out = {name: F.broadcast(df) if estimated_bytes(df) <= max_bytes // PACKED else None for name, df in frames.items()}
    unknown = [name for name, df in out.items() if df is None]
    if unknown:
        held = {name: frames[name].persist(StorageLevel.MEMORY_AND_DISK) for name in unknown}
        probe = None
        for i, name in enumerate(unknown):
            part = held[name].select(F.lit(i).alias("side"), row_bytes(held[name]).alias("bytes"))
            probe = part if probe is None else probe.unionAll(part)
        found = {r["side"]: r for r in probe.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()}
        for i, name in enumerate(unknown):
            small = i not in found or found[i]["n"] <= max_rows and found[i]["bytes"] <= max_bytes
            out[name] = F.broadcast(held[name]) if small else held[name]
    return out


def left_join_sparse(left: DataFrame, right: DataFrame, on: list[str], salts: int = 1, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Left join for a left side with many rows that can not match (a NULL in ``on``) or share one key.

    With a small right side it is broadcast. Else rows with a NULL key pass by the shuffle (a union after the join), and with
    ``salts`` above 1 every key of the left side is dealt to that many tasks, to which the right rows are copied; so neither the NULL
    rows nor one hot key meet in one task. The result is that of ``left.join(right, on, "left")``."""
    hinted = right._jdf.queryExecution().analyzed().toString().startswith("ResolvedHint")
    if hinted or estimated_bytes(right) <= max_bytes // PACKED:
        return left.join(right if hinted else F.broadcast(right), on, "left")
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    more = [c for c in right.columns if c not in on]
    columns = [*on, *[c for c in left.columns if c not in on], *more]
    can, cannot = left.filter(~null_key), left.filter(null_key)
    if salts > 1:
        salt = "_salt" + "_" * max((len(c) for c in [*left.columns, *right.columns]), default=0)
        can = can.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int"))
        copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        matched = can.join(copies, [*on, salt], "left").drop(salt)
    else:
        matched = can.join(right, on, "left")
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in more]
    return matched.select(*columns).unionByName(cannot.select(*columns[:len(columns) - len(more)], *nothing))
