"""Exact positional operators that never put one key (or an un-keyed series) in one task.

``row_index`` numbers rows within each key by ``order`` in two small steps:
row_number inside (key, bucket) and a running offset over the per-(key, bucket) counts.
The count table has one row per (key, bucket) - its size is bounded by the time span over
the bucket width, not by the data - and is joined back on (key, bucket).

``blocked`` then cuts every key into blocks of ``block_rows`` consecutive positions, copies
the last ``lookback`` rows of each block into the next block as history (halo), and runs the
ordinary window operators per (key, block). A hot key becomes many bounded tasks; the
halo costs ``lookback / block_rows`` extra rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DateType, TimestampNTZType, TimestampType

IDX = "_idx"
BLOCK = "_blk"
HALO = "_halo"
SKIPPED = "_skipped"


def _null_free_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add, per key, a non-NULL value column and an is-NULL flag. Windows, counts and joins
    on these plain columns treat NULL keys as one key *and* share one hash partitioning, so
    the join back to the numbered rows does not re-shuffle them (``<=>`` join keys would)."""
    cols, names = {}, []
    for i, k in enumerate(keys):
        dtype = df.schema[k].dataType
        if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
            default = F.lit("1970-01-01 00:00:00").cast(dtype)
        elif isinstance(dtype, AtomicType):
            default = F.lit(0).cast(dtype)
        else:  # complex key types: used as they are (NULL keys then stay unmatched in the offsets join)
            default = None
        cols[f"_kv{i}"] = F.coalesce(F.col(k), default) if default is not None else F.col(k)
        cols[f"_kn{i}"] = F.col(k).isNull()
        names += [f"_kv{i}", f"_kn{i}"]
    return df.withColumns(cols), names


def row_index(
    df: DataFrame, order: str, keys: Sequence[str] = (), bucket: Column | None = None, name: str = IDX,
    with_count: bool = False,
) -> DataFrame:
    """Add the 1-based position of each row within its key. Rows equal in ``order`` follow a hash of the whole row
    (of the columns that can be hashed), so a task that is computed again numbers them alike.

    ``bucket`` defaults to the day of ``order``. ``with_count`` also adds ``_cnt`` = rows of the key."""
    # rows without an order value come first, as in an ascending sort: they get a bucket before all days
    b = bucket if bucket is not None else F.coalesce(
        F.date_trunc("day", F.col(order)), F.lit("0001-01-01 00:00:00").cast("timestamp"))
    keyed, ks = _null_free_keys(df.withColumn("_bkt", b), keys)
    hashed = [F.col(f"`{c.name}`") for c in df.schema if "map<" not in c.dataType.simpleString()
              and "variant" not in c.dataType.simpleString()]
    local = keyed.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*ks, "_bkt").orderBy(order, F.xxhash64(*hashed))))
    counts = keyed.groupBy(*ks, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*ks).orderBy("_bkt")
    offsets = counts.select(
        *ks, "_bkt",
        F.coalesce(F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *([F.sum("_n").over(Window.partitionBy(*ks)).alias("_cnt")] if with_count else []),
    )
    joined = local.join(offsets, [*ks, "_bkt"])
    extra = ["_cnt"] if with_count else []
    return joined.select(*df.columns, (F.col("_off") + F.col("_rn")).alias(name), *extra)


def blocked(
    indexed: DataFrame, keys: Sequence[str], lookback: int, block_rows: int,
    apply: Callable[[DataFrame, list[str], str], DataFrame], idx: str = IDX,
) -> DataFrame:
    """Run ``apply(df, keys + [block], idx)`` per block of ``block_rows`` positions with
    ``lookback`` rows of history, and keep only the block's own rows.

    ``apply`` must only use windows that look back at most ``lookback`` rows (lags, trailing
    frames) - filters on absolute position use ``idx`` directly."""
    if block_rows < lookback:
        raise ValueError("block_rows must be >= lookback")
    pos = F.col(idx) - 1
    own = F.floor(pos / block_rows)
    in_tail = (pos % block_rows) >= (block_rows - lookback)
    copies = F.when(in_tail & F.lit(lookback > 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    expanded = indexed.select("*", F.explode(copies).alias("_copy")).select(
        *indexed.columns, (own + F.col("_copy")).cast("bigint").alias(BLOCK), (F.col("_copy") == 1).alias(HALO)
    )
    out = apply(expanded, [*keys, BLOCK], idx)
    return out.filter(~F.col(HALO)).drop(BLOCK, HALO)


def day_counts(df: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (key, day): ``keys, day, n``. Stored beside a series, it is the zone map of ``prune_history``: one row per
    key and day, pre-aggregated map-side, and additive (counts of new rows can be appended). Rows without a time have no day."""
    return df.groupBy(*keys, F.to_date(F.col(order)).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def prune_history(
    df: DataFrame, counts: DataFrame, order: str, keys: Sequence[str], since: Column, lookback: int, day_column: str | None = None,
) -> DataFrame:
    """ACTION (one value): the rows from ``since`` on and, per key, whole days before it that hold the last ``lookback`` rows or
    more; ``_skipped`` = rows of the key before those days. Exact on series with gaps; NULL keys are a key, and rows
    without a time come first, as in ``row_index``."""
    cut = F.to_date(since)
    days = counts.groupBy(*keys, "day").agg(F.sum("n").alias("n")).withColumn("day", F.coalesce("day", F.lit("0001-01-01").cast("date")))
    older = days.filter(F.col("day") < cut)
    later = Window.partitionBy(*keys).orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = older.withColumn("upto", F.sum("n").over(later))
    enough = F.col("upto") >= lookback
    bounds = sums.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(enough, F.col("day"))), F.min("day")).alias("_first"),
        (F.sum("n") - F.coalesce(F.min(F.when(enough, F.col("upto"))), F.max("upto"))).alias(SKIPPED))
    low = bounds.agg(F.least(F.min("_first"), F.min(cut)).alias("d")).first()["d"]
    day = F.coalesce(F.to_date(F.col(order)), F.lit("0001-01-01").cast("date"))
    near = df if low is None or low.year == 1 else df.filter(F.col(order) >= F.lit(low).cast(df.schema[order].dataType))
    if low is None:  # nothing is older than ``since``
        near = df.filter(day >= cut)
    elif low.year > 1 and day_column is not None:
        near = near.filter(F.col(day_column) >= F.lit(low))
    if keys:
        renamed = bounds.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], "_first", SKIPPED)
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_b{i}"))
        joined = near.join(renamed, same, "left")
    else:
        one = bounds.first()  # a series without keys has one bound
        joined = near.withColumns({"_first": F.lit(one["_first"]), SKIPPED: F.lit(one[SKIPPED])}) if one else \
            near.withColumns({"_first": F.lit(None).cast("date"), SKIPPED: F.lit(0)})
    return joined.filter(day >= F.coalesce("_first", cut)).withColumn(SKIPPED, F.coalesce(SKIPPED, F.lit(0))) \
        .select(*df.columns, SKIPPED)


def positional_lags(
    df: DataFrame, value: str, lags: Sequence[int], order: str, keys: Sequence[str] = (),
    names: Sequence[str] | None = None, bucket: Column | None = None, block_rows: int = 4096,
) -> DataFrame:
    """Positional ``lag(value, k)`` per key (or over the whole series when ``keys`` is empty)
    without a single-partition window."""
    from loadcast.operators.windows import lag_columns

    names = list(names) if names is not None else [f"{value}_lag_{k}" for k in lags]
    indexed = row_index(df, order, keys, bucket)

    def apply(d: DataFrame, ks: list[str], o: str) -> DataFrame:
        return d.withColumns(lag_columns(value, lags, o, ks, names=names))

    out = blocked(indexed, keys, max(lags), max(block_rows, max(lags)), apply)
    return out.drop(IDX)


def drop_head_positional(
    df: DataFrame, n: int, order: str, keys: Sequence[str] = (), bucket: Column | None = None
) -> DataFrame:
    """Remove the first ``n`` rows per key (whole series when ``keys`` is empty), distributed."""
    return row_index(df, order, keys, bucket).filter(F.col(IDX) > n).drop(IDX)


def drop_tail_positional(
    df: DataFrame, n: int, order: str, keys: Sequence[str] = (), bucket: Column | None = None
) -> DataFrame:
    """Remove the latest ``n`` rows per key, distributed."""
    indexed = row_index(df, order, keys, bucket, with_count=True)
    return indexed.filter(F.col(IDX) <= F.col("_cnt") - n).drop(IDX, "_cnt")


def forward_fill_split(
    df: DataFrame, value: str, order: str, keys: Sequence[str] = (), out: str | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Exact forward fill (last non-NULL up to and including the row, timestamp peers included)
    without one task per key: fill inside each (key, day), then carry in the last non-NULL
    value of the earlier days from a per-(key, day) summary table (one row per key and day)."""
    out = out or value
    b = bucket if bucket is not None else F.date_trunc("day", F.col(order))
    keyed, ks = _null_free_keys(df.withColumn("_bkt", b), keys)
    local_w = Window.partitionBy(*ks, "_bkt").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = keyed.withColumn("_local", F.last(value, ignorenulls=True).over(local_w))
    last_in_bucket = keyed.groupBy(*ks, "_bkt").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_last")
    )
    earlier = Window.partitionBy(*ks).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_bucket.select(*ks, "_bkt", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    joined = local.join(carry, [*ks, "_bkt"], "left")
    cols = [c for c in df.columns if c != out]
    return joined.select(*cols, F.coalesce(F.col("_local"), F.col("_carry")).alias(out))
