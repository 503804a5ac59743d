"""Per-key ordered window operators: positional lags, trailing-window moments, forward fill,
head/tail trimming.

All functions share one window spec per (keys, order), so chaining them costs one exchange
by ``keys`` and one sort; Catalyst puts every expression of the spec into one Window node.
Lags are *positional* (the k-th previous row, not the row k hours earlier); on gapped
data call ``operators.spine.densify`` first when temporal lags are wanted.

When one key may hold a large share of all rows, run the same functions through
``operators.index.blocked`` which splits every key into fixed-size row blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType


def spec(keys: Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    order_cols = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order_cols)


def lag_columns(
    value: str, lags: Sequence[int], order, keys: Sequence[str] = (), prefix: str | None = None,
    names: Sequence[str] | None = None,
) -> dict[str, Column]:
    """``{name: lag(value, k)}`` for each k; names default to ``{prefix or value}_lag_{k}``."""
    w = spec(keys, order)
    names = list(names) if names is not None else [f"{prefix or value}_lag_{k}" for k in lags]
    return {n: F.lag(value, k).over(w) for n, k in zip(names, lags)}


def lag_features(
    df: DataFrame, value: str, lags: Sequence[int], order: str = "timestamp_utc",
    keys: Sequence[str] = (), prefix: str | None = None, names: Sequence[str] | None = None,
) -> DataFrame:
    return df.withColumns(lag_columns(value, lags, order, keys, prefix, names))


def _scaled(value: str, scale: int, wide: bool) -> Column:
    if wide:  # to decimal before scaling: no bigint in between
        unit = F.lit(10**scale).cast(f"decimal({scale + 1},0)")
        return (F.col(value).cast(f"decimal(38,{scale})") * unit).cast("decimal(38,0)")
    return F.round(F.col(value) * F.lit(10.0**scale)).cast("bigint")


def moment_form(df: DataFrame, value: str, scale: int | None, exact: bool | None, wide: bool | None) -> tuple[str, int, bool]:
    """``(form, scale, wide)`` to use: ``prefix`` (running sums of integers), ``segments`` (merged block statistics) or
    ``sliding`` (Spark's own frame). A stated ``scale`` asks for the prefix form. Without one the type decides: integers and
    decimals whose squares add up inside 38 digits take it with their own scale, everything else (doubles above all, whose
    digits are unknown) the segments, which are right for any value."""
    dtype = df.schema[value].dataType
    if exact is False:
        return "sliding", 0, False
    if scale is not None:
        return "prefix", scale, bool(wide)
    if isinstance(dtype, DecimalType) and dtype.precision <= 13:
        return "prefix", dtype.scale, dtype.precision > 4 if wide is None else wide
    if isinstance(dtype, (ByteType, ShortType, IntegerType)):
        return "prefix", 0, isinstance(dtype, IntegerType) if wide is None else wide
    if exact:
        raise ValueError(f"exact statistics of a {dtype.simpleString()} column need scale=")
    return "segments", 0, False


def segment_moments(
    df: DataFrame, value: str, size: int, gap: int, order, keys: Sequence[str], mean_name: str, std_name: str,
    position: str | None = None,
) -> DataFrame:
    """Trailing mean and sample standard deviation of any double in O(log size) per row, without subtracting sums.

    Count, mean and squared deviations of the last 1, 2, 4, ... rows come from doubling: a segment of 2k rows is the one that ends
    at the row merged with the one that ends k rows before. A frame of ``size`` rows is the merge of the segments of its binary
    digits. Merges follow the parallel variance formula, so large values with a small spread keep their digits, and a NaN or
    infinity harms only the frames that hold it. All of it is lags over one window spec: one exchange by ``keys`` and one sort
    of rows without statistics, so a task holds its rows once. The merges depend on the frame's rows alone: a series that is cut into
    blocks gives the same bits as the whole one. ``position``: a column with consecutive row numbers per key to order by."""
    w = spec(keys, position or order)
    taken = set(df.columns)
    name = lambda n: next(c for c in (f"_{n}{'_' * i}" for i in range(len(taken) + 1)) if c not in taken)
    part, done, far, near = (name(n) for n in ("part", "done", "far", "near"))
    x = F.col(value).cast("double")
    # x - x: 0, and NaN for NaN and infinities
    out = df.withColumn(part, F.struct(F.when(x.isNull(), 0).otherwise(1).cast("bigint").alias("n"), F.coalesce(x, F.lit(0.0)).alias("m"),
                                       F.coalesce(x - x, F.lit(0.0)).alias("v")))

    covered = 0  # rows of the frame, from its latest on, that ``done`` holds
    for k in (1 << i for i in range(size.bit_length())):
        last = 2 * k > size
        lags = {}
        if not last:
            lags[near] = F.lag(part, k).over(w)
        if size & k:
            lags[far] = F.lag(part, covered + (gap if last else 0)).over(w)
        if last and covered:
            lags[done] = F.lag(done, gap).over(w)
        out = out.withColumns(lags)
        if size & k:
            out = out.withColumn(done, _merged(F.col(far), F.col(done)) if covered else F.col(far)).drop(far)
            covered += k
        if not last:
            out = out.withColumn(part, _merged(F.col(near), F.col(part))).drop(near)
    n, m, v = (F.col(done)[c] for c in "nmv")
    return out.withColumns({mean_name: F.when(n > 0, m), std_name: F.when(n > 1, F.sqrt(v / (n - 1)))}).drop(part, done)


def _merged(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two segments as one; a NULL one has no rows."""
    n, delta = a["n"] + b["n"], b["m"] - a["m"]
    off = F.isnan(delta - delta)  # a NaN or infinity on either side: the mean is that of the sum
    both = F.struct(n.alias("n"), F.when(off, a["m"] + b["m"]).otherwise(a["m"] + delta * (b["n"] / n)).alias("m"),
                    (a["v"] + b["v"] + delta * delta * (a["n"] * b["n"] / n)).alias("v"))
    return F.when(F.coalesce(a["n"], F.lit(0)) == 0, b).when(F.coalesce(b["n"], F.lit(0)) == 0, a).otherwise(both)


def moment_prefix_columns(
    value: str, size: int, gap: int, order, keys: Sequence[str], scale: int, wide: bool, tag: str
) -> dict[str, Column]:
    """Exact running sums of x, x^2 and count(x) (x = value scaled to integers) over
    ``rows unbounded..gap preceding`` and ``rows unbounded..gap+size preceding``.

    Both frames are evaluated incrementally (one pass per key), unlike a sliding frame
    that re-aggregates ``size`` rows for every output row. Squares are decimals in either form:
    those of large hourly sums add up to more than a bigint holds."""
    w = spec(keys, order)
    number = F.col(value).cast("double")
    off = F.isnan(number - number)  # NaN and infinities have no integer form: they are counted instead
    x = F.when(~off, _scaled(value, scale, wide))
    bad = F.when(off, 1)
    near = w.rowsBetween(Window.unboundedPreceding, -gap)
    far = w.rowsBetween(Window.unboundedPreceding, -(gap + size))
    none = F.lit(0).cast("decimal(38,0)")
    zero, factor = (none, x) if wide else (F.lit(0).cast("bigint"), x.cast("decimal(19,0)"))
    square = factor * factor
    return {
        f"_s_{tag}": F.coalesce(F.sum(x).over(near), zero) - F.coalesce(F.sum(x).over(far), zero),
        f"_q_{tag}": F.coalesce(F.sum(square).over(near), none) - F.coalesce(F.sum(square).over(far), none),
        f"_n_{tag}": F.count(x).over(near) - F.count(x).over(far),
        f"_b_{tag}": F.count(bad).over(near) - F.count(bad).over(far),
    }


def moments_from_prefix(tag: str, scale: int, mean_name: str | None, std_name: str | None) -> dict[str, Column]:
    """Mean = S/N, sample std = sqrt((N*Q - S^2) / (N*(N-1))), both rescaled; NULL for N=0 / N<2.
    A frame that holds a NaN or an infinity gives NaN."""
    s, q, n = F.col(f"_s_{tag}"), F.col(f"_q_{tag}"), F.col(f"_n_{tag}")
    unit = 10.0**scale
    bad, nan = F.col(f"_b_{tag}"), F.lit(float("nan"))
    out = {}
    if mean_name:
        out[mean_name] = F.when(bad > 0, nan).when(n > 0, s.cast("double") / (n.cast("double") * F.lit(unit)))
    if std_name:
        total = s.cast("decimal(38,0)")  # its square may not fit a bigint
        var = (n * q - total * total).cast("double") / (n * (n - 1)).cast("double")
        out[std_name] = F.when((bad > 0) & (n + bad > 1), nan).when((bad == 0) & (n > 1), F.sqrt(var) / F.lit(unit))
    return out


def rolling_moments(
    df: DataFrame, value: str, size: int, gap: int = 1, order: str = "timestamp_utc",
    keys: Sequence[str] = (), scale: int | None = None, mean_name: str | None = None, std_name: str | None = None,
    exact: bool | None = None, wide: bool | None = None, position: str | None = None,
) -> DataFrame:
    """Trailing mean and sample standard deviation over ``rows gap+size-1 .. gap preceding``
    (reference frame: size 168, gap 1 = the 168 rows before the current one). NULLs are skipped.

    ``scale=k`` is the caller's statement that values have at most ``k`` decimals: integers ``round(value * 10^k)``
    are summed, exactly and in one pass: values as bigint, their squares as decimal(38,0). Bigint sums raise on overflow (scaled
    values over a key or block above 9.2e18); ``wide=True`` takes the values' digits and sums as decimal(38,0), too. Either raises beyond
    38 digits (frame rows times squares above 1e38: scaled values from about 1e17 on). Without ``scale`` see ``moment_form``: doubles merge
    block statistics (``segment_moments``). ``exact=False`` takes Spark's sliding frame (``size`` values per row). A NaN or infinity
    gives NaN in the prefix form, and what the double statistics give in the others."""
    mean_name = mean_name or f"rolling_mean_{size}"
    std_name = std_name or f"rolling_std_{size}"
    form, scale, wide = moment_form(df, value, scale, exact, wide)
    if form == "segments":
        return segment_moments(df, value, size, gap, order, keys, mean_name, std_name, position)
    if form == "sliding":
        frame = spec(keys, order).rowsBetween(-(gap + size - 1), -gap)
        return df.withColumns({mean_name: F.avg(value).over(frame), std_name: F.stddev_samp(value).over(frame)})
    tag = f"{value}_{size}_{gap}"
    staged = df.withColumns(moment_prefix_columns(value, size, gap, order, keys, scale, wide, tag))
    return staged.withColumns(moments_from_prefix(tag, scale, mean_name, std_name)).drop(
        f"_s_{tag}", f"_q_{tag}", f"_n_{tag}", f"_b_{tag}"
    )


def forward_fill(
    df: DataFrame, value: str, order: str = "timestamp_utc", keys: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """Last non-NULL value up to and including the current row (RANGE frame: timestamp peers included)."""
    w = spec(keys, order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out or value, F.last(value, ignorenulls=True).over(w))


def drop_head(df: DataFrame, n: int, order: str = "timestamp_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Remove the first ``n`` rows of every key (all rows of keys with fewer)."""
    rn = F.row_number().over(spec(keys, order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") > n).drop("_rn")


def drop_tail(df: DataFrame, n: int, order: str = "timestamp_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Remove the latest ``n`` rows of every key. Uses the ascending spec (position <= count - n),
    so it shares the sort of the other operators instead of adding a descending one."""
    w = spec(keys, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    staged = df.withColumns({"_rn": F.row_number().over(w), "_cnt": F.count(F.lit(1)).over(whole)})
    return staged.filter(F.col("_rn") <= F.col("_cnt") - n).drop("_rn", "_cnt")


def temporal_lags(
    df: DataFrame, value: str, hours, ts: str = "timestamp_utc", keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``value`` exactly k hours earlier (NULL when that hour has no row), as equi-joins on
    ``(keys, ts)`` against the series shifted forward by k hours: no ordering, no window, and
    no single partition for an un-keyed series. Equal to positional lags on gap-free hourly data.
    The series must have one row per (keys, ts)."""
    names = list(names) if names is not None else [f"{value}_lag_{k}" for k in hours]
    out = df
    for k, name in zip(hours, names):
        shifted = df.select(*keys, (F.col(ts) + F.expr(f"INTERVAL {int(k)} HOURS")).alias(ts), F.col(value).alias(name))
        out = out.join(shifted, [*keys, ts], "left")
    return out
