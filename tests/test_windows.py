"""Window operators on small frames: positional lags, exact moments, fills, trimming, blocks."""

import datetime as dt
import math
import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadcast.operators import index, windows
from loadcast.plans import features

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, keys=("a",), gaps=()):
    rows = []
    for k in keys:
        h = 0
        for i, v in enumerate(values):
            if i in gaps:
                h += 1
            rows.append((k, T0 + dt.timedelta(hours=h), v))
            h += 1
    return spark.createDataFrame(rows, "group_id string, timestamp_utc timestamp_ntz, target_consumption double")


def by_time(df, *cols):
    return [tuple(r) for r in df.orderBy("group_id", "timestamp_utc").select(*cols).collect()]


def test_lag_is_positional_on_gapped_series(spark):
    # T1: a missing hour shifts the lag, the lag is the previous *row*
    df = series(spark, [1.0, 2.0, 3.0], gaps=(2,))
    out = by_time(windows.lag_features(df, "target_consumption", [1], keys=["group_id"], names=["l1"]), "l1")
    assert out == [(None,), (1.0,), (2.0,)]


@pytest.mark.parametrize("low,high,digits,options", [
    (0.04, 0.06, 13, {}), (190_000.0, 210_000.0, 5, {}), (0.9e17, 1.1e17, 0, {}),
    (0.04, 0.06, 13, {"scale": 13, "wide": True}), (190_000.0, 210_000.0, 5, {"scale": 5, "wide": True}),
    (0.9e15, 1.1e15, 0, {"scale": 0, "wide": True})])
def test_rolling_moments_of_ordinary_doubles(spark, low, high, digits, options):
    rnd = random.Random(3)
    vals = [round(rnd.uniform(low, high), digits) for _ in range(700)]
    out = windows.rolling_moments(series(spark, vals), "target_consumption", 168, 1, keys=["group_id"], **options)
    for i, (mean, std) in enumerate(by_time(out, "rolling_mean_168", "rolling_std_168")):
        frame = vals[max(0, i - 168):i]
        assert mean == (pytest.approx(statistics.fmean(frame), rel=1e-9) if frame else None)
        assert std == (pytest.approx(statistics.stdev(frame), rel=1e-9) if len(frame) > 1 else None)


def test_wide_moments_raise_beyond_their_range(spark):
    df = series(spark, [1e17, 1.1e17] * 100)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC_OVERFLOW"):
        windows.rolling_moments(df, "target_consumption", 168, 1, keys=["group_id"], scale=2, wide=True).collect()


@pytest.mark.parametrize("options", [{}, {"scale": 2}, {"scale": 2, "wide": True}])
def test_rolling_moments_with_nan(spark, options):
    vals = [1.0, 2.0, float("nan"), 4.0, 5.0, 7.0, 8.0]
    out = windows.rolling_moments(series(spark, vals), "target_consumption", 2, 1, keys=["group_id"], **options)
    got = by_time(out, "rolling_mean_2", "rolling_std_2")
    assert got[0] == (None, None) and got[1] == (1.0, None) and got[2][0] == 1.5
    assert all(math.isnan(x) for row in got[3:5] for x in row)
    assert got[5][0] == 4.5 and got[6][0] == 6.0


def test_rolling_moments_match_definition(spark):
    rnd = random.Random(7)
    vals = [round(rnd.uniform(-50, 50), 2) if rnd.random() > 0.2 else None for _ in range(60)]
    df = series(spark, vals, keys=("a", "b"))
    out = windows.rolling_moments(df, "target_consumption", 5, 1, keys=["group_id"])
    got = by_time(out.filter("group_id = 'a'"), "rolling_mean_5", "rolling_std_5")
    for i, (mean, std) in enumerate(got):
        frame = [v for v in vals[max(0, i - 5):i] if v is not None]
        if not frame:
            assert mean is None
        else:
            assert mean == pytest.approx(sum(frame) / len(frame), abs=1e-9)
        if len(frame) < 2:
            assert std is None
        else:
            m = sum(frame) / len(frame)
            assert std == pytest.approx(math.sqrt(sum((x - m) ** 2 for x in frame) / (len(frame) - 1)), abs=1e-9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-10_000, 10_000)), min_size=1, max_size=40),
       st.integers(1, 6), st.integers(1, 3))
def test_exact_moments_equal_builtin_frame(spark, ints, size, gap):
    vals = [None if v is None else v / 100 for v in ints]
    df = series(spark, vals)
    exact = windows.rolling_moments(df, "target_consumption", size, gap, keys=["group_id"], scale=2, mean_name="m",
                                    std_name="s")
    builtin = windows.rolling_moments(df, "target_consumption", size, gap, keys=["group_id"], mean_name="m",
                                      std_name="s", exact=False)
    for (m1, s1), (m2, s2) in zip(by_time(exact, "m", "s"), by_time(builtin, "m", "s")):
        assert (m1 is None) == (m2 is None) and (s1 is None) == (s2 is None)
        if m1 is not None:
            assert m1 == pytest.approx(m2, abs=1e-9)
        if s1 is not None:
            assert s1 == pytest.approx(s2, abs=1e-7)


def test_forward_fill_keeps_leading_nulls_and_nan(spark):
    df = series(spark, [None, 1.0, None, float("nan"), None])
    out = by_time(windows.forward_fill(df, "target_consumption", keys=["group_id"], out="f"), "f")
    assert out[0] == (None,) and out[1] == (1.0,) and out[2] == (1.0,)
    assert math.isnan(out[3][0]) and math.isnan(out[4][0])  # T10: NaN is a value, it is carried forward


def test_drop_head_and_tail(spark):
    df = series(spark, [float(i) for i in range(10)], keys=("a", "b"))
    head = windows.drop_head(df, 3, keys=["group_id"])
    tail = windows.drop_tail(df, 4, keys=["group_id"])
    assert [r[0] for r in by_time(head.filter("group_id='a'"), "target_consumption")] == [3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    assert [r[0] for r in by_time(tail.filter("group_id='b'"), "target_consumption")] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    short = series(spark, [1.0, 2.0])
    assert windows.drop_head(short, 3, keys=["group_id"]).count() == 0


def test_row_index_equals_global_row_number(spark):
    df = spark.range(0, 2000).select(
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7).cast("int"))).alias("ts"),
        F.col("id").cast("double").alias("v"),
    )
    indexed = index.row_index(df, "ts")
    assert indexed.filter(F.col(index.IDX) != F.col("v") + 1).count() == 0


def test_positional_lags_equal_window_lags(spark):
    rnd = random.Random(3)
    rows = [(k, T0 + dt.timedelta(hours=h), float(rnd.randint(0, 99)))
            for k in ("x", "y") for h in sorted(rnd.sample(range(400), 150))]
    df = spark.createDataFrame(rows, "group_id string, timestamp_utc timestamp_ntz, target_consumption double")
    a = index.positional_lags(df, "target_consumption", [1, 5, 24], "timestamp_utc", ["group_id"], block_rows=32)
    b = windows.lag_features(df, "target_consumption", [1, 5, 24], keys=["group_id"])
    cols = ["target_consumption_lag_1", "target_consumption_lag_5", "target_consumption_lag_24"]
    assert by_time(a, *cols) == by_time(b, *cols)


def test_blocked_features_equal_plain_features(spark):
    rnd = random.Random(11)
    vals = [round(rnd.uniform(0, 20), 2) for _ in range(900)]
    df = series(spark, vals, keys=("g1", "g2")).withColumn("group_id", F.substring("group_id", 2, 1).cast("int"))
    plain = features.hourly_features(df, block_rows=None)
    blocked = features.hourly_features(df, block_rows=400)
    cols = ["timestamp_utc", "group_id", *features.FEATURE_COLUMNS]
    assert plain.count() == 2 * (900 - 336)
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, blocked.select(cols).collect()))


def test_blocked_rejects_short_blocks(spark):
    df = index.row_index(series(spark, [1.0, 2.0]), "timestamp_utc", ["group_id"])
    with pytest.raises(ValueError):
        index.blocked(df, ["group_id"], 10, 5, lambda d, k, o: d)


def test_split_operators_keep_null_keys(spark):
    rows = [(None, T0 + dt.timedelta(days=d, hours=h), 1.0 if (d, h) == (0, 0) else None) for d in range(3) for h in range(2)]
    df = spark.createDataFrame(rows, "group_id string, timestamp_utc timestamp_ntz, target_consumption double")
    idx = index.row_index(df, "timestamp_utc", ["group_id"])
    assert sorted(r[0] for r in idx.select(index.IDX).collect()) == [1, 2, 3, 4, 5, 6]
    filled = index.forward_fill_split(df, "target_consumption", "timestamp_utc", ["group_id"], out="f")
    assert [r[0] for r in filled.select("f").collect()] == [1.0] * 6


def test_hot_group_is_spread_over_many_tasks(spark):
    """One group with ~99% of the rows: the blocked plan windows it in many partitions."""
    hot = [(1, T0 + dt.timedelta(hours=h), float(h % 7)) for h in range(6000)]
    cold = [(g, T0 + dt.timedelta(hours=h), 1.0) for g in range(2, 6) for h in range(20)]
    df = spark.createDataFrame(hot + cold, "group_id int, timestamp_utc timestamp_ntz, target_consumption double")
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = index.row_index(df, "timestamp_utc", ["group_id"])

        def apply(d, ks, o):
            return d.withColumns(windows.lag_columns("target_consumption", [48], o, ks, names=["l48"])).withColumn(
                "_pid", F.spark_partition_id())

        out = index.blocked(indexed, ["group_id"], 48, 500, apply)
        # keep the lag in the projection: otherwise the unused window (and its exchange) is pruned away
        hot_rows = out.filter("group_id = 1").select("l48", "_pid").collect()
        pids = len({r["_pid"] for r in hot_rows})
        assert len(hot_rows) == 6000 and pids >= 5, pids
        plain = windows.lag_features(df, "target_consumption", [48], keys=["group_id"], names=["l48"])
        assert sorted(map(tuple, out.select("group_id", "timestamp_utc", "l48").collect())) == \
            sorted(map(tuple, plain.select("group_id", "timestamp_utc", "l48").collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_row_index_with_timestamp_and_string_keys(spark):
    rows = [(T0 if i % 2 else None, "k" if i % 3 else None, T0 + dt.timedelta(hours=i)) for i in range(30)]
    df = spark.createDataFrame(rows, "kt timestamp_ntz, ks string, ts timestamp_ntz")
    idx = index.row_index(df, "ts", ["kt", "ks"])
    assert idx.count() == 30
    per_key = idx.groupBy("kt", "ks").agg(F.max(index.IDX).alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["m"] == r["n"] for r in per_key)


def test_row_index_keeps_rows_without_order_value(spark):
    from pyspark.sql import functions as F

    from loadcast.operators import index

    df = spark.range(50).select(F.lit(1).alias("k"), F.when(F.col("id") > 0, F.timestamp_seconds(F.col("id") * 40_000)).alias("ts"), "id")
    got = index.row_index(df, "ts", ["k"]).orderBy("_idx").collect()
    assert [r["_idx"] for r in got] == list(range(1, 51)) and [r.id for r in got] == list(range(50))


def test_since_keeps_every_row_of_a_gapped_series(spark):
    from pyspark.sql import functions as F

    from loadcast.plans import features

    long = spark.range(720).select(F.lit(1).alias("group_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 10800).alias("timestamp_utc"),
                                   (F.col("id") % 17).cast("double").alias("target_consumption"))
    whole = features.hourly_features(long).filter("timestamp_utc >= timestamp'2024-03-15'")
    since = features.hourly_features(long, since="2024-03-15 00:00:00")
    assert whole.count() == since.count() > 100
    assert whole.exceptAll(since).isEmpty()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.just(float("nan"))), min_size=1, max_size=40),
       st.integers(1, 6), st.integers(1, 3))
def test_segment_moments_equal_builtin_frame(spark, vals, size, gap):
    df = series(spark, vals)
    merged = windows.rolling_moments(df, "target_consumption", size, gap, keys=["group_id"], mean_name="m", std_name="s")
    builtin = windows.rolling_moments(df, "target_consumption", size, gap, keys=["group_id"], mean_name="m",
                                      std_name="s", exact=False)
    assert set(merged.columns) == set(builtin.columns)
    for got, want in zip(by_time(merged, "m", "s"), by_time(builtin, "m", "s")):
        for a, b in zip(got, want):
            assert (a is None) == (b is None)
            if a is not None:
                assert (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-9, abs=1e-6)


def test_segments_in_the_blocked_plan_and_with_clashing_names(spark):
    from loadcast.plans import features

    rnd = random.Random(5)
    df = series(spark, [rnd.uniform(1e5, 1e5 + 1) for _ in range(900)]).withColumn("_rn", F.lit(7)).withColumn("_seg", F.lit("x"))
    out = windows.rolling_moments(df, "target_consumption", 168, 1, keys=["group_id"])
    assert {(r["_rn"], r["_seg"]) for r in out.collect()} == {(7, "x")}
    plain = df.drop("_rn", "_seg")
    blocks = features.hourly_features(plain, block_rows=400)
    whole = features.hourly_features(plain, block_rows=None, exact=False)
    for a, b in zip(by_time(blocks, "rolling_mean_168", "rolling_std_168"), by_time(whole, "rolling_mean_168", "rolling_std_168")):
        assert a == pytest.approx(b, rel=1e-9)


@pytest.mark.parametrize("keyed", [True, False])
def test_since_with_day_counts_is_exact_on_gaps(spark, keyed, tmp_path):
    """Groups of different density (one of them young, one with a NULL key, rows without a time): the same rows as the whole
    history, from fewer days."""
    rnd = random.Random(11)
    rows = []
    for g, step in ((1, 1), (2, 5), (None, 2)) if keyed else ((0, 3),):
        at = T0
        while at < dt.datetime(2024, 6, 1):
            rows.append((g, at, rnd.uniform(0, 9)))
            at += dt.timedelta(hours=step * rnd.randint(1, 3))
    rows += [(3, dt.datetime(2024, 5, 30) + dt.timedelta(hours=k), 1.0) for k in range(60)] if keyed else []
    rows += [(1 if keyed else 0, None, 5.0)] * 3
    df = spark.createDataFrame(rows, "group_id int, timestamp_utc timestamp, target_consumption double")
    df.withColumn("day", F.to_date("timestamp_utc")).write.partitionBy("day").parquet(f"{tmp_path}/series")
    long = spark.read.parquet(f"{tmp_path}/series")
    keys, since = (["group_id"] if keyed else []), "2024-05-25 07:00:00"
    counts = index.day_counts(long, "timestamp_utc", keys)
    cols = ["group_id", "timestamp_utc", "target_consumption"]
    pruned = features.hourly_features(long, keys, since=since, day_counts=counts, day_column="day").drop("day")
    whole = features.hourly_features(long.select(*cols), keys).filter(F.col("timestamp_utc") >= since)
    key = lambda r: str((r["group_id"], r["timestamp_utc"]))
    got, want = sorted(pruned.collect(), key=key), sorted(whole.collect(), key=key)
    assert len(got) == len(want) > 30 and sorted(pruned.columns) == sorted(whole.columns)
    for a, b in zip(got, want):
        assert all(a[c] == (pytest.approx(b[c], rel=1e-9) if isinstance(b[c], float) else b[c]) for c in whole.columns)
    named = long.withColumn("f", F.col("_metadata.file_path"))
    near = index.prune_history(named, counts, "timestamp_utc", keys, F.lit(since).cast("timestamp"), 336, "day")
    if not keyed:  # the file of the rows without a time is not read either
        assert near.select("f").distinct().count() < named.select("f").distinct().count() - 30
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and near.count() < long.count()


def test_segment_moments_sort_rows_once_and_do_not_depend_on_the_cut(spark):
    """One sort for all levels; a frame's bits are those of its rows; infinities act as in the double statistics."""
    rnd = random.Random(7)
    vals = [rnd.uniform(1e5, 1e5 + 1) for _ in range(300)]
    out = windows.rolling_moments(series(spark, vals), "target_consumption", 21, 2, keys=["group_id"], mean_name="m", std_name="s")
    assert out._jdf.queryExecution().sparkPlan().toString().count("Window [") >= 4
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Sort [") == 1
    cut = windows.rolling_moments(series(spark, vals[37:]), "target_consumption", 21, 2, keys=["group_id"], mean_name="m", std_name="s")
    assert by_time(out, "m", "s")[37 + 22:] == by_time(cut, "m", "s")[22:]
    inf = float("inf")
    odd = by_time(windows.rolling_moments(series(spark, [inf, 1.0, inf, 2.0, 3.0, 4.0]), "target_consumption", 3, 1, keys=["group_id"],
                                          mean_name="m", std_name="s"), "m", "s")
    assert [r[0] for r in odd] == [None, inf, inf, inf, inf, inf] and odd[1][1] is None and all(math.isnan(r[1]) for r in odd[2:])


def test_daily_series_is_dealt_to_tasks_by_the_table_size(spark, tmp_path, monkeypatch):
    """More input, more tasks: a task's lines stay the same; the rows are those of a plain grouping."""
    from loadcast.sources import testviews as tv

    lines = spark.range(5000).select((F.col("id") % 40).alias("l_suppkey"), F.expr("date_add(date'2024-01-01', int(id % 90))").alias("l_shipdate"),
                                     (F.col("id") % 50 + 0.25).alias("l_quantity"), F.lit("x").alias("l_comment"))
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(tv, "TASK_BYTES", 16)
    daily = tv.supplier_daily(spark, str(tmp_path))
    assert daily.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    want = lines.groupBy("l_suppkey", "l_shipdate").agg(F.sum("l_quantity")).collect()
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, want))
    assert sorted(map(tuple, tv.supplier_daily(spark, str(tmp_path), dealt=False).collect())) == sorted(map(tuple, want))


@pytest.mark.parametrize("block_rows", [None, 400])
def test_exact_moments_of_sums_whose_squares_exceed_a_bigint(spark, block_rows):
    """Hourly sums of a large meter park: frame rows times squares, and squares themselves, pass 9.2e18. Exact by the definition."""
    rnd = random.Random(13)
    cents = [rnd.randint(15_000_000, 45_000_000) if h < 300 else rnd.randint(4_000_000_000, 6_000_000_000) for h in range(600)]
    df = series(spark, [c / 100 for c in cents])
    out = features.hourly_features(df, min_history_rows=0, scale=2, block_rows=block_rows)
    got = by_time(out, "rolling_mean_168", "rolling_std_168")
    assert len(got) == 600
    for h, (mean, std) in enumerate(got):
        frame = cents[max(0, h - 168):h]
        n, s, q = len(frame), sum(frame), sum(c * c for c in frame)
        assert mean == (s / (n * 100.0) if n else None)
        assert std == (math.sqrt(float(n * q - s * s) / float(n * (n - 1))) / 100.0 if n > 1 else None)
