"""Series operators against pandas, with chunks short enough that everything crosses them."""
import math
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterflow import Series
from meterflow.operators import correlate, fill, resample, spectral, windows
from meterflow.operators.fill import Rule

S = Series(("entity",), "hourutc", chunk=7)
REGULAR = S.over(regular=True)


def random_table(seed=3, missing=0.4, drop=0.0, lengths=(1, 5, 40, 300)):
    rng = np.random.default_rng(seed)
    frames = []
    for i, n in enumerate(lengths):
        x, y = rng.normal(10, 3, n), rng.normal(0, 1, n)
        x[rng.random(n) < missing] = np.nan
        frame = pd.DataFrame({"entity": f"e{i}", "hourutc": pd.date_range("2022-01-01", periods=n, freq="h"), "x": x, "y": y})
        frames.append(frame[rng.random(n) >= drop] if drop else frame)
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in row)
            for row in pdf.itertuples(index=False)]
    schema = ", ".join(f"{c} {'string' if c == 'entity' else 'timestamp_ntz' if c == 'hourutc' else 'double'}" for c in pdf.columns)
    return spark.createDataFrame(rows, schema).repartition(5)


def back(df, column):
    return df.toPandas().sort_values(["entity", "hourutc"], ignore_index=True)[column].astype(float).to_numpy()


def same(got, want):
    np.testing.assert_allclose(got, np.asarray(want, dtype=float), atol=1e-9, equal_nan=True)


@pytest.fixture(scope="module", params=[(0.0, REGULAR), (0.3, S)], ids=["regular", "irregular"])
def case(request, spark):
    drop, s = request.param
    pdf = random_table(drop=drop)
    return pdf, to_spark(spark, pdf), s


def per_series(pdf, fn):
    return pdf.groupby("entity", group_keys=False).apply(fn, include_groups=False).to_numpy()


def test_forward_and_backward_fill(case):
    pdf, df, s = case
    same(back(fill.forward_fill(df, s, "x"), "x"), per_series(pdf, lambda g: g.x.ffill()))
    same(back(fill.backward_fill(df, s, "x"), "x"), per_series(pdf, lambda g: g.x.bfill()))
    once = fill.forward_fill(df, s, "x")
    same(back(fill.forward_fill(once, s, "x"), "x"), back(once, "x"))


@pytest.mark.parametrize("window", [1, 2, 24])
def test_rolling_mean_and_imputation(case, window):
    pdf, df, s = case
    rolled = per_series(pdf, lambda g: g.x.rolling(window, min_periods=1).mean())
    same(back(fill.rolling_mean(df, s, "x", window), "rolling"), rolled)
    want = per_series(pdf, lambda g: g.x.fillna(g.x.rolling(window, min_periods=1).mean().bfill()))
    got = back(fill.impute_rolling(df, s, "x", window), "x")
    same(got, want)
    seen = pdf.x.notna().to_numpy()
    same(got[seen], pdf.x[seen])


def test_threshold_gate_is_strict(spark, hourly):
    df = hourly([1.0, None, 3.0, None, 5.0])  # 40 % missing: not filled
    assert back(fill.impute_threshold(df, REGULAR, "x"), "x").tolist()[1] != 1.0
    filled = fill.impute_threshold(df, REGULAR, "x", max_missing_pct=40.1)
    assert back(filled, "x").tolist() == [1.0, 1.0, 3.0, 2.0, 5.0]


def test_rules_in_one_pass(case):
    pdf, df, s = case
    rules = [Rule("x", window=5, max_missing_pct=45, whole=True), Rule("y", "keep")]
    got = fill.impute(df.withColumn("z", F.col("x")), s, [*rules, Rule("z", "forward", entities=("e2", "e3"))])

    def want(g):
        x = g.x.fillna(g.x.rolling(5, min_periods=1).mean().bfill()) if g.x.isna().mean() * 100 < 45 else g.x
        return np.trunc(x)
    same(back(got, "x"), per_series(pdf, want))
    z = pd.Series(per_series(pdf, lambda g: g.x.ffill()))
    same(back(got, "z"), np.where(pdf.entity.isin(["e2", "e3"]), z, pdf.x))
    assert got.columns == [*df.columns, "z"] and got.count() == len(pdf)


def test_edges_all_null_and_lead_trail(hourly):
    empty = hourly([None] * 5)
    assert back(fill.impute_rolling(empty, REGULAR, "x"), "x").tolist() == pytest.approx([np.nan] * 5, nan_ok=True)
    df = hourly([None, 1.0, None, None, None, 4.0, None, None, None])
    n = np.nan
    same(back(fill.rolling_mean(df, REGULAR, "x", 2), "rolling"), [n, 1, 1, n, n, 4, 4, n, n])
    same(back(fill.impute_rolling(df, REGULAR, "x", 2), "x"), [1, 1, 1, 4, 4, 4, 4, n, n])


def test_gaps(case, hourly):
    pdf, df, s = case
    gaps = windows.find_gaps(df, s, "x").toPandas()
    assert gaps.gap_length_records.sum() == pdf.x.isna().sum()
    want = []
    for e, g in pdf.groupby("entity"):
        g = g.reset_index(drop=True)
        gone = g.x.isna()
        for _, run in g[gone].groupby((gone != gone.shift()).cumsum()[gone]):
            want.append((e, run.hourutc.iloc[0], run.hourutc.iloc[-1], len(run), run.index[0], run.index[-1]))
    cols = ["entity", "start_time", "end_time", "gap_length_records", "start_index", "end_index"]
    assert sorted(gaps[cols].itertuples(index=False, name=None)) == sorted(want)
    runs = windows.find_gaps(hourly([None, 1.0, None, None, None, 4.0, None, None, None]), REGULAR, "x").orderBy("start_index").collect()
    assert [(r.gap_length_records, r.start_index, r.duration_days) for r in runs] == [(1, 0, 0.0), (3, 2, 2 / 24), (3, 6, 2 / 24)]
    assert runs[0].duration == timedelta(0)


@pytest.mark.parametrize("lag", [0, 1, 9, 50, 1000])
def test_lag_backfill(case, lag):
    pdf, df, s = case
    want = per_series(pdf, lambda g: g.x.shift(lag).bfill() if lag else g.x)
    same(back(windows.lag_backfill(df, s, "x", lag), "lagged"), want)


@pytest.mark.parametrize("width", [0, 1, 2, 7])
def test_sliding_corr(spark, width):
    pdf = random_table(missing=0.05, lengths=(3, 60, 200))
    got = back(correlate.sliding_corr(to_spark(spark, pdf), REGULAR, "x", "y", width), "corr")
    if width < 2:
        assert np.isnan(got).all()
        return
    # pandas updates its moments as the frame moves, so near-constant frames carry noise there.
    want = per_series(pdf, lambda g: g.x.rolling(width, center=True).corr(g.y))
    np.testing.assert_allclose(got, want, atol=1e-5, equal_nan=True)
    assert np.nanmax(np.abs(got)) <= 1 + 1e-9


def test_constant_frame_has_no_correlation(spark):
    pdf = pd.DataFrame({"entity": "a", "hourutc": pd.date_range("2022-01-01", periods=4, freq="h"), "x": [1.0, 1, 1, 2], "y": [2.0, 3, 4, 5]})
    got = back(correlate.sliding_corr(to_spark(spark, pdf), REGULAR, "x", "y", 3), "corr")
    assert np.isnan(got[[0, 1, 3]]).all() and got[2] == pytest.approx(0.8660254)


def test_position_with_ties_and_running_max(case, spark):
    pdf, df, s = case
    want = pdf.groupby("entity").cumcount().to_numpy()
    same(back(windows.series_position(df, s), "position"), want)
    same(back(windows.running_abs_max(df, s, "y"), "max_y"), per_series(pdf, lambda g: g.y.abs().cummax()))
    twice = df.withColumn("n", F.lit(0)).unionByName(df.withColumn("n", F.lit(1)))
    placed = windows.series_position(twice, s, tie=["n"]).filter("n = 1")
    same(back(placed, "position"), want * 2 + 1)


@pytest.mark.parametrize("keep", [0, 3, 400])
def test_dct(spark, keep):
    pdf = random_table(missing=0.0, lengths=(1, 6, 90))

    def smooth(g):
        x, n = g.x.to_numpy(), len(g)
        at = np.arange(n)
        basis = np.cos(np.pi * np.outer(at, 2 * at + 1) / (2 * n))
        c = 2 * basis @ x
        c[at > keep] = 0
        weights = np.where(at == 0, 1.0, 2.0)
        return pd.Series((weights * c) @ basis / (2 * n), index=g.index)
    got = back(spectral.dct_smooth(to_spark(spark, pdf), S, "x", keep), "x_smooth")
    same(got, per_series(pdf, smooth))
    if keep >= 89:
        same(got, pdf.x)


def test_dct_constant_and_missing(hourly):
    same(back(spectral.dct_smooth(hourly([5.0] * 9), S, "x", 2), "x_smooth"), [5.0] * 9)
    assert np.isnan(back(spectral.dct_smooth(hourly([5.0, None, 5.0]), S, "x", 2), "x_smooth")).all()


@pytest.mark.parametrize("offset,spread", [(1e9, 1e-3), (0.0, 1.0), (-1e12, 1e3)])
def test_running_sums_do_not_cancel(spark, offset, spread):
    """Means of a frame as exact as summing the frame itself, also behind a value far larger than the others."""
    rng = np.random.default_rng(1)
    x = offset + spread * rng.normal(size=700)
    x[[40, 300]] = [1e17, np.inf]
    pdf = pd.DataFrame({"entity": "a", "hourutc": pd.date_range("2022-01-01", periods=len(x), freq="h"), "x": x})
    frames = [[float(v) for v in x[max(0, i - 23):i + 1] if np.isfinite(v)] for i in range(len(x))]
    want = [math.fsum(f) / len(f) for f in frames]
    for s in (REGULAR.over(chunk=4096), REGULAR.over(chunk=50), S.over(chunk=300)):
        got = back(fill.rolling_mean(to_spark(spark, pdf), s, "x", 24), "rolling")
        np.testing.assert_allclose(got, want, rtol=1e-15, atol=1e-15 * spread)


def test_small_spreads_correlate(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=300)
    y = x + rng.normal(size=300)
    pdf = pd.DataFrame({"entity": "a", "hourutc": pd.date_range("2022-01-01", periods=300, freq="h"), "x": 1e9 + 1e-2 * x, "y": y})
    pdf.loc[100, "x"] = 1e15
    got = back(correlate.sliding_corr(to_spark(spark, pdf), REGULAR, "x", "y", 8), "corr")
    for i in range(4, 296):
        frame = slice(i - 4, i + 4)
        a, b = pdf.x.to_numpy()[frame], y[frame]
        a, b = a - a[0], b - b[0]
        assert got[i] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-7), i


@pytest.mark.parametrize("width", [3, 4, 50])
def test_sliding_corr_of_counted_positions(spark, width):
    pdf = random_table(missing=0.0, drop=0.3, lengths=(2, 60, 300))
    got = back(correlate.sliding_corr(to_spark(spark, pdf), S, "x", "y", width), "corr")
    want = per_series(pdf, lambda g: g.x.rolling(width, center=True).corr(g.y))
    np.testing.assert_allclose(got, want, atol=1e-6, equal_nan=True)


def test_a_grid_with_holes_raises(spark, hourly):
    hole = hourly([(0, 1.0), (1, 2.0), (3, 4.0), (40, None)])
    twice = hourly([(0, 1.0), (1, 2.0), (1, 3.0)])
    uses = [lambda d: fill.rolling_mean(d, REGULAR, "x", 2), lambda d: fill.impute_rolling(d, REGULAR, "x", 2), lambda d: windows.lag_backfill(d, REGULAR, "x", 1),
            lambda d: correlate.sliding_corr(d, REGULAR, "x", "x", 2), lambda d: windows.series_position(d, REGULAR), lambda d: spectral.dct_smooth(d, REGULAR, "x", 1)]
    for use in uses:
        for df in (hole, twice):
            with pytest.raises(Exception, match="a regular series has"):
                use(df).collect()
        assert use(hourly([1.0, None, 3.0])).count() == 3
        assert use(hourly([])).count() == 0
    assert fill.rolling_mean(hole, S, "x", 2).count() == 4


def test_seconds_under_an_hourly_step_raise(spark):
    seconds = spark.range(30_000).select(F.lit("a").alias("entity"), F.expr("timestamp_ntz '2022-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("hourutc"),
                                         F.when(F.col("id") != 5, F.col("id").cast("double")).alias("x"))
    for use in (lambda s: fill.rolling_mean(seconds, s, "x", 2), lambda s: fill.forward_fill(seconds, s, "x"), lambda s: windows.find_gaps(seconds, s, "x"),
                lambda s: windows.running_abs_max(seconds, s, "x"), lambda s: windows.series_position(seconds, s)):
        with pytest.raises(Exception, match="a chunk holds"):
            use(S).collect()
        assert use(S.over(step=timedelta(seconds=1), chunk=4096)).count() >= 0


def test_places_of_many_rows_at_one_time(spark):
    """Two thirds of the rows at one time of one series, half of those equal but for their number."""
    n = 6000
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.lit("a")).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("entity"),
                                 F.expr("timestamp_ntz '2022-01-01 00:00:00' + make_dt_interval(0, if(id % 3 > 0, 5, id), 0, 0)").alias("hourutc"),
                                 F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("tie"), "id").repartition(9)
    got = windows.series_position(rows, S, tie=["tie", "id"]).collect()
    want = pd.DataFrame([r.asDict() for r in rows.collect()]).sort_values(["entity", "hourutc", "tie", "id"], ignore_index=True)
    want["position"] = want.groupby("entity").cumcount()
    assert {r["id"]: r["position"] for r in got} == dict(zip(want.id, want.position)) and len(got) == n
    from meterflow.operators import layout
    pieces = layout.by_tie_chunk(rows, S, ["tie", "id"]).groupBy("entity", layout.CHUNK, layout.PIECE).count()
    assert pieces.agg(F.max("count")).first()[0] < n / 50
    nulls = rows.withColumns({"entity": F.lit("a"), "tie": F.lit(None).cast("string")})
    assert sorted(r["position"] for r in windows.series_position(nulls, S, tie=["tie"]).collect()) == list(range(n))


@pytest.mark.parametrize("offset", [0, 1, 60, 4100, 4500, 5999, 6000, 9000])
def test_scan_offset(spark, offset):
    from meterflow.operators import filters

    rows = spark.range(6000).select(F.expr("timestamp_ntz '2022-01-01 00:00:00' + make_dt_interval(0, 0, 0, if(id % 3 > 0, 5000, id))").alias("hourutc"), (F.col("id") % 50).alias("tie"), "id")
    got = filters.time_range(rows, "hourutc", "2022-01-01", "2022-02-01", offset, ["tie", "id"])
    want = sorted(map(tuple, rows.collect()))[offset:]
    assert got.columns == rows.columns and sorted(map(tuple, got.collect())) == want


def test_asfreq_and_daily(spark, case):
    pdf, df, s = case
    got = resample.asfreq_ffill(df, s).toPandas().sort_values(["entity", "hourutc"])
    want = pd.concat([g.set_index("hourutc").asfreq("h", method="ffill").reset_index() for _, g in pdf.groupby("entity")])
    same(got.x.astype(float), want.x)
    assert (got.hourutc.to_numpy() == want.hourutc.to_numpy()).all()
    days = pdf[(pdf.hourutc.dt.day % 3 == 1)]
    if len(days):
        got = resample.daily_resample(to_spark(spark, days), ["entity"], "hourutc", ["x"]).toPandas().sort_values(["entity", "dt"])
        want = pd.concat([g.set_index("hourutc").x.resample("D").mean() for _, g in days.groupby("entity")])
        same(got.x.astype(float), want)


def test_asfreq_off_the_grid(spark):
    rng = np.random.default_rng(2)
    pdf = pd.concat([pd.DataFrame({"entity": e, "hourutc": pd.to_datetime("2022-01-01 00:10") + pd.to_timedelta(np.sort(rng.choice(60 * 24 * 40, n, False)), unit="min"),
                                   "x": rng.normal(size=n)}) for e, n in (("a", 1), ("b", 2), ("c", 40), ("d", 900))])
    got = resample.asfreq_ffill(to_spark(spark, pdf), S.over(chunk=50)).toPandas().sort_values(["entity", "hourutc"])
    want = pd.concat([g.set_index("hourutc").asfreq("h", method="ffill").reset_index() for _, g in pdf.groupby("entity")])
    assert (got.hourutc.to_numpy() == want.hourutc.to_numpy()).all() and len(got) > 500
    same(got.x.astype(float), want.x)


def test_empty_days(spark):
    pdf = pd.DataFrame({"entity": "a", "hourutc": pd.to_datetime(["2022-01-01 05:00", "2022-01-03 06:00"]), "x": [1.0, 3.0]})
    mean = resample.daily_resample(to_spark(spark, pdf), ["entity"], "hourutc", ["x"]).orderBy("dt").collect()
    total = resample.daily_resample(to_spark(spark, pdf), ["entity"], "hourutc", ["x"], how="sum").orderBy("dt").collect()
    assert [r.x for r in mean] == [1.0, None, 3.0] and [r.x for r in total] == [1.0, 0.0, 3.0]


def test_duplicates_and_latest(spark, hourly):
    df = hourly([(0, 1.0), (0, 2.0), (1, 3.0)]).withColumn("n", -F.col("x"))
    kept = windows.dedupe_first(df, ["entity"], "hourutc", ["n"]).orderBy("hourutc").collect()
    assert [r.x for r in kept] == [2.0, 3.0]
    assert windows.latest_row(df, ["entity"], "hourutc").collect()[0].x == 3.0


def test_series_before_1970(spark):
    pdf = pd.DataFrame({"entity": "a", "hourutc": pd.date_range("1969-12-30", periods=72, freq="h"), "x": np.where(np.arange(72) % 10 == 0, np.arange(72.0), np.nan)})
    same(back(fill.impute_rolling(to_spark(spark, pdf), REGULAR, "x", 4), "x"), pdf.x.fillna(pdf.x.rolling(4, min_periods=1).mean().bfill()))


def test_series_without_keys(spark):
    pdf = random_table(lengths=(120,)).drop(columns="entity")
    df = to_spark(spark, pdf)
    got = fill.impute_rolling(df, Series((), "hourutc", chunk=9, regular=True), "x", 6).orderBy("hourutc").toPandas().x
    same(got.astype(float), pdf.x.fillna(pdf.x.rolling(6, min_periods=1).mean().bfill()))
    got = spectral.dct_smooth(df, Series((), "hourutc", chunk=9), "y", 5).count()
    assert got == 120
