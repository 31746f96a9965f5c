"""Window operators, smoothing, correlation, imputation, dashboard frames."""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import fill, resample, spectral, windows
from ..operators.fill import Rule
from ..operators.layout import Series
from ..plans import correlation, imputation
from ..plans import views as dashboard
from . import views
from .registry import by_user, query, r, rounded
from .shapes import CUTOFF
from .views import MEASURES, SERIES, Tables, sql

IRREGULAR = SERIES.over(regular=False)
CHUNKED = SERIES.over(regular=False, chunk=72)
WIDE = SERIES.over(chunk=336)


def _over(frame: str, order: str = "hourutc") -> str:
    return f"over (partition by entity order by {order} rows between {frame})"


PAST, REST = "unbounded preceding and current row", "current row and unbounded following"


@query("forward_fill", sql(f"select entity, hourutc, round(last_value(v_view ignore nulls) {_over(PAST)} + 1e-9, 6) + 0.0 as v_view from series", "series"))
def forward_fill(t):
    return rounded(fill.forward_fill(views.series(t).select("entity", "hourutc", "v_view"), views.layout(t, SERIES), "v_view"), "v_view")


@query("backward_fill", sql(f"select entity, hourutc, round(first_value(v_view ignore nulls) {_over(REST)} + 1e-9, 6) + 0.0 as v_view from series", "series"))
def backward_fill(t):
    return rounded(fill.backward_fill(views.series(t).select("entity", "hourutc", "v_view"), SERIES, "v_view"), "v_view")


@query("rolling_mean", sql(f"select entity, hourutc, round(avg(v) {_over('23 preceding and current row')} + 1e-9, 6) + 0.0 as rolling from series", "series"))
def rolling_mean(t):
    rows = fill.rolling_mean(views.series(t).select("entity", "hourutc", "v"), SERIES, "v", 24)
    return rounded(rows.select("entity", "hourutc", "rolling"), "rolling")


@query("rolling_mean_irregular", sql(f"select entity, hourutc, round(avg(v) {_over('167 preceding and current row')} + 1e-9, 6) + 0.0 as rolling from readings", "readings"))
def rolling_mean_irregular(t):
    """Row frames over series of times at no grid: counted positions instead of step numbers."""
    return rounded(fill.rolling_mean(views.readings(t), CHUNKED, "v", 168).select("entity", "hourutc", "rolling"), "rolling")


def _impute_sql(c: str, window: int, source: str = "series", keep: str = "") -> str:
    """Rolling mean, then back-fill of that mean, as two steps."""
    return f"""select entity, hourutc, {keep} {c}, first_value(m ignore nulls) {_over(REST)} as f,
        avg(case when {c} is null then 1 else 0 end) over (partition by entity) * 100 as pct
        from (select *, avg({c}) {_over(f'{window - 1} preceding and current row')} as m from {source})"""


@query("impute_rolling", sql(f"select entity, hourutc, round(coalesce(v, f) + 1e-9, 6) + 0.0 as v from ({_impute_sql('v', 24)})", "series"))
def impute_rolling(t):
    return rounded(fill.impute_rolling(views.series(t).select("entity", "hourutc", "v"), views.layout(t, SERIES), "v"), "v")


@query("impute_threshold", sql(f"select entity, hourutc, round(case when pct < 40 then coalesce(v_view, f) else v_view end + 1e-9, 6) + 0.0 as v_view from ({_impute_sql('v_view', 24)})", "series"))
def impute_threshold(t):
    return rounded(fill.impute_threshold(views.series(t).select("entity", "hourutc", "v_view"), views.layout(t, SERIES), "v_view"), "v_view")


_GAPS = """(select entity, rn - rk as run, min(hourutc) as start_time, max(hourutc) as end_time, count(*) as gap_length_records,
        min(rn) - 1 as start_index, max(rn) - 1 as end_index
    from (select *, row_number() over (partition by entity order by hourutc) as rk
          from (select *, row_number() over (partition by entity order by hourutc) as rn from series) where v_view is null)
    group by entity, rn - rk)"""


@query("find_gaps", sql(f"""select entity, start_time, end_time, date_diff('second', start_time, end_time) as duration_s,
    round(date_diff('second', start_time, end_time) / 86400e0 + 1e-9, 6) as duration_days, gap_length_records, start_index, end_index from {_GAPS}""", "series"))
def find_gaps(t):
    gaps = windows.find_gaps(views.series(t), views.layout(t, SERIES), "v_view")
    return rounded(gaps.withColumn("duration_s", F.col("duration").cast("bigint")).drop("duration"), "duration_days")


@query("gap_summary", sql(f"select entity, count(*) as gaps, max(gap_length_records) as max_gap, round(avg(gap_length_records) + 1e-9, 6) as mean_gap from {_GAPS} group by entity", "series"))
def gap_summary(t):
    return rounded(windows.gap_summary(views.series(t), SERIES, "v_view"), "mean_gap")


@query("lag_backfill", sql(f"""select entity, hourutc, round(first_value(x ignore nulls) {_over(REST)} + 1e-9, 6) + 0.0 as lagged
    from (select *, lag(v_view, 100) over (partition by entity order by hourutc) as x from series)""", "series"))
def lag_backfill(t):
    rows = windows.lag_backfill(views.series(t).select("entity", "hourutc", "v_view"), SERIES, "v_view", 100)
    return rounded(rows.select("entity", "hourutc", "lagged"), "lagged")


def _corr_sql(x: str, y: str, width: int, partition: str, order: str, source: str, keep: str) -> str:
    over = f"over ({partition} order by {order} rows between {width // 2} preceding and {(width - 1) // 2} following)"
    both = f"case when {x} is not null and {y} is not null then"
    return f"""select {keep}, round(case when n = {width} and vx > 0 and vy > 0 then cov / (sqrt(vx) * sqrt(vy)) end + 1e-9, 6) + 0.0 as corr from
        (select *, count({both} 1 end) {over} as n, var_pop({both} {x} end) {over} as vx, var_pop({both} {y} end) {over} as vy,
         covar_pop({x}, {y}) {over} as cov from {source})"""


@query("sliding_corr", sql(_corr_sql("v", "v_view", 8, "partition by entity", "hourutc", "series", "entity, hourutc"), "series"))
def sliding_corr(t):
    from ..operators.correlate import sliding_corr as corr
    rows = corr(views.series(t).select("entity", "hourutc", "v", "v_view"), SERIES, "v", "v_view", 8)
    return rounded(rows.select("entity", "hourutc", "corr"), "corr")


def _calendar(source: str, keys: str, how: str = "day", cast: str = "date") -> str:
    lead = f"{keys}, " if keys else ""
    group = f"group by {keys}" if keys else ""
    return f"(select {lead}cast(unnest(generate_series(min(dt), max(dt), interval 1 {how})) as {cast}) as dt from {source} {group})"


@query("daily_resample", f"""with daily as (select l_suppkey as entity, cast(l_shipdate as date) as dt, avg(l_quantity) as wspd from lineitem group by 1, 2)
    select entity, dt, round(wspd + 1e-9, 6) as wspd from {_calendar('daily', 'entity')} left join daily using (entity, dt)""")
def daily_resample(t):
    """By supplier, whose shipments leave most days out."""
    rows = t.lineitem.select(F.col("l_suppkey").alias("entity"), F.col("l_shipdate").alias("hourutc"), F.col("l_quantity").alias("wspd"))
    return rounded(resample.daily_resample(rows, ["entity"], "hourutc", ["wspd"]), "wspd")


@query("daily_mean_by_entity", sql("select entity, dt, " + ", ".join(r(c) for c in MEASURES) + " from (select entity, cast(hourutc as date) as dt, "
                                   + ", ".join(f"avg({c}) as {c}" for c in MEASURES) + " from series group by 1, 2)", "series"))
def daily_mean_by_entity(t):
    return rounded(resample.daily_mean_by_entity(views.series(t), "entity", "hourutc"), *MEASURES)


@query("asfreq_ffill", sql(f"""select g.entity, g.dt as hourutc, round(s.v + 1e-9, 6) + 0.0 as v
    from {_calendar('(select entity, hourutc as dt from readings)', 'entity', 'hour', 'timestamp')} g
    asof join readings s on g.entity = s.entity and g.dt >= s.hourutc""", "readings"))
def asfreq_ffill(t):
    """Times at no grid, put on the one that starts at each series' first."""
    return rounded(resample.asfreq_ffill(views.readings(t), SERIES), "v")


@query("dedupe_first", """select l_shipdate, l_returnflag, l_orderkey, l_linenumber, l_extendedprice from
    (select *, row_number() over (partition by l_returnflag, l_shipdate order by l_orderkey, l_linenumber, l_extendedprice) as rn from lineitem) where rn = 1""")
def dedupe_first(t):
    rows = t.lineitem.select("l_shipdate", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return windows.dedupe_first(rows, ["l_returnflag"], "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("running_abs_max", sql(f"select area, hourutc, round(max(abs(x_no)) over (partition by area order by hourutc rows unbounded preceding) + 1e-9, 6) as max_x_no from exchange", "exchange"))
def running_abs_max(t):
    rows = windows.running_abs_max(views.exchange(t).select("area", "hourutc", "x_no"), Series(("area",), "hourutc", chunk=168), "x_no")
    return rounded(rows.select("area", "hourutc", "max_x_no"), "max_x_no")


@query("minmax_by_time", sql("""select entity, hourutc, round((v - lo) / nullif(hi - lo, 0) + 1e-9, 6) + 0.0 as normalized from
    (select *, min(v) over (partition by hourutc) as lo, max(v) over (partition by hourutc) as hi from series)""", "series"))
def minmax_by_time(t):
    rows = windows.minmax_by_time(views.series(t).select("entity", "hourutc", "v"), "hourutc", "v")
    return rounded(rows.select("entity", "hourutc", "normalized"), "normalized")


@query("latest_row", sql(f"select entity, hourutc, {r('v')}, {r('v_view')} from series qualify row_number() over (partition by entity order by hourutc desc) = 1", "series"))
def latest_row(t):
    return rounded(windows.latest_row(views.series(t).select("entity", "hourutc", "v", "v_view"), ["entity"], "hourutc"), "v", "v_view")


@query("series_position", """select o_custkey, o_orderdate, o_orderkey,
    row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as position from orders""")
def series_position(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return windows.series_position(rows, Series(("o_custkey",), "o_orderdate", step=timedelta(days=1), chunk=90), tie=["o_orderkey"])


def _dct_ctes(prefix: str, source: str, key: str, order: str, x: str, cutoff: int) -> str:
    part = f"partition by {key}" if key else ""
    lead = f"{key}, " if key else ""
    using = f"using ({key})" if key else "on true"
    return f"""{prefix}p as (select *, row_number() over ({part} order by {order}) - 1 as n, count(*) over ({part}) as big, count({x}) over ({part}) as seen from {source}),
        {prefix}k as (select {lead}k, sum({x} * cos(pi() * k * (2 * n + 1) / (2 * big))) as c
            from {prefix}p, (select unnest(generate_series(0, {cutoff})) as k) where k < big and big = seen group by all),
        {prefix}s as (select p.*, s.smooth from {prefix}p p left join (
            select {'p.' + key + ', ' if key else ''}p.n, sum(case when k = 0 then c else 2 * c * cos(pi() * k * (2 * n + 1) / (2 * big)) end / big) as smooth
            from {prefix}p p join {prefix}k {using} group by all) s on {'p.' + key + ' = s.' + key + ' and ' if key else ''}p.n = s.n)"""


def _with(base: str, extra: str) -> str:
    """Add CTEs after those of ``base`` (a text ending in its last CTE)."""
    return f"{base.rstrip()}, {extra}"


@query("dct_smooth", _with(sql("", "series"), _dct_ctes("d", "series", "entity", "hourutc", "v", 10))
       + " select entity, hourutc, round(smooth + 1e-9, 6) + 0.0 as v_smooth from ds")
def dct_smooth(t):
    rows = spectral.dct_smooth(views.series(t).select("entity", "hourutc", "v"), SERIES, "v", 10)
    return rounded(rows.select("entity", "hourutc", "v_smooth"), "v_smooth")


# Price and wind

_DAILY_WIND = """dayw as (select cast(hourutc as date) as dt, avg(wspd) as wind from wind group by 1),
    fullw as (select dt, wind from (select cast(unnest(generate_series(min(dt), max(dt), interval 1 day)) as date) as dt from dayw) left join dayw using (dt)
              where dt between (select min(dt) from price) and (select max(dt) from price)),
    lagw as (select dt, {lagged} as wind_used from (select *, lag(wind, {lag}) over (order by dt) as x from fullw))"""
_BACKFILLED = "first_value(x ignore nulls) over (order by dt rows between current row and unbounded following)"


def _pair_sql(lag: int) -> str:
    return _DAILY_WIND.format(lag=lag, lagged=_BACKFILLED if lag else "wind")


@query("price_wind_corr", _with(sql("", "price", "wind"), _pair_sql(3))
       + _corr_sql("price", "wind_used", 7, "", "dt", "(select dt, purchase as price, wind_used from price full join lagw using (dt))",
                   "dt, round(price + 1e-9, 4) + 0.0 as price, round(wind_used + 1e-9, 6) + 0.0 as wind_used"))
def price_wind_corr(t):
    rows = correlation.price_wind_corr(views.price(t), "dt", "purchase", views.wind(t), "hourutc", "wspd", swc_width=7, lag=3)
    return rounded(rounded(rows, "price", digits=4), "wind_used", "corr")


@query("price_wind_corr_dct", _with(sql("", "price", "wind"), _pair_sql(0)) + ", "
       + _dct_ctes("pr_", "(select dt, purchase as price from price)", "", "dt", "price", 20) + ", " + _dct_ctes("wi_", "lagw", "", "dt", "wind_used", 20)
       + _corr_sql("price", "wind_used", 7, "", "dt", "(select dt, a.smooth as price, b.smooth as wind_used from pr_s a full join wi_s b using (dt))",
                   "dt, round(price + 1e-9, 4) + 0.0 as price, round(wind_used + 1e-9, 6) + 0.0 as wind_used"))
def price_wind_corr_dct(t):
    rows = correlation.price_wind_corr(views.price(t), "dt", "purchase", views.wind(t), "hourutc", "wspd", dct_filter=True, dct_cutoff=20)
    return rounded(rounded(rows, "price", digits=4), "wind_used", "corr")


@query("sync_daily", _with(sql("", "wind", "price"), "daily as (select cast(hourutc as date) as dt, avg(wspd) as wspd from wind where entity = 'R' group by 1)")
       + f""" select dt, round(wspd + 1e-9, 6) as wspd, {r('purchase', 4)} from {_calendar('daily', '')} left join daily using (dt) join price using (dt)""")
def sync_daily(t):
    rows = correlation.sync_daily(views.wind(t), views.price(t), "hourutc", "dt", "wspd", "purchase", "entity", "R")
    return rounded(rounded(rows, "wspd"), "purchase", digits=4)


@query("sync_hourly", sql(f"""select dt, wspd, {r('purchase', 4)} from
    (select cast(hourutc as date) as dt, wspd from wind where entity = 'R' and hourutc = cast(cast(hourutc as date) as timestamp)) join price using (dt)""", "wind", "price"))
def sync_hourly(t):
    rows = correlation.sync_daily(views.wind(t), views.price(t), "hourutc", "dt", "wspd", "purchase", "entity", "R", accum="none")
    return rounded(rows, "purchase", digits=4)


# Weather imputation: the fixture's measures under the rules of the weather table.

RULES = [
    Rule("v_view", "forward", entities=(2, 3)), Rule("v_purchase", "keep"), Rule("v_signup", window=24, entities=(0, 3)),
    Rule("v", window=24, max_missing_pct=40.0, whole=True), Rule("v_click", window=168, max_missing_pct=40.0),
    Rule("v_error", window=24, max_missing_pct=40.0)]


def _rolled(c: str, window: int) -> str:
    return f"avg({c}) {_over(f'{window - 1} preceding and current row')} as m_{c}"


def _gate(c: str) -> str:
    return f"avg(case when {c} is null then 1 else 0 end) over (partition by entity) * 100 < 40"


def _back(c: str) -> str:
    return f"coalesce({c}, first_value(m_{c} ignore nulls) {_over(REST)})"


@query("impute_weather", sql(f"""select entity, hourutc,
    round(case when entity in (2, 3) then last_value(v_view ignore nulls) {_over(PAST)} else v_view end + 1e-9, 6) + 0.0 as v_view,
    round(v_purchase + 1e-9, 6) + 0.0 as v_purchase, round(case when entity in (0, 3) then {_back('v_signup')} else v_signup end + 1e-9, 6) + 0.0 as v_signup,
    trunc(case when {_gate('v')} then {_back('v')} else v end) + 0.0 as v,
    round(case when {_gate('v_click')} then {_back('v_click')} else v_click end + 1e-9, 6) + 0.0 as v_click,
    round(case when {_gate('v_error')} then {_back('v_error')} else v_error end + 1e-9, 6) + 0.0 as v_error
    from (select *, {_rolled('v_signup', 24)}, {_rolled('v', 24)}, {_rolled('v_click', 168)}, {_rolled('v_error', 24)} from series)""", "series"))
def impute_weather(t):
    return rounded(imputation.impute_weather(views.series(t), views.layout(t, WIDE), RULES, MEASURES), *MEASURES)


# Dashboard frames

@query("latest_point", sql(f"""select entity, hourutc, {r('v')}, {r('v_view')} from series where hourutc <= timestamp '{CUTOFF}'
    qualify row_number() over (partition by entity order by hourutc desc) = 1""", "series"))
def latest_point(t):
    return rounded(dashboard.latest_point(views.series(t).select("entity", "hourutc", "v", "v_view"), SERIES, CUTOFF), "v", "v_view")


@query("map_slice", sql(f"""select hourutc, entity, round(value + 1e-9, 6) + 0.0 as value, round(scaled + 1e-9, 6) + 0.0 as scaled, round(scaled * 15 + 1e-9, 6) + 0.0 as marker, lat, lon from
    (select hourutc, entity, v as value, (v - min(v) over ()) / nullif(max(v) over () - min(v) over (), 0) as scaled from series where hourutc = timestamp '{CUTOFF}')
    join areas on entity = entity_no order by entity""", "series", "areas"))
def map_slice(t):
    rows = dashboard.map_slice(views.series(t), "hourutc", CUTOFF, "entity", "v", "weather", views.areas(t), "entity_no")
    return rounded(rows, "value", "scaled", "marker")


@query("map_slice_usage", sql(f"""select hourutc, entity_no, round(consumption + 1e-9, 6) as value, round(sqrt(consumption) + 1e-9, 6) as scaled, round(sqrt(consumption) * 0.05e0 + 1e-9, 6) as marker, lat, lon
    from usage join areas using (entity_no) where hourutc = timestamp '{CUTOFF}' and branche = 'view'""", "usage", "areas"))
def map_slice_usage(t):
    rows = dashboard.map_slice(views.usage(t), "hourutc", CUTOFF, "entity_no", "consumption", "consumption", views.areas(t), "entity_no", branche="view")
    return rounded(rows, "value", "scaled", "marker")


@query("line_view", _with(sql("", "series"), _dct_ctes("d", f"(select entity, hourutc, v from series where entity = 3 and hourutc <= timestamp '{CUTOFF}')", "entity", "hourutc", "v", 10))
       + " select entity, hourutc, round(v + 1e-9, 6) + 0.0 as v, round(smooth + 1e-9, 6) + 0.0 as smoothed_signal, hourutc = max(hourutc) over () as is_latest from ds")
def line_view(t):
    return rounded(dashboard.line_view(views.series(t), SERIES, CUTOFF, "v", 10, entity=3), "v", "smoothed_signal")


@query("dashboard_load", """select event_id, cast(ts as timestamp) as hourutc, event_type, value from events order by hourutc, event_id""")
def dashboard_load(t):
    stored = t.events.select("event_id", F.col("ts").alias("time"), "event_type", F.col("value").cast("string").alias("value"))
    tables = dashboard.dashboard_load({"weather": stored}, {"weather": ["hourutc", "event_id"]}, {"weather": ["value"]}, {"weather": {"time": "hourutc"}})
    return tables["weather"]


by_user("forward_fill", "impute_rolling", "impute_threshold", "impute_weather", "find_gaps")

# By user a measure is missing in most hours, which leaves no frame whole: an hour without events counts as 0.

_ZERO = "(select entity, hourutc, coalesce(v, 0) as v, coalesce(v_view, 0) as v_view from series)"


def _by_user_sql(text: str) -> str:
    return text.replace("least(user_id % 8, 3)", "user_id")


def _zero_filled(t):
    rows = views.series(t, kinds=("view",)).select("entity", "hourutc", "v", "v_view")
    return fill.fill_constant(rows, ["v", "v_view"], 0.0)


@query("user_sliding_corr", _by_user_sql(sql(_corr_sql("v", "v_view", 8, "partition by entity", "hourutc", _ZERO, "entity, hourutc"), "series")))
def user_sliding_corr(t):
    from ..operators.correlate import sliding_corr as corr
    return rounded(corr(_zero_filled(t := Tables(t.spark, t.folder, by_user=True)), views.layout(t), "v", "v_view", 8).select("entity", "hourutc", "corr"), "corr")


@query("user_dct_smooth", _by_user_sql(_with(sql("", "series"), _dct_ctes("d", _ZERO, "entity", "hourutc", "v", 10))
       + " select entity, hourutc, round(smooth + 1e-9, 6) + 0.0 as v_smooth from ds"))
def user_dct_smooth(t):
    return rounded(spectral.dct_smooth(_zero_filled(t := Tables(t.spark, t.folder, by_user=True)), views.layout(t), "v", 10).select("entity", "hourutc", "v_smooth"), "v_smooth")
