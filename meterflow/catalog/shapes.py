"""Filters, joins and aggregates."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import sqrt_or_null
from ..operators import aggregates, correlate, filters, joins, profile
from ..plans import exchange as plan_exchange
from ..plans import ingest
from . import views
from .registry import by_user, query, r, rounded
from .views import MEASURES, SERIES, sql

CUTOFF = "2024-01-15 00:00:00"
EXCHANGES = ("x_no", "x_se", "x_nl", "x_ge")
R_EXCHANGES = ", ".join(r(c) for c in EXCHANGES)


@query("filter_entity", sql(f"select hourutc, entity, {r('v')} from series where entity = 2", "series"))
def filter_entity(t):
    return rounded(filters.of_entity(views.series(t).select("hourutc", "entity", "v"), entity=2), "v")


@query("filter_upto", f"select event_id, ts, value from events where ts <= timestamp '{CUTOFF}'")
def filter_upto(t):
    return filters.up_to(t.events.select("event_id", "ts", "value"), "ts", CUTOFF)


@query("filter_since", f"select event_id, ts, value from events where ts >= timestamp '{CUTOFF}'")
def filter_since(t):
    return filters.since(t.events.select("event_id", "ts", "value"), "ts", CUTOFF)


@query("time_slice", sql(f"select hourutc, area, {R_EXCHANGES} from exchange where hourutc = timestamp '{CUTOFF}'", "exchange"))
def time_slice(t):
    return rounded(filters.at_time(views.exchange(t), "hourutc", CUTOFF), *EXCHANGES)


@query("filter_missing", sql("select hourutc, entity, false as observed from series where v_view is null union all "
                             "select hourutc, entity, true from series where v_view is not null", "series"))
def filter_missing(t):
    rows = views.series(t).select("hourutc", "entity", "v_view")
    gone = filters.missing(rows, "v_view").select("hourutc", "entity", F.lit(False).alias("observed"))
    return gone.unionByName(filters.observed(rows, "v_view").select("hourutc", "entity", F.lit(True).alias("observed")))


@query("filter_isin", "select event_id, event_type, value from events where event_type in ('click', 'purchase')")
def filter_isin(t):
    return filters.among(t.events.select("event_id", "event_type", "value"), "event_type", ["click", "purchase"])


@query("filter_expr", "select event_id, event_type, value from events where event_type = 'signup' and value > 10")
def filter_expr(t):
    return filters.where(t.events.select("event_id", "event_type", "value"), "event_type = {kind} and value > {low}", {"kind": "signup", "low": 10})


@query("clip_to_range", """select l_orderkey, l_linenumber, l_shipdate from lineitem
    where l_shipdate >= (select min(o_orderdate) from orders) and l_shipdate <= (select max(o_orderdate) from orders)""")
def clip_to_range(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return correlate.clip_to_range(rows, "l_shipdate", t.orders, "o_orderdate")


@query("having_threshold", sql(f"""select entity, {r('pct')} from
    (select entity, avg(case when v_view is null then 1 else 0 end) * 100 as pct from series group by entity)
    where pct > 1 and pct < 100""", "series"))
def having_threshold(t):
    return rounded(profile.missing_pct_by_entity(views.series(t), "entity", "v_view", above=1, below=100), "pct")


@query("display_window", """select o_orderkey, o_orderdate, o_totalprice from orders
    where o_orderdate >= timestamp '1997-07-31' - interval 7 day and o_orderdate <= timestamp '1997-07-31' + interval 2 month""")
def display_window(t):
    return filters.display_window(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", "1997-07-31 00:00:00")


# Joins

@query("enrich_join", sql(f"""select hourutc, u.entity_no, branche, {r('consumption')}, area_name
    from usage u join areas a on u.entity_no = a.entity_no""", "usage", "areas"))
def enrich_join(t):
    return rounded(ingest.enrich(views.usage(t), views.areas(t), "entity_no", "entity_no", "area_name"), "consumption")


@query("enrich_orders", "select o_orderkey, o_custkey, o_totalprice, c_name, c_nationkey from orders join customer on o_custkey = c_custkey")
def enrich_orders(t):
    """The same join with the facts of hot keys dealt out."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.join_dimension(rows, t.customer, "o_custkey", "c_custkey", ["c_name", "c_nationkey"], hot_share=0.01)


@query("align_series", sql(f"""select dt, {r('purchase', 4)}, {r('wspd')} from price full join
    (select cast(hourutc as date) as dt, avg(wspd) as wspd from wind group by 1) using (dt)""", "price", "wind"))
def align_series(t):
    daily = views.wind(t).groupBy(F.col("hourutc").cast("date").alias("dt")).agg(F.avg("wspd").alias("wspd"))
    both = correlate.align_series(views.price(t).select("dt", "purchase"), daily, ["dt"])
    return rounded(rounded(both, "purchase", digits=4), "wspd")


@query("scalar_broadcast", sql("""select hourutc, area, round(abs(x_no) / nullif((select max(abs(x_no)) from exchange), 0) + 1e-9, 6) + 0.0 as utilisation
    from exchange""", "exchange"))
def scalar_broadcast(t):
    rows = views.exchange(t).select("hourutc", "area", "x_no")
    beside = joins.with_scalars(rows, rows.agg(F.max(F.abs("x_no")).alias("largest")))
    return rounded(beside.select("hourutc", "area", F.try_divide(F.abs("x_no"), "largest").alias("utilisation")), "utilisation")


@query("pair_endog_exog", sql(f"""select s.hourutc, s.entity, {r('v')}, {r('consumption')} from series s
    join (select hourutc, entity_no as entity, sum(consumption) as consumption from usage group by 1, 2) u
    on s.hourutc = u.hourutc and s.entity = u.entity""", "series", "usage"))
def pair_endog_exog(t):
    load = views.usage(t).groupBy("hourutc", F.col("entity_no").alias("entity")).agg(F.sum("consumption").alias("consumption"))
    paired = correlate.pair_endog_exog(views.series(t).select("hourutc", "entity", "v"), load, ["hourutc", "entity"], ["consumption"])
    return rounded(paired, "v", "consumption")


# Aggregates

@query("net_exchange", sql(f"select hourutc, {r('x_no')} from (select hourutc, coalesce(sum(x_no), 0) as x_no from exchange group by 1)", "exchange"))
def net_exchange(t):
    return rounded(aggregates.sum_by(views.exchange(t), ["hourutc"], ["x_no"]), "x_no")


_BY_HOUR = "(select hourutc, " + ", ".join(f"coalesce(sum({c}), 0) as {c}" for c in EXCHANGES) + " from exchange group by 1)"


@query("exchange_by_hour", sql(f"select hourutc, {R_EXCHANGES} from {_BY_HOUR}", "exchange"))
def exchange_by_hour(t):
    return rounded(plan_exchange.exchange_by_hour(views.exchange(t), "hourutc", EXCHANGES), *EXCHANGES)


_HOWS = {"sum": "sum", "mean": "avg", "min": "min", "max": "max", "count": "count", "std": "stddev_samp", "median": "median"}


@query("summary_by_group", sql(" union all ".join(
    f"select '{how}' as how, branche, round(cast({fn}(consumption) as double) + 1e-9, 4) + 0.0 as consumption from usage group by branche"
    for how, fn in _HOWS.items()), "usage"))
def summary_by_group(t):
    wide = aggregates.summaries_by_group(views.usage(t), "branche", "consumption", list(_HOWS))
    each = F.explode(F.array(*[F.struct(F.lit(how).alias("how"), F.col(how).cast("double").alias("consumption")) for how in _HOWS])).alias("e")
    return rounded(wide.select("branche", each).select("e.how", "branche", "e.consumption"), "consumption", digits=4)


@query("summary_two_level", sql(f"select branche, entity_no, {r('consumption', 4)} from (select branche, entity_no, sum(consumption) as consumption from usage group by 1, 2)", "usage"))
def summary_two_level(t):
    return rounded(aggregates.summary_two_level(views.usage(t), "branche", "entity_no", "consumption"), "consumption", digits=4)


@query("summary_grouping_sets", sql(f"""select branche, entity_no, {r('consumption', 4)}, all_branche, all_entity_no from
    (select branche, entity_no, sum(consumption) as consumption, cast(grouping(branche) as integer) as all_branche,
        cast(grouping(entity_no) as integer) as all_entity_no
     from usage group by grouping sets ((branche, entity_no), (branche), (entity_no)))""", "usage"))
def summary_grouping_sets(t):
    return rounded(aggregates.summary_grouping_sets(views.usage(t), "branche", "entity_no", "consumption"), "consumption", digits=4)


@query("distinct_sorted", "select distinct o_custkey from orders order by 1")
def distinct_sorted(t):
    return aggregates.distinct_sorted(t.orders, "o_custkey")


def _missing_sql(keys: str = "") -> str:
    group = f"group by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return " union all ".join(
        f"select {lead}'{c}' as \"column\", count(*) - count({c}) as num, (count(*) - count({c})) / count(*) as pct from series {group} having count(*) > count({c})"
        for c in MEASURES)


@query("missing_profile", sql(f"select \"column\", num, {r('pct')} from ({_missing_sql()})", "series"))
def missing_profile(t):
    return rounded(profile.missing_profile(views.series(t)), "pct")


@query("missing_profile_by_entity", sql(f"select entity, \"column\", num, {r('pct')} from ({_missing_sql('entity')})", "series"))
def missing_profile_by_entity(t):
    return rounded(profile.missing_profile(views.series(t), ["entity"], MEASURES), "pct")


_PCT = "avg(case when {c} is null then 1 else 0 end) * 100"


@query("missing_pct_by_entity", sql(f"select entity, {r('pct')} from (select entity, {_PCT.format(c='v')} as pct from series group by entity) where pct > 0", "series"))
def missing_pct_by_entity(t):
    return rounded(profile.missing_pct_by_entity(views.series(t), "entity", "v"), "pct")


@query("missing_pct_matrix", sql(f"select entity, \"column\", {r('pct')} from (" + " union all ".join(
    f"select entity, '{c}' as \"column\", {_PCT.format(c=c)} as pct from series group by entity" for c in MEASURES) + ") where pct > 0", "series"))
def missing_pct_matrix(t):
    return rounded(profile.missing_pct_matrix(views.series(t), "entity", MEASURES), "pct")


@query("entities_with_missing", sql("""select distinct entity, true as missing from series where v is null
    union all select distinct entity, false from series where v is not null""", "series"))
def entities_with_missing(t):
    rows = views.series(t)
    gone = profile.entities_with_missing(rows, "entity", "v").withColumn("missing", F.lit(True))
    return gone.unionByName(profile.entities_observed(rows, "entity", "v").withColumn("missing", F.lit(False)))


@query("coverage_ratio", "select count(*) filter (event_type = 'click') / nullif(count(*) filter (event_type = 'view'), 0) as ratio from events")
def coverage_ratio(t):
    return aggregates.coverage_ratio(t.events, "event_type", "click", "view")


@query("first_observed", sql("""select entity, first_time, row_number() over (order by first_time, entity) as ordinal
    from (select entity, min(hourutc) as first_time from series where v_error is not null group by entity)""", "series"))
def first_observed(t):
    return aggregates.first_observed(views.series(t), SERIES, "v_error")


@query("first_order", """select o_custkey, first_time, row_number() over (order by first_time, o_custkey) as ordinal
    from (select o_custkey, min(o_orderdate) as first_time from orders where o_totalprice is not null group by o_custkey)""")
def first_order(t):
    """The same over many entities."""
    return aggregates.first_observed(t.orders, views.Series(("o_custkey",), "o_orderdate"), "o_totalprice")


@query("abs_maxima", sql("select " + ", ".join(f"round(max(abs({c})) + 1e-9, 6) as {c}" for c in EXCHANGES) + f" from {_BY_HOUR}", "exchange"))
def abs_maxima(t):
    hourly = plan_exchange.exchange_by_hour(views.exchange(t), "hourutc", EXCHANGES)
    return rounded(aggregates.abs_maxima(hourly, EXCHANGES), *EXCHANGES)


@query("min_max", 'select min(l_shipdate) as "min", max(l_shipdate) as "max" from lineitem')
def min_max(t):
    return aggregates.min_max(t.lineitem, "l_shipdate")


@query("subset_count", "select count(*) as n from lineitem where l_returnflag = 'R' and l_quantity > 25")
def subset_count(t):
    return aggregates.subset_count(t.lineitem, (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25))


@query("sqrt_scale", "select o_orderkey, round(case when o_totalprice - 200000 >= 0 then sqrt(o_totalprice - 200000) end + 1e-9, 6) as scaled from orders")
def sqrt_scale(t):
    return rounded(t.orders.select("o_orderkey", sqrt_or_null(F.col("o_totalprice") - 200000).alias("scaled")), "scaled")


@query("random_series", sql("""select entity, hourutc, 'MEASURE' as measure, round(MEASURE + 1e-9, 6) + 0.0 as value from series
    where entity = (select arg_min(entity, md5('591301' || cast(entity as varchar))) from series)""".replace(
    "MEASURE", min(MEASURES, key=lambda c: __import__("hashlib").md5(f"591301{c}".encode()).hexdigest())), "series"))
def random_series(t):
    return rounded(aggregates.random_series(views.series(t), "entity", "hourutc", MEASURES, 591301), "value")


# Exchange

_COUNTRY = {"Norway": "x_no", "Sweden": "x_se", "Netherlands": "x_nl", "Germany": "x_ge"}
_UTILISATION = " union all ".join(
    f"""select hourutc, '{k}' as country, {c} as exchange, max(abs({c})) over (order by hourutc rows unbounded preceding) as capacity from {_BY_HOUR}"""
    for k, c in _COUNTRY.items())


@query("exchange_utilisation", sql(f"""select hourutc, country, {r('exchange')}, {r('capacity')}, round(abs(exchange) + 1e-9, 6) as used,
    round(capacity - abs(exchange) + 1e-9, 6) + 0.0 as remaining, case when exchange >= 0 then 'Export' else 'Import' end as direction,
    round(abs(exchange) / nullif(capacity, 0) + 1e-9, 6) as utilisation from ({_UTILISATION})""", "exchange"))
def exchange_utilisation(t):
    used = plan_exchange.exchange_utilisation(views.exchange(t), "hourutc", _COUNTRY)
    return rounded(used, "exchange", "capacity", "used", "remaining", "utilisation")


@query("exchange_labels", sql(f"""select hourutc, country,
    printf('%s: %.1f MWh', case when exchange >= 0 then 'Export' else 'Import' end, round(abs(exchange) + 1e-9, 6)) as used_label,
    printf('Unused: %.1f MWh', round(capacity - abs(exchange) + 1e-9, 6)) as unused_label from ({_UTILISATION})""", "exchange"))
def exchange_labels(t):
    used = rounded(plan_exchange.exchange_utilisation(views.exchange(t), "hourutc", _COUNTRY), "used", "remaining")
    return plan_exchange.exchange_labels(used).select("hourutc", "country", "used_label", "unused_label")


_CITIES = """(values ('Norway', 'Oslo', 59.9139e0, 10.7522e0), ('Sweden', 'Stockholm', 59.3327e0, 18.0656e0), ('Netherlands', 'Amsterdam', 52.3676e0, 4.9041e0),
    ('Germany', 'Berlin', 52.52e0, 13.405e0), ('Denmark', 'Copenhagen', 55.6761e0, 12.5683e0), ('Great Britain', 'London', 51.5072e0, 0.1276e0)) c(country, city, lat, lon)"""


@query("exchange_map", sql(f"""select country, city, lat, lon, hourutc, {r('exchange')}, {r('capacity')}, round(abs(exchange) + 1e-9, 6) as used,
    case when exchange is null then null when exchange >= 0 then 'Export' else 'Import' end as direction, round(abs(exchange) / nullif(capacity, 0) + 1e-9, 6) as utilisation
    from {_CITIES} left join (select * from ({_UTILISATION}) where hourutc = timestamp '{CUTOFF}') using (country)""", "exchange"))
def exchange_map(t):
    rows = plan_exchange.exchange_map(views.exchange(t), "hourutc", CUTOFF, _COUNTRY).drop("remaining")
    return rounded(rows, "exchange", "capacity", "used", "utilisation")


@query("country_dim", sql(f"""select country, city, lat, lon, round(total + 1e-9, 4) + 0.0 as total from
    {_CITIES}
    left join ({' union all '.join(f"select '{k}' as country, sum({c}) as total from exchange" for k, c in _COUNTRY.items())}) using (country)""", "exchange"))
def country_dim(t):
    sums = views.exchange(t).agg(*[F.sum(c).alias(c) for c in EXCHANGES])
    entries = F.explode(F.array(*[F.struct(F.lit(k).alias("country"), F.col(c).alias("total")) for k, c in _COUNTRY.items()])).alias("e")
    totals = sums.select(entries).select("e.*")
    countries = plan_exchange.country_dim(t.spark).select("country", "city", "lat", "lon")
    return rounded(countries.join(totals, "country", "left"), "total", digits=4)


by_user("missing_pct_matrix")
