"""The given tables in the shape of measurement tables: Spark builds and SQL texts.

    series    entity x hour on a complete grid, with gaps      (weather, production)
    readings  entity x time at which an event came             (weather, off the grid)
    usage     entity x hour x branch                           (consumption)
    exchange  signed differences per area and hour             (settlement)
    price     one row per day                                  (gas prices)
    wind      many rows per day and entity                     (weather wind speed)
    areas     entity names and coordinates                     (municipalities)
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import hour_of
from ..operators.layout import Series
from ..operators.resample import on_calendar

KINDS = ("view", "click", "purchase", "signup", "error")
ROWS_PER_PART = 250_000
SERIES = Series(("entity",), "hourutc", chunk=168, regular=True)
MEASURES = ["v", *[f"v_{k}" for k in KINDS]]


class Tables:
    """The given tables, read lazily."""

    def __init__(self, spark: SparkSession, folder: str, by_user: bool = False):
        self.spark, self.folder, self.by_user = spark, folder, by_user

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def events(t: Tables, entity: Column | None = None) -> DataFrame:
    """Events with their hour and an entity; most events belong to one entity."""
    if entity is None:
        entity = F.col("user_id") if t.by_user else F.least(F.col("user_id") % 8, F.lit(3))
    return t.events.select(hour_of("ts").alias("hr"), entity.alias("entity"), "event_type", "value")


def series(t: Tables, entity: Column | None = None, kinds=KINDS) -> DataFrame:
    ev = events(t, entity)
    per_kind = [F.avg(F.when(F.col("event_type") == k, F.col("value"))).alias(f"v_{k}") for k in kinds]
    measured = ev.groupBy("entity", F.col("hr").alias("hourutc")).agg(F.avg("value").alias("v"), *per_kind)
    span = t.events.select(hour_of("ts").alias("hr"))
    return on_calendar(measured, ev.select("entity").distinct(), span.agg(F.min("hr")).scalar(), span.agg(F.max("hr")).scalar(), "hourutc")


def layout(t: Tables, s: Series = SERIES) -> Series:
    """How the series are laid out: by user in as many parts as their rows ask for, so that a task's share does not grow with the table."""
    if not t.by_user:
        return s
    hours = F.timestamp_diff("HOUR", F.min(hour_of("ts")), F.max(hour_of("ts")))
    users, hours = t.events.agg(F.approx_count_distinct("user_id"), hours).first()
    rows = (users or 0) * ((hours or 0) + 1)
    return s.over(parts=max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_PART))


def readings(t: Tables) -> DataFrame:
    """Each user's values at the times they came, on no grid."""
    return t.events.groupBy(F.col("user_id").alias("entity"), F.col("ts").alias("hourutc")).agg(F.avg("value").alias("v"))


def usage(t: Tables) -> DataFrame:
    code = F.when(F.col("entity") == 3, F.lit(999)).otherwise(F.col("entity")).cast("bigint")
    return events(t).groupBy(F.col("hr").alias("hourutc"), code.alias("entity_no"), F.col("event_type").alias("branche")).agg(
        F.sum("value").alias("consumption"))


def exchange(t: Tables) -> DataFrame:
    v = {k: F.col(f"v_{k}") for k in KINDS}
    return series(t).select(
        "hourutc", F.col("entity").alias("area"),
        (v["view"] - v["click"]).alias("x_no"), (v["click"] - v["purchase"]).alias("x_se"),
        (v["purchase"] - v["signup"]).alias("x_nl"), (v["signup"] - v["error"]).alias("x_ge"))


def price(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("dt")).agg(
        F.avg("o_totalprice").alias("purchase"), (F.avg("o_totalprice") * 0.9).alias("sales"))


def wind(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_shipdate").alias("hourutc"), F.col("l_returnflag").alias("entity"), F.col("l_quantity").alias("wspd"))


def areas(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("entity_no"), F.col("n_name").alias("area_name"), F.col("r_name").alias("region"),
        (F.col("n_nationkey") * 1.5).alias("lat"), (F.col("n_nationkey") * 0.5).alias("lon"))


_PER_KIND = ", ".join(f"avg(value) filter (event_type = '{k}') as v_{k}" for k in KINDS)

SQL = {
    "ev": """ev as (select cast(date_trunc('hour', ts) as timestamp) as hr, least(user_id % 8, 3) as entity, event_type, value
                    from events)""",
    "series": f"""measured as (select entity, hr as hourutc, avg(value) as v, {_PER_KIND} from ev group by entity, hr),
        grid as (select entity, unnest(generate_series(lo, hi, interval 1 hour)) as hourutc
                 from (select distinct entity from ev), (select min(hr) as lo, max(hr) as hi from ev)),
        series as (select g.entity, g.hourutc, m.* exclude (entity, hourutc)
                   from grid g left join measured m on g.entity = m.entity and g.hourutc = m.hourutc)""",
    "readings": "readings as (select user_id as entity, cast(ts as timestamp) as hourutc, avg(value) as v from events group by 1, 2)",
    "usage": """usage as (select hr as hourutc, cast(case when entity = 3 then 999 else entity end as bigint) as entity_no,
                event_type as branche, sum(value) as consumption from ev group by all)""",
    "exchange": """exchange as (select hourutc, entity as area, v_view - v_click as x_no, v_click - v_purchase as x_se,
                   v_purchase - v_signup as x_nl, v_signup - v_error as x_ge from series)""",
    "price": """price as (select cast(o_orderdate as date) as dt, avg(o_totalprice) as purchase, avg(o_totalprice) * 0.9e0 as sales
                from orders group by 1)""",
    "wind": "wind as (select l_shipdate as hourutc, l_returnflag as entity, l_quantity as wspd from lineitem)",
    "areas": """areas as (select n_nationkey as entity_no, n_name as area_name, r_name as region, n_nationkey * 1.5e0 as lat,
                n_nationkey * 0.5e0 as lon from nation join region on n_regionkey = r_regionkey)""",
}
_NEEDS = {"series": ("ev",), "usage": ("ev",), "exchange": ("ev", "series")}


def sql(text: str, *views: str) -> str:
    """Put the named views in front of a query."""
    order = []
    for v in views:
        order += [w for w in (*_NEEDS.get(v, ()), v) if w not in order]
    return f"with {', '.join(SQL[v] for v in order)} {text}" if order else text
