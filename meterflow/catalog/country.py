"""The whole way of the project on tables made of the given ones: landed payloads, stored tables, the weather rules, the dashboard's six frames."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import fill
from ..plans import imputation, ingest
from ..plans import views as dashboard
from ..sources import schemas
from ..sources.storage import new_folder
from ..sources.store import read_store, write_store
from ..sources.tables import read_documents, read_table, write_table
from . import views
from .ordered import PAST, REST, _over, _rolled
from .registry import query, rounded
from .views import SERIES, Tables, sql

# Where the measures of the stored tables come from: expressions over the hourly series, the same in both engines.
PRODUCTION = dict(zip(schemas.PRODUCTION_MEASURES, ("v_view", "v_click", "v", "v_signup", "v_error")))
SETTLEMENT = dict(zip((*schemas.SETTLEMENT_MEASURES, *schemas.EXCHANGE_MEASURES), ("x_no", "x_se", "x_nl", "x_ge") * 5))
PRICES = dict(zip(schemas.PRICE_MEASURES, ("purchase", "sales", "purchase - 1", "sales + 1")))
WEATHER = dict(zip(schemas.WEATHER_MEASURES, ("v", "v_view", "v_click", "v_purchase", "v_signup", "v_error", "v_view + 1", "v_click + 1", "v_signup + 1", "v_error + 1", "v + 1")))
NAMES = ("Ærø", "Billund", "Odense", "Nowhere")  # two of the areas filled by name, one of each list at least, and one of none
_NAME = "case entity " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(NAMES)) + " end"
_AREAS = "concat('area ', area_name)"


def _payload(rows: DataFrame, folder: str, texts: dict[str, str], measures: dict[str, str]) -> None:
    """Land rows as one document, its fields in upper case and times as text."""
    fields = [F.expr(e).cast("string").alias(n.upper()) for n, e in texts.items()] + [F.expr(e).cast("double").alias(n.upper()) for n, e in measures.items()]
    lines = rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"), F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumn("value", F.concat(F.col("value"), F.lit(",")))
    head = rows.sparkSession.range(1).select(F.lit('{"total": 0, "records": [').alias("value"), F.lit(-1).cast("bigint").alias("at"))
    # A last entry that is no object ends the array without a comma.
    tail = rows.sparkSession.range(1).select(F.lit("null]}").alias("value"), F.lit((1 << 63) - 1).alias("at"))
    head.unionAll(lines).unionAll(tail).repartition(1).sortWithinPartitions("at").select("value").write.text(folder)


def _page(t: Tables) -> DataFrame:
    """A page with the table of areas."""
    head = "".join(f"<th>{n}</th>" for n in ("LAU-1 code <sup>1</sup>", "Municipality", "Administrative Center", "Total Area (km²)", "Population (2012-01-01)", "Region"))
    cells = [F.expr(e).cast("string") for e in ("entity_no", _AREAS, "region", "lat", "format_number(entity_no * 1000, 0)", "region")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    body = views.areas(t).agg(F.concat_ws("", F.sort_array(F.collect_list(row))).alias("body"))
    return body.select(F.concat(F.lit(f'<table class="{schemas.AREA_TABLE_CLASS}"><tr>{head}</tr>'), "body", F.lit("</table>")).alias("html"))


def _stored(t: Tables) -> str:
    """The five ingested datasets."""
    landing, base = new_folder(t.spark, "landing"), new_folder(t.spark, "country")
    hours = {"hourutc": "date_format(hourutc, \"yyyy-MM-dd'T'HH:mm:ss\")", "hourdk": "date_format(hourutc + interval 1 hour, \"yyyy-MM-dd'T'HH:mm:ss\")"}
    _payload(views.series(t), f"{landing}/production", {**hours, "municipalityno": "entity"}, PRODUCTION)
    _payload(views.usage(t), f"{landing}/consumption", {**hours, "municipalityno": "entity_no", "branche": "branche"}, {"consumptionkwh": "consumption"})
    _payload(views.exchange(t), f"{landing}/prodcons", {**hours, "pricearea": "concat('DK', area)"}, SETTLEMENT)
    _payload(views.price(t), f"{landing}/gas", {"gasday": "concat(cast(dt as string), 'T00:00:00')"}, PRICES)
    ingest.ingest_all(t.spark, landing, _page(t), base, "dk")
    return base


def _long(df: DataFrame, dataset: str, key: str, label: str, at: str, measures) -> DataFrame:
    """One row per measure and row of a table."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("name"), F.col(m).cast("double").alias("value")) for m in measures])).alias("_m")
    kept: list[Column] = [F.lit(dataset).alias("dataset"), F.expr(key).cast("string").alias("key"), F.expr(label).cast("string").alias("label"), F.expr(at).cast("timestamp_ntz").alias("at")]
    return rounded(df.select(*kept, values).select("dataset", "key", "label", "at", "_m.*"), "value", digits=4)


def _long_sql(source: str, dataset: str, key: str, label: str, at: str, measures: dict[str, str]) -> str:
    values = ", ".join(f"{{'name': '{n}', 'value': ({e})::double}}" for n, e in measures.items())
    return f"""select dataset, key, label, "at", m.name as name, round(m.value + 1e-9, 4) + 0.0 as value from (select '{dataset}' as dataset, ({key})::varchar as key,
        ({label})::varchar as label, ({at})::timestamp as "at", unnest([{values}]) as m from {source})"""


_AREA_VALUES = {"totalArea_km2": "lat", "population": "entity_no * 1000"}
_INGESTED = [
    _long_sql("series", "production", "entity", "hourutc + interval 1 hour", "hourutc", PRODUCTION),
    _long_sql("usage", "consumption", "entity_no", "branche", "hourutc", {"consumptionkwh": "consumption"}),
    _long_sql("exchange", "prodcons", "concat('DK', area)", "hourutc + interval 1 hour", "hourutc", SETTLEMENT),
    _long_sql("price", "gas", "null", "null", "dt", PRICES),
    _long_sql("areas", "municipalities", "entity_no", f"concat({_AREAS}, ':', region, ':', region)", "null", _AREA_VALUES)]


@query("ingest_all", sql(" union all ".join(_INGESTED), "series", "usage", "exchange", "price", "areas"))
def ingest_all(t):
    base = _stored(t)
    table = lambda name: read_table(t.spark, base, name, "dk")
    documents = lambda name: read_documents(t.spark, base, name, "dk", schemas.STORED[name])
    parts = [_long(table("production"), "production", "municipalityno", "hourdk", "hourutc", PRODUCTION),
             _long(table("consumption"), "consumption", "municipalityno", "branche", "hourutc", ["consumptionkwh"]),
             _long(table("prodcons"), "prodcons", "pricearea", "hourdk", "hourutc", SETTLEMENT),
             _long(documents("gas"), "gas", "null", "null", "gasday", PRICES),
             _long(documents("municipalities"), "municipalities", "municipalityNo", "concat(municipality, ':', adminCenter, ':', region)", "null", _AREA_VALUES)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]).unionAll(parts[4])


def _weather(t: Tables) -> DataFrame:
    return views.series(t).select(F.col("hourutc").alias("time"), F.expr(_NAME).alias("municipality"), *[F.expr(e).alias(m) for m, e in WEATHER.items()], F.lit(1.0).alias("dist_to_station"))


@query("dashboard_tables", sql(" union all ".join([
    _long_sql(f"(select s.*, {_AREAS} as municipality from series s join areas on entity = entity_no)", "production", "entity", "municipality", "hourutc", PRODUCTION),
    _long_sql(f"(select u.*, concat(branche, ':', {_AREAS}) as label from usage u join areas using (entity_no))", "consumption", "entity_no", "label", "hourutc", {"consumptionkwh": "consumption"}),
    _INGESTED[2], _INGESTED[3], _INGESTED[4], _long_sql("series", "weather", _NAME, "null", "hourutc", WEATHER)]), "series", "usage", "exchange", "price", "areas"))
def dashboard_tables(t):
    """All six tables as the dashboard loads them, production and consumption written back with the names of their areas."""
    base = _stored(t)
    write_table(_weather(t), base, "weather", "dk")
    areas = read_documents(t.spark, base, "municipalities", "dk", schemas.STORED["municipalities"])
    for name in ("production", "consumption"):
        ingest.enrich_writeback(t.spark, base, name, "dk", areas, "municipalityno", "municipalityNo", "municipality")
    d = dashboard.dashboard_tables(t.spark, base, "dk")
    return (_long(d["production"], "production", "municipalityno", "municipality", "hourutc", PRODUCTION)
            .unionAll(_long(d["consumption"], "consumption", "municipalityno", "concat(branche, ':', municipality)", "hourutc", ["consumptionkwh"]))
            .unionAll(_long(d["prodcons"], "prodcons", "pricearea", "hourdk", "hourutc", SETTLEMENT)).unionAll(_long(d["gas"], "gas", "null", "null", "gasday", PRICES))
            .unionAll(_long(d["municipalities"], "municipalities", "municipalityNo", "concat(municipality, ':', adminCenter, ':', region)", "null", _AREA_VALUES))
            .unionAll(_long(d["weather"], "weather", "municipality", "null", "hourutc", WEATHER)))


def _rule_sql(rule: fill.Rule) -> str:
    c = rule.column
    back = f"coalesce({c}, first_value(m_{c} ignore nulls) {_over(REST)})"
    value = {"forward": f"last_value({c} ignore nulls) {_over(PAST)}", "keep": c, "rolling": back}[rule.method]
    if rule.max_missing_pct is not None:
        value = f"case when avg(case when {c} is null then 1 else 0 end) over (partition by entity) * 100 < {rule.max_missing_pct} then {value} else {c} end"
    if rule.entities is not None:
        value = f"case when entity in ({', '.join(repr(e) for e in rule.entities)}) then {value} else {c} end"
    return f"trunc({value}) + 0.0 as {c}" if rule.whole else f"round({value} + 1e-9, 6) + 0.0 as {c}"


_RULES = imputation.weather_rules()


@query("impute_weather_rules", sql(f"""select entity as municipality, hourutc, {', '.join(_rule_sql(r) for r in _RULES)} from
    (select *, {', '.join(_rolled(r.column, r.window) for r in _RULES if r.method == 'rolling')} from
     (select {_NAME} as entity, hourutc, {', '.join(f'{e} as {m}' for m, e in WEATHER.items())} from series))""", "series"))
def impute_weather_rules(t):
    """The weather table's own rules: eleven measures, areas by name, means of a day and of a week."""
    rows = _weather(t).withColumnRenamed("time", "hourutc").drop("dist_to_station")
    filled = imputation.impute_weather(rows, SERIES.over(keys=("municipality",), chunk=336))
    names = [r.column for r in _RULES]
    return rounded(filled.select("municipality", "hourutc", *names), *names)


@query("stored_impute", sql(f"""select entity, hourutc, round(coalesce(v, first_value(m ignore nulls) {_over(REST)}) + 1e-9, 6) + 0.0 as v
    from (select *, avg(v) {_over('167 preceding and current row')} as m from series)""", "series").replace("least(user_id % 8, 3)", "user_id"))
def stored_impute(t):
    """The series of every user, stored by chunk, and filled from there."""
    base, by_user = new_folder(t.spark, "store"), Tables(t.spark, t.folder, by_user=True)
    write_store(views.series(by_user, kinds=()).select("entity", "hourutc", "v"), SERIES, base, "series", "store", before=167)
    rows, series = read_store(t.spark, SERIES, base, "series", "store")
    return rounded(fill.impute_rolling(rows, series, "v", 168), "v")
