"""Sources, sinks and schema operators."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.scalars import row_id
from ..functions.times import local_to_utc, ts
from ..operators import filters, resample, schema, windows
from ..plans import imputation, ingest
from ..sources.html import extract_html_table
from ..sources.records import read_records
from ..sources.storage import new_folder
from ..sources.tables import (insert_documents, overwrite_table, read_documents, read_series, read_table, typed_write,
                              write_series, write_table)
from . import views
from .registry import query, rounded
from .views import Tables, sql

ORDER_FIELDS = "OrderKey bigint, CustKey bigint, Status string, TotalPrice double, OrderDate string, Priority string"


def _record():
    return F.struct(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("CustKey"), F.col("o_orderstatus").alias("Status"),
        F.col("o_totalprice").alias("TotalPrice"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("OrderDate"),
        F.col("o_orderpriority").alias("Priority"))


def _payload(t: Tables):
    """Orders as API payload documents, one per line, each with the records of up to 500 orders."""
    pages = t.orders.groupBy(F.expr("o_orderkey div 500")).agg(F.collect_list(_record()).alias("records"))
    return pages.select(F.to_json(F.struct("records")).alias("value"))


def _land_payloads(t: Tables) -> str:
    folder = new_folder(t.spark, "payloads")
    _payload(t).write.text(folder)
    return folder


@query("json_records", """select o_orderkey as "OrderKey", o_custkey as "CustKey", o_orderstatus as "Status", o_totalprice as "TotalPrice",
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as "OrderDate", o_orderpriority as "Priority" from orders""")
def json_records(t):
    return read_records(t.spark, _land_payloads(t), ORDER_FIELDS, per_line=True)


@query("json_one_document", """select o_orderkey as "OrderKey", o_custkey as "CustKey", o_orderstatus as "Status", o_totalprice as "TotalPrice",
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as "OrderDate", o_orderpriority as "Priority" from orders""")
def json_one_document(t):
    """All orders in one file, one document of one array, as a large download lands."""
    folder = new_folder(t.spark, "document")
    _one_document(t.orders.select(F.to_json(_record()).alias("value"))).write.text(folder)
    return read_records(t.spark, folder, ORDER_FIELDS)


def _one_document(records: DataFrame) -> DataFrame:
    """The lines of one document of all records, in one partition: a file has one writer. It passes on what comes, and neither sorts nor holds the rows."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda texts: pa.RecordBatch.from_arrays([texts], ["value"])
        yield line(pa.array(['{"total": 0, "links": [{"next": "}"}], "records": [']))
        first = True
        for batch in batches:
            own = batch.column(0)
            if first and len(own):
                yield line(own.slice(0, 1))
                own, first = own.slice(1), False
            yield line(pc.binary_join_element_wise(pa.scalar("", own.type), own, pa.scalar(",", own.type)))
        yield line(pa.array(["]}"]))

    return records.repartition(1).mapInArrow(lines, "value string")


@query("ingest_clean", """select o_orderkey as orderkey, o_custkey as custkey, o_orderstatus as status, o_totalprice as totalprice,
    cast(o_orderdate as timestamp) as orderdate, o_orderpriority as priority from orders""")
def ingest_clean(t):
    return ingest.ingest_records(t.spark, _land_payloads(t), ORDER_FIELDS.replace("CustKey bigint", "CustKey string"), ["orderdate"],
                                 {"custkey": "bigint", "priority": "string"}, per_line=True)


@query("time_range_scan", """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem
    where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1998-01-01'""")
def time_range_scan(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return filters.time_range(rows, "l_shipdate", "1997-01-01", "1998-01-01")


@query("time_range_offset", """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem
    where l_shipdate >= timestamp '1993-01-01' and l_shipdate < timestamp '1998-01-01'
    order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity offset 10000""")
def time_range_offset(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return filters.time_range(rows, "l_shipdate", "1993-01-01", "1998-01-01", 10_000, ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])


_PAGE_SCHEMA = T.StructType([
    T.StructField("Customer", T.LongType()), T.StructField("Name", T.StringType()),
    T.StructField("Nation", T.IntegerType()), T.StructField("Balance (kr)", T.DoubleType())])


@query("html_table", """select c_custkey as "Customer", c_name as "Name", c_nationkey as "Nation", c_acctbal as "Balance (kr)" from customer""")
def html_table(t):
    cells = [F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in ("c_custkey", "c_name", "c_nationkey")]
    balance = F.concat(F.lit("<td>"), F.format_number("c_acctbal", 2), F.lit("</td>"))
    head = "<th>Customer</th><th>Name</th><th>Nation</th><th>Balance (kr)</th>"
    html = F.concat(F.lit(f'<html><body><table class="plain"><tr><td>1</td></tr></table><table class="wikitable sortable"><tr>{head}</tr><tr>'),
                    *cells, balance, F.lit("</tr></table></body></html>"))
    # Dealt out before the pages are written: the given file is one scan task, and parsing is the work here.
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").repartition(tasks)
    pages = t.pages.select("html").unionByName(customers.select(html.alias("html")))
    return extract_html_table(pages, "html", "wikitable sortable", _PAGE_SCHEMA)


@query("table_scan", "select l_orderkey, l_linenumber, l_extendedprice, l_shipdate from lineitem")
def table_scan(t):
    stored = read_table(t.spark, t.folder, "lineitem.parquet", ".")
    return stored.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@query("document_scan", "select event_id, ts, user_id, event_type, value, props from events")
def document_scan(t):
    folder = new_folder(t.spark, "documents")
    insert_documents(t.events.withColumn("_id", row_id("event_id")), folder, "events", "docs")
    stored = "_id string, event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    return read_documents(t.spark, folder, "events", "docs", stored)


@query("sink_append", """select event_type, count(*) * 2 as n, count(*) * 2 as ids from events group by event_type""")
def sink_append(t):
    folder = new_folder(t.spark, "append")
    for _ in range(2):
        write_table(t.events.select("event_id", "event_type", "value"), folder, "events", "store")
    stored = read_table(t.spark, folder, "events", "store")
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("sink_overwrite", "select o_orderkey, o_totalprice * 2 as o_totalprice from orders")
def sink_overwrite(t):
    folder = new_folder(t.spark, "overwrite")
    write_table(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), folder, "orders", "store", insert=False, add_id=False)
    stored = read_table(t.spark, folder, "orders", "store")
    overwrite_table(stored.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice")), folder, "orders", "store")
    return read_table(t.spark, folder, "orders", "store")


@query("typed_write", """select cast(l_orderkey as integer) as l_orderkey, l_linenumber, l_quantity, l_returnflag,
    cast(l_shipdate as timestamp) as l_shipdate, true as has_id from lineitem""")
def typed_written(t):
    folder = new_folder(t.spark, "typed")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    typed_write(rows, folder, "lineitem", "store")
    typed_write(rows, folder, "lineitem", "store")  # already there: left as it is
    stored = read_table(t.spark, folder, "lineitem", "store")
    return stored.withColumn("has_id", F.length("id") == 36).drop("id")


@query("series_store", """select l_orderkey, l_linenumber, l_returnflag, l_shipdate, l_quantity from lineitem
    where l_shipdate >= timestamp '1997-01-15' and l_shipdate < timestamp '1997-04-02'""")
def series_store(t):
    folder = new_folder(t.spark, "series")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity")
    layout = views.Series(("l_returnflag",), "l_shipdate")
    write_series(rows, layout, folder, "lineitem", "store", add_id=False)
    return read_series(t.spark, layout, folder, "lineitem", "store", "1997-01-15", "1997-04-02")


@query("row_id", "select count(*) as n, count(*) as ids, count(*) as digests from events")
def row_ids(t):
    rows = t.events.select(row_id().alias("id"), row_id("event_id", "ts").alias("digest"))
    return rows.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.countDistinct("digest").alias("digests"))


@query("enrich_writeback", sql("""select hourutc, u.entity_no, branche, round(consumption + 1e-9, 6) + 0.0 as consumption, area_name
    from usage u join areas a on u.entity_no = a.entity_no""", "usage", "areas"))
def enrich_writeback(t):
    folder = new_folder(t.spark, "enrich")
    write_table(views.usage(t), folder, "usage", "store", add_id=False)
    stored = ingest.enrich_writeback(t.spark, folder, "usage", "store", views.areas(t), "entity_no", "entity_no", "area_name")
    return rounded(stored, "consumption")


# Schema operators

@query("rename_columns", "select o_orderkey as order_no, o_totalprice as total, o_orderdate from orders")
def rename_columns(t):
    return schema.rename_columns(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), {"o_orderkey": "order_no", "o_totalprice": "total"})


@query("lowercase_columns", """select event_id as eventid, event_type as eventtype, value from events""")
def lowercase_columns(t):
    return schema.lowercase_columns(t.events.select(F.col("event_id").alias("EventID"), F.col("event_type").alias("EventType"), F.col("value").alias("VALUE")))


@query("parse_timestamps", "select event_id, cast(ts as timestamp) as ts from events")
def parse_timestamps(t):
    return schema.parse_timestamps(t.events.select("event_id", F.col("ts").cast("string").alias("ts")), ["ts"])


@query("cast_columns", """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
    cast(trunc(l_quantity) as integer) as l_quantity, try_cast(l_returnflag as double) as l_returnflag from lineitem""")
def cast_columns(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    strict = schema.cast_columns(rows, {"l_orderkey": "string", "l_linenumber": "bigint", "l_quantity": "int"})
    return schema.cast_columns(strict, {"l_returnflag": "double"}, strict=False)


@query("truncate_codes", sql("select entity, hourutc, trunc(v) + 0.0 as v, trunc(v_view) + 0.0 as v_view from series", "series"))
def truncate_codes(t):
    return schema.truncate_codes(views.series(t).select("entity", "hourutc", "v", "v_view"), ["v", "v_view"])


@query("drop_columns", "select event_id, ts, value from events")
def drop_columns(t):
    return schema.drop_columns(t.events, ["user_id", "event_type", "props"])


@query("migrate_column", "select l_orderkey, l_linenumber, l_shipdate as hourutc from lineitem")
def migrate_column(t):
    return schema.migrate_column(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", "hourutc")


@query("measure_columns", "select l_discount, l_extendedprice, l_quantity, l_tax from lineitem")
def measure_columns(t):
    names = schema.measure_columns(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                                "l_linestatus", "l_shipdate"], ordered=True)
    return t.lineitem.select(*names)


# Ordering

@query("sort_by_time", "select event_id, ts, value from events order by ts nulls last, event_id")
def sort_by_time(t):
    return schema.sort_by_time(t.events.select("event_id", "ts", "value"), "ts", "event_id")


@query("head_n", "select event_id, ts, value from events order by ts, event_id limit 5")
def head_n(t):
    return schema.head_n(t.events.select("event_id", "ts", "value"), 5, "ts", "event_id")


@query("price_series", sql("""select dt, round(purchase + 1e-9, 4) + 0.0 as purchase, round(sales + 1e-9, 4) + 0.0 as sales from price order by dt""", "price"))
def price_series(t):
    return rounded(ingest.price_series(views.price(t), "dt", "purchase", "sales"), "purchase", "sales", digits=4)


# Times

@query("date_range", "select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as dt from (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders)")
def date_range(t):
    ends = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    return resample.date_range(F.col("lo"), F.col("hi"), ends).select("dt")


@query("local_to_utc", """select o_orderkey, timezone('UTC', timezone('Europe/Copenhagen', o_orderdate)) as utc from orders""")
def to_utc(t):
    return t.orders.select("o_orderkey", local_to_utc("o_orderdate").alias("utc"))


# A local clock made of the orders: one row every 37 seconds, in four series, over the end of summer time.
_INSTANT = "2022-10-29 20:00:00"


@query("local_to_utc_in_order", f"""select o_orderkey, o_custkey % 4 as area, timestamp '{_INSTANT}' + to_seconds(37 * o_orderkey) as utc from orders""")
def to_utc_in_order(t):
    instant = ts(_INSTANT) + F.make_dt_interval(secs=F.col("o_orderkey") * 37)
    local = F.convert_timezone(F.lit("UTC"), F.lit("Europe/Copenhagen"), instant).cast("timestamp_ntz")
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 4).alias("area"), local.alias("hourdk"))
    return windows.local_to_utc_in_order(rows, ["area"], "hourdk", ["o_orderkey"]).drop("hourdk")


# Constant fills

@query("fill_constant", sql("select entity, hourutc, coalesce(v, 0) as v, v_view, coalesce(v_error, 0) as v_error from "
                            "(select entity, hourutc, round(v + 1e-9, 6) + 0.0 as v, round(v_view + 1e-9, 6) + 0.0 as v_view, round(v_error + 1e-9, 6) + 0.0 as v_error from series)", "series"))
def fill_constant(t):
    rows = rounded(views.series(t).select("entity", "hourutc", "v", "v_view", "v_error"), "v", "v_view", "v_error")
    return imputation.impute_production(rows, ["v", "v_error"])


@query("impute_production", sql("select area_no, hourutc, " + ", ".join(f"coalesce(round({c} + 1e-9, 6) + 0.0, 0) as {c}" for c in ("v_view", "v_click", "v_signup", "v_error"))
                                + ", round(v_purchase + 1e-9, 6) + 0.0 as v_purchase from (select entity as area_no, * from series)", "series"))
def impute_production(t):
    filled = ["v_view", "v_click", "v_signup", "v_error"]
    rows = views.series(t).select(F.col("entity").alias("area_no"), "hourutc", *filled, "v_purchase")
    return rounded(imputation.impute_production(rows, filled), *filled, "v_purchase")


@query("fill_all", sql("select area, hourutc, " + ", ".join(f"coalesce(round({c} + 1e-9, 6) + 0.0, 0) as {c}" for c in ("x_no", "x_se", "x_nl", "x_ge")) + " from exchange", "exchange"))
def fill_all(t):
    return rounded(imputation.impute_settlement(views.exchange(t)), "x_no", "x_se", "x_nl", "x_ge")


@query("impute_price", """select dt, round(purchase + 1e-9, 4) + 0.0 as purchase, coalesce(round(sales + 1e-9, 4) + 0.0, 0) as sales from
    (select cast(o_orderdate as date) as dt, avg(o_totalprice) as purchase, avg(o_totalprice) filter (o_orderstatus = 'P') as sales from orders group by 1) order by dt""")
def impute_price(t):
    """A day without an order of one status has no price for it."""
    rows = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("dt")).agg(
        F.avg("o_totalprice").alias("purchase"), F.avg(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))).alias("sales"))
    return rounded(imputation.impute_price(rows, "dt", ["sales"]), "purchase", "sales", digits=4)
