"""Sources, sinks, joins, aggregates, filters and scalar functions."""
import datetime
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow import Series
from meterflow.functions.scalars import nan_to_null, one_decimal, row_id, sqrt_or_null
from meterflow.functions.times import local_to_utc
from meterflow.operators import aggregates, filters, joins, profile, schema
from meterflow.operators.layout import global_rank
from meterflow.sources import html, records, tables
from meterflow.sources.storage import new_folder


def test_payload_files_one_document_each(spark, tmp_path):
    for i in range(3):
        body = {"total": 2, "records": [{"HourUTC": f"2022-01-0{i + 1}T00:00:00", "Mwh": i + 0.5, "Extra": "x"}, {"HourUTC": None, "Mwh": None}]}
        (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=2))
    got = records.read_records(spark, str(tmp_path), "HourUTC string, Mwh double").orderBy("Mwh").collect()
    assert len(got) == 6 and [r.Mwh for r in got if r.Mwh is not None] == [0.5, 1.5, 2.5]
    by_struct = T.StructType([T.StructField("Mwh", T.DoubleType())])
    assert records.read_records(spark, str(tmp_path), by_struct).columns == ["Mwh"]
    upper = records.read_records(spark, str(tmp_path), "hourutc string, MWH double", any_case=True)
    assert upper.columns == ["hourutc", "MWH"] and upper.filter("MWH > 1").count() == 2 and upper.count() == 6
    (tmp_path / "bad.json").write_text('{"records": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        records.read_records(spark, str(tmp_path), "Mwh double").collect()


PAGE = """<html><body><table class="other"><tr><th>No</th></tr><tr><td>9</td></tr></table>
<table class='wikitable sortable'><thead><tr><th>LAU-1 code <sup>1</sup></th><th>Name</th><th>Area (km&sup2;)</th></tr></thead>
<tr><td rowspan=2>101</td><td><a href="#">K&oslash;benhavn</a> <b>K</b></td><td>1,234.5</td></tr>
<tr><td>Two<br>lines <table><tr><td>inner</td></tr></table></td><td>n/a</td></tr>
<tr><td>147<td>Open cells<td>8.77</table>
<table class="wikitable sortable"><tr><th>No</th></tr><tr><td>7</td></tr></table></body></html>"""


def test_html_table(spark):
    fields = T.StructType([T.StructField("LAU-1 code 1", T.IntegerType()), T.StructField("Name", T.StringType()),
                           T.StructField("Area (km²)", T.DoubleType())])
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None), (4, "")], "page_id int, html string")
    got = [tuple(r) for r in html.extract_html_table(pages, "html", "wikitable sortable", fields, keep=("page_id",)).collect()]
    assert got == [(1, 101, "København K", 1234.5), (1, 101, "Two lines inner", None), (1, 147, "Open cells", 8.77)]


def test_sinks(spark):
    base, rows = new_folder(spark, "t"), spark.createDataFrame([(1, 2.0), (2, float("nan"))], "k int, x double")
    tables.write_table(rows, base, "m", "ns")
    tables.write_table(rows, base, "m", "ns")
    stored = tables.read_table(spark, base, "m", "ns")
    assert stored.count() == 4 and stored.select("id").distinct().count() == 4 and stored.filter("x is null").count() == 2
    tables.overwrite_table(stored.filter("k = 1"), base, "m", "ns")
    assert [r.k for r in tables.read_table(spark, base, "m", "ns").collect()] == [1, 1]
    tables.write_table(rows, base, "m", "ns", insert=False, add_id=False, partition_by=["k"])
    assert tables.read_table(spark, base, "m", "ns").count() == 2


def test_typed_write(spark):
    base = new_folder(spark, "t")
    rows = spark.createDataFrame([(1, 1.5, "a", True, datetime.date(2022, 1, 1))], "n bigint, x float, s string, b boolean, d date")
    tables.typed_write(rows, base, "m", "ns")
    tables.typed_write(rows.withColumn("n", F.lit(7)), base, "m", "ns")
    stored = tables.read_table(spark, base, "m", "ns")
    assert dict(stored.dtypes) == {"id": "string", "n": "int", "x": "double", "s": "string", "b": "boolean", "d": "string"}
    assert stored.columns[0] == "id" and [r.n for r in stored.collect()] == [1]
    with pytest.raises(PySparkException):
        tables.typed_write(spark.createDataFrame([(2 ** 40,)], "n bigint"), base, "big", "ns")
    with_id = spark.createDataFrame([("u", 1)], "id string, n bigint")
    tables.typed_write(with_id, base, "own", "ns")
    assert tables.read_table(spark, base, "own", "ns").collect()[0].id == "u"


def test_documents(spark):
    base = new_folder(spark, "d")
    rows = spark.createDataFrame([("x", 1, datetime.datetime(2022, 1, 1, 0, 0, 0, 5)), ("y", None, None)], "_id string, n int, t timestamp_ntz")
    tables.insert_documents(rows, base, "c", "ns")
    tables.insert_documents(rows, base, "c", "ns")
    got = tables.read_documents(spark, base, "c", "ns", "_id string, n int, t timestamp_ntz")
    assert got.columns == ["n", "t"] and got.count() == 4 and got.filter("t = timestamp_ntz'2022-01-01 00:00:00.000005'").count() == 2


def test_salted_join_equals_broadcast(spark):
    # One key, in equal copies, holds a third of the facts.
    fact = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).alias("k"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("x"))
    dim = spark.range(40).select(F.col("id").alias("no"), F.concat(F.lit("n"), "id").alias("name"))
    small = joins.join_dimension(fact, dim, "k", "no", ["name"])
    large = joins.join_dimension(fact, dim, "k", "no", ["name"], hot_share=0.01)
    assert small.columns == large.columns == ["k", "x", "name"]
    assert sorted(small.collect()) == sorted(large.collect()) and small.count() == 1000 + 1600
    kept = joins.join_dimension(fact, dim, "k", "no", ["name"], how="left", hot_share=0.01)
    assert kept.count() == 3000 and kept.where("name is null").count() == 400
    salted = fact.withColumn("s", F.pmod(F.xxhash64(F.spark_partition_id(), "k", "x"), F.lit(32))).filter("k = 7 and x = 0")
    assert salted.select("s").distinct().count() > 1


def test_a_failed_overwrite_leaves_the_table(spark, tmp_path):
    base = str(tmp_path)
    tables.write_table(spark.range(5), base, "m", "ns", add_id=False)
    stored = tables.read_table(spark, base, "m", "ns")
    with pytest.raises(PySparkException):
        tables.overwrite_table(stored.select(F.raise_error(F.lit("stop")).cast("long").alias("id")), base, "m", "ns")
    assert stored.count() == 5 and [p.name for p in (tmp_path / "ns").iterdir()] == ["m"]
    tables.overwrite_table(stored.select((F.col("id") * 2).alias("id")), base, "m", "ns", partition_by=())
    assert sorted(r.id for r in tables.read_table(spark, base, "m", "ns").collect()) == [0, 2, 4, 6, 8]
    assert [p.name for p in (tmp_path / "ns").iterdir()] == ["m"]


def test_filters_on_doubles_reach_the_files(spark):
    base = new_folder(spark, "t")
    tables.write_table(spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, 9.0)], "k int, x double"), base, "m", "ns", add_id=False)
    stored = tables.read_table(spark, base, "m", "ns").filter("x > 3 and k > 0")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,3.0)" in plan and "GreaterThan(k,0)" in plan
    assert [r.k for r in stored.collect()] == [3] and tables.read_table(spark, base, "m", "ns").filter("x is null").count() == 1
    foreign = new_folder(spark, "f")
    spark.createDataFrame([(1, float("nan"))], "k int, x double").write.parquet(f"{foreign}/ns/m")
    assert tables.read_table(spark, foreign, "m", "ns", clean=True).collect()[0].x is None


def test_summaries(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 2001, p=[0.6, 0.3, 0.1]), "x": rng.integers(0, 40, 2001) / 4})
    pdf.loc[pdf.index % 7 == 0, "x"] = None
    df = spark.createDataFrame([(g, None if np.isnan(x) else x) for g, x in pdf.itertuples(index=False)] + [(None, 1.0), ("none", None)], "g string, x double")
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["none"], "x": [np.nan]})])
    for how in ("sum", "mean", "min", "max", "count", "std", "median"):
        got = {r.g: r.x for r in aggregates.summary_by_group(df, "g", "x", how).collect()}
        want = pdf.groupby("g").x.agg(how)
        for g in want.index:
            if got.get(g) is None:
                assert np.isnan(want[g])
            else:
                assert got[g] == pytest.approx(want[g])
        assert None not in got
    with pytest.raises(ValueError):
        aggregates.summary_by_group(df, "g", "x", "mode")


def test_median_of_a_large_group(spark):
    df = spark.range(300_000).select(F.lit("a").alias("g"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.xxhash64("id") % 100000 / 7.0).alias("x"))
    got = aggregates.median_by_group(df, "g", "x", "m").collect()[0].m
    assert got == df.agg(F.median("x")).collect()[0][0]


def test_profiles(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, None), ("b", 1.0, 2.0), (None, None, 1.0)], "e string, x double, y double")
    assert [tuple(r) for r in profile.missing_profile(df).collect()] == [("x", 3, 0.75), ("e", 1, 0.25), ("y", 1, 0.25)]
    assert [tuple(r) for r in profile.missing_pct_by_entity(df, "e", "x").collect()] == [("a", 100.0)]
    assert profile.missing_pct_by_entity(df, "e", "x", above=1, below=100).count() == 0
    assert [tuple(r) for r in profile.missing_pct_matrix(df, "e", ["x", "y"]).collect()] == [("a", "x", 100.0), ("a", "y", 50.0)]


def test_first_observed_is_numbered_in_pieces(spark):
    t0 = datetime.datetime(2022, 1, 1)
    rows = [(f"e{i}", t0 + datetime.timedelta(hours=i // 40), float(i) if i != 3 else None) for i in range(90)]
    got = aggregates.first_observed(spark.createDataFrame(rows, "e string, t timestamp_ntz, x double"), Series(("e",), "t"), "x").collect()
    assert sorted(r.ordinal for r in got) == list(range(1, 90))
    assert [(r.first_time, r.e) for r in sorted(got, key=lambda r: r.ordinal)] == sorted((r.first_time, r.e) for r in got)
    assert [r.n for r in global_rank(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")), ["v"], "n").orderBy("v").collect()] == list(range(1, 5001))


def test_scalars(spark):
    df = spark.createDataFrame([(float("nan"), 4.0), (1.0, -1.0), (None, 2.0)], "x double, y double")
    assert [r.x for r in nan_to_null(df).collect()] == [None, 1.0, None]
    assert [r[0] for r in df.select(sqrt_or_null("y")).collect()] == [2.0, None, pytest.approx(2 ** 0.5)]
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 12.25, 12.35, 99.95, 0.95, 1e6 + 0.05, 221.45, 3.0, 0.04999] + list(np.random.default_rng(1).integers(0, 10 ** 6, 500) / 100)
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select(one_decimal("v")).collect()
    assert [r[0] for r in got] == [f"{v:.1f}" for v in values]
    ids = df.select(row_id("x", "y").alias("d"), row_id().alias("u"))
    assert ids.select("d").distinct().count() == 3 and ids.select("u").distinct().count() == 3
    assert ids.select("d").collect() == ids.select("d").collect()


def test_daylight_saving(spark):
    rows = [(datetime.datetime(2022, 10, 30, 2, 30),), (datetime.datetime(2022, 3, 27, 2, 30),), (datetime.datetime(2022, 7, 1),)]
    got = [r[0] for r in spark.createDataFrame(rows, "t timestamp_ntz").select(local_to_utc("t")).collect()]
    assert got == [datetime.datetime(2022, 10, 30, 0, 30), datetime.datetime(2022, 3, 27, 1, 30), datetime.datetime(2022, 6, 30, 22)]


def test_schema_operators(spark):
    df = spark.createDataFrame([("1", "2022-01-01T03:00:00")], "A string, b string")
    assert schema.lowercase_columns(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        schema.lowercase_columns(df.withColumn("B2", F.lit(1)).withColumnRenamed("B2", "a_").toDF("A", "b", "B"))
    assert schema.parse_timestamps(df, ["b"]).collect()[0].b == datetime.datetime(2022, 1, 1, 3)
    with pytest.raises(PySparkException):
        schema.cast_columns(df, {"b": "int"}).collect()
    assert schema.cast_columns(df, {"b": "int"}, strict=False).collect()[0].b is None
    assert [r[0] for r in schema.truncate_codes(spark.createDataFrame([(-1.7,), (2.9,), (None,)], "c double"), ["c"]).collect()] == [-1.0, 2.0, None]


def test_where_binds_values(spark):
    df = spark.createDataFrame([("O'Neil",), ("x",)], "name string")
    assert filters.where(df, "name = {who}", {"who": "O'Neil"}).count() == 1
    assert filters.where(df, "name = {who}", {"who": "x' or '1' = '1"}).count() == 0
    assert filters.where(df, "name = 'x'").columns == ["name"]


def test_time_range_offset(spark, hourly):
    df = hourly([float(i) for i in range(10)])
    got = filters.time_range(df, "hourutc", "2022-01-01 02:00:00", "2022-01-01 06:00:00", offset=1).collect()
    assert sorted(r.x for r in got) == [3.0, 4.0, 5.0]
    window = filters.display_window(spark.sql("select explode(sequence(timestamp_ntz'2022-07-01', timestamp_ntz'2022-10-05', interval 1 day)) t"), "t", "2022-07-31 00:00:00")
    ends = window.agg(F.min("t"), F.max("t")).collect()[0]
    assert ends[0] == datetime.datetime(2022, 7, 24) and ends[1] == datetime.datetime(2022, 9, 30)


def test_coverage_and_grouping(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert aggregates.coverage_ratio(df, "k", "a", "b").collect()[0].ratio == 2.0
    assert aggregates.coverage_ratio(df, "k", "a", "none").collect()[0].ratio is None


def test_repeated_headers_and_missing_cells(spark):
    page = "<table class='t'><tr><th>A</th><th>B</th><th>A</th></tr><tr><td>1</td><td>NaN</td><td>2</td></tr></table>"
    fields = T.StructType.fromDDL("A int, B double, `A (2)` int")
    got = html.extract_html_table(spark.createDataFrame([(page,)], "html string"), "html", "t", fields).collect()
    assert [tuple(r) for r in got] == [(1, None, 2)]
