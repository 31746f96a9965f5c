"""Every registered query against its SQL twin, and the plans of the heavy ones."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from meterflow.catalog import views
from meterflow.catalog.views import SERIES, Tables
from meterflow.operators import fill, filters, windows
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"map_slice_usage", "time_range_offset"}  # no event of that kind in that hour, fewer rows than the offset at this scale


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    problems = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert [p for p in problems if not (p == "no rows" and name in MAY_BE_EMPTY)] == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name,column", [("user_sliding_corr", "corr"), ("user_dct_smooth", "v_smooth"), ("user_impute_rolling", "v")])
def test_values_are_there(spark, name, column):
    """A key whose values are all null would agree with anything."""
    assert entry.queries()[name](spark, "/root/testdata/sf0.01").where(F.col(column).isNotNull()).count() > 1000


def test_entry(spark):
    assert entry.entry(spark).count() == 2880


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products(spark):
    for name in ("clip_to_range", "scalar_broadcast", "price_wind_corr", "impute_weather", "exchange_utilisation", "map_slice", "dct_smooth"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_times_reach_the_scan(spark):
    scan = plan(entry.queries()["time_range_scan"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in scan
    assert "l_comment" not in scan and "l_tax" not in scan


def test_rows_are_shuffled_once(spark):
    rows = spark.read.parquet(f"{FOLDER}/orders.parquet").select(
        F.col("o_custkey").alias("entity"), F.col("o_orderdate").alias("hourutc"), F.col("o_totalprice").alias("x"), F.col("o_totalprice").alias("y"))
    rules = [fill.Rule("x", window=24, max_missing_pct=40), fill.Rule("y", window=168)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(fill.impute(rows, SERIES, rules))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("REPARTITION_BY_COL") == 1 and "Python" not in text
    shuffled = [line for line in text.splitlines() if "REPARTITION_BY_COL" in line]
    assert "_chunk" in shuffled[0]
    # The other shuffles carry the chunk table: to its chunks, its series, and back to its chunks.
    assert text.count("Exchange hashpartitioning") == 4


def test_an_offset_is_found_by_counting(spark):
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    text = plan(filters.time_range(rows, "l_shipdate", "1993-01-01", "1998-01-01", 700, ["l_orderkey", "l_linenumber", "l_partkey"]))
    assert not any(word in text for word in ("exceptAll", "Limit", "TakeOrdered", "CartesianProduct", "BroadcastNestedLoopJoin", "Python"))
    assert "GreaterThanOrEqual(l_shipdate" in text


def test_places_with_ties_need_no_stored_copy(spark):
    from meterflow.sources.storage import shared_folder
    import pathlib
    before = set(pathlib.Path(shared_folder(spark)).iterdir())
    text = plan(entry.queries()["series_position"](spark, FOLDER))
    assert set(pathlib.Path(shared_folder(spark)).iterdir()) == before
    assert "Python" not in text and "o_totalprice" not in text


def test_chunks_bound_every_window(spark):
    """One series with most of the rows: no window group of the row passes is longer than a chunk and its halo."""
    rows = views.series(Tables(spark, FOLDER)).select("entity", "hourutc", "v")
    from meterflow.operators.layout import CHUNK, with_halo, with_index
    copies = with_halo(with_index(rows, SERIES), SERIES, 23)
    assert copies.groupBy("entity", CHUNK).count().agg(F.max("count")).collect()[0][0] <= SERIES.chunk + 23


def test_results_do_not_depend_on_chunk_or_partitions(spark):
    rows = views.series(Tables(spark, FOLDER)).select("entity", "hourutc", "v_view")
    want = None
    for chunk, parts in ((4096, 1), (24, 7), (5, 3)):
        s = SERIES.over(chunk=chunk)
        got = sorted(map(tuple, fill.impute_rolling(rows.repartition(parts), s, "v_view").select("entity", "hourutc", F.round("v_view", 9)).collect()), key=str)
        gaps = sorted(map(str, windows.find_gaps(rows, s, "v_view").collect()))
        assert want is None or want == (got, gaps)
        want = (got, gaps)


def test_other_session_zone(spark):
    """Times are wall-clock numbers: the session's zone must not matter."""
    rows = views.series(Tables(spark, FOLDER)).select("entity", "hourutc", "v")
    want = sorted(map(str, fill.impute_rolling(rows, SERIES, "v").collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = views.series(Tables(spark, FOLDER)).select("entity", "hourutc", "v")
        got = sorted(map(str, fill.impute_rolling(rows, SERIES, "v").collect()))
        assert filters.at_time(rows, "hourutc", "2024-01-15 00:00:00").count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_months_are_pruned(spark):
    from meterflow import Series
    from meterflow.sources.storage import new_folder
    from meterflow.sources.tables import read_series, write_series
    folder, s = new_folder(spark, "months"), Series(("l_returnflag",), "l_shipdate")
    write_series(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), s, folder, "lineitem", "store")
    rows = read_series(spark, s, folder, "lineitem", "store", "1997-01-15", "1997-02-02")
    scan = plan(rows)
    assert "PartitionFilters: [isnotnull(month" in scan and "GreaterThanOrEqual(l_shipdate" in scan
    assert set(r[0].month for r in rows.select("l_shipdate").distinct().collect()) == {1, 2}


def test_skewed_tables_match_sql(spark, tmp_path):
    """A third of the events, orders and line items share one key and time, line items also as equal copies."""
    import duckdb
    c = duckdb.connect()
    c.execute(f"""copy (select event_id, case when event_id % 3 = 0 then timestamp '2024-01-10 05:00:00' + interval (event_id) microsecond else ts end as ts,
        case when event_id % 3 = 0 then 1 else user_id end as user_id, case when event_id % 3 = 0 then 'view' else event_type end as event_type, value, props
        from '{FOLDER}/events.parquet') to '{tmp_path}/events.parquet'""")
    c.execute(f"""copy (select o_orderkey, case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey, o_orderstatus, o_totalprice,
        case when o_orderkey % 3 = 0 then timestamp '1997-02-03' else o_orderdate end as o_orderdate, o_orderpriority
        from '{FOLDER}/orders.parquet') to '{tmp_path}/orders.parquet'""")
    c.execute(f"""copy (select * from '{FOLDER}/lineitem.parquet' where l_orderkey % 3 > 0 union all select l.* from
        (select * from '{FOLDER}/lineitem.parquet' order by all limit 1) l, range(2000)) to '{tmp_path}/lineitem.parquet'""")
    for name in ("region nation customer supplier part documents embeddings pages benchmark labels conversations").split():
        (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    con = duck(str(tmp_path))
    for name in ("impute_threshold", "find_gaps", "enrich_orders", "summary_by_group", "dedupe_first", "series_position", "first_order",
                 "daily_resample", "price_wind_corr", "minmax_by_time"):
        assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], str(tmp_path)) == [], name


@pytest.mark.parametrize("name", ["user_sliding_corr", "user_impute_weather", "user_forward_fill"])
def test_tasks_grow_with_the_rows(spark, monkeypatch, name):
    """By user, the rows are dealt to as many tasks as they ask for, not to as few as their compressed bytes do."""
    from meterflow.catalog import views
    monkeypatch.setattr(views, "ROWS_PER_PART", 5_000, raising=False)
    rows = entry.queries()[name](spark, "/root/testdata/sf0.01")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 12


def test_sorts_and_window_passes(spark):
    """Two sorts of the rows for a sliding correlation, three window passes over the rows of an imputation."""
    from meterflow.catalog.views import SERIES, series, Tables
    from meterflow.operators.correlate import sliding_corr
    from meterflow.operators.fill import Rule, impute
    rows = spark.createDataFrame([], "entity long, hourutc timestamp_ntz, v double, w double")
    s = SERIES.over(regular=True)
    import re
    sorts = re.findall(r"Sort \[entity[^\]]*_index[^\]]*\]", plan(sliding_corr(rows, s, "v", "w", 8)))
    assert len(sorts) == 2, sorts
    rules = [Rule("v", window=24), Rule("w", window=48, max_missing_pct=40.0)]
    passes = [w for w in re.findall(r"Window \[.*", plan(impute(rows, s, rules))) if "_index" in w.rsplit("], [", 1)[-1]]
    assert len(passes) == 3, passes
    joined = plan(series(Tables(spark, FOLDER, by_user=True)))
    assert not re.search(r"Sort \[entity#\d+L? ASC NULLS FIRST, hourutc", joined)


def test_calendar_of_odd_rows(spark, tmp_path):
    """Events without a user or a time, one user with one event, and no events at all."""
    import datetime
    import duckdb
    from meterflow.catalog.views import MEASURES, Tables, series, sql
    at = lambda d, h: datetime.datetime(2024, 1, d, h, 5)
    rows = [(1, at(1, 5), 7, "view", 2.0, None), (2, at(1, 5), 7, "click", None, None), (3, at(3, 23), 7, "view", 4.0, None), (4, at(2, 0), None, "view", 1.0, None),
            (5, None, 8, "view", 1.0, None), (6, at(4, 1), 9, None, 3.0, None)]
    for name, own in (("some", rows), ("none", [])):
        events = spark.createDataFrame(own, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        events.write.parquet(f"{tmp_path}/{name}/events.parquet")
        c = duckdb.connect()
        c.execute(f"create view events as select * from '{tmp_path}/{name}/events.parquet/*.parquet'")
        text = sql(f"select entity, hourutc, {', '.join(MEASURES)} from series", "series").replace("least(user_id % 8, 3)", "user_id")
        want = sorted(map(str, c.sql(text).fetchall()))
        got = series(Tables(spark, f"{tmp_path}/{name}", by_user=True)).select("entity", "hourutc", *MEASURES)
        assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert want == []
