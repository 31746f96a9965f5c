"""Payload files cut into pieces, tables replaced by versions, instants from the order of rows, medians in two passes."""
import datetime
import json
import random
import zoneinfo

import pytest
from pyspark.sql import functions as F

from meterflow.operators import aggregates, windows
from meterflow.sources import tables
from meterflow.sources.records import read_records
from meterflow.sources.tables import overwrite_table, read_table, write_table

TEXTS = ["plain", "with } brace", 'quote " and }, {', "back\\slash}", '{"records":[', "new\nline}", "é}{", ""]


def record(rng, i):
    return {"A": i, "s": rng.choice(TEXTS), "n": {"x": {"y": i}} if i % 5 == 0 else None, "l": [{"q": 1}, {"q": "}"}] if i % 7 == 0 else []}


@pytest.mark.parametrize("split", [100, 1000, 1 << 27])
def test_one_large_document_is_read_in_many_tasks(spark, tmp_path, split):
    rng = random.Random(1)
    documents = [{"total": 3, "note": "x}y { [", "records": [record(rng, i) for i in range(400)], "links": [{"A": -1}, {"A": -2}]},
                 {"filters": [{"A": -5}], "records": [record(rng, i) for i in range(500, 510)]}, {"records": []}, {"other": 1}, {"records": [record(rng, 900)]}]
    for i, d in enumerate(documents):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=[None, 2, None, None, 1][i], ensure_ascii=i % 2 == 0) + "\n" * (i % 2), encoding="utf-8")
    want = sorted((r["A"], r["s"]) for d in documents for r in d.get("records", []))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > (100 if split == 100 else 1)
        assert sorted(map(tuple, read_records(spark, str(tmp_path), "A int, s string").collect())) == want
        any_case = read_records(spark, str(tmp_path), "a int, S string", any_case=True)
        assert any_case.columns == ["a", "S"] and sorted(map(tuple, any_case.collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text", ["not json", '{"records":[{"a":1', '{"records":[{"a":1}', '{"records":[{"a":1}]}}', '{"records":[{"a":1}]} x', '{"records":[{"a":"x}]}'])
def test_what_is_no_document_raises(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="JSON document"):
        read_records(spark, str(tmp_path), "a int").collect()


def rows_of(spark, base):
    return sorted(r["x"] for r in read_table(spark, base, "t", "n").collect())


class Stopping:
    """A file system that fails at its n-th change."""

    def __init__(self, files, left):
        self.files, self.left = files, left

    def __getattr__(self, name):
        def call(*args):
            if name in ("delete", "createNewFile"):
                self.left[0] -= 1
                if self.left[0] < 0:
                    raise KeyboardInterrupt(name)
            return getattr(self.files, name)(*args)
        return call


@pytest.mark.parametrize("versions", [0, 1, 2, 3])
def test_a_stopped_overwrite_leaves_one_whole_table(spark, tmp_path, monkeypatch, versions):
    """Stopped before every change of the file system in turn: the table read is the old one or the new one."""
    old, new = list(range(20)), list(range(100, 130))
    real, stops = tables.files_of, 0
    for stop in range(40):
        base = str(tmp_path / f"{versions}-{stop}")
        write_table(spark.createDataFrame([(x,) for x in (old if not versions else [1])], "x int"), base, "t", "n", add_id=False)
        for _ in range(versions):
            overwrite_table(spark.createDataFrame([(x,) for x in old], "x int"), base, "t", "n")
        left = [stop]
        monkeypatch.setattr(tables, "files_of", lambda s, p: (Stopping(real(s, p)[0], left), real(s, p)[1]))
        try:
            overwrite_table(spark.createDataFrame([(x,) for x in new], "x int"), base, "t", "n")
            done = True
        except KeyboardInterrupt:
            done, stops = False, stops + 1
        monkeypatch.setattr(tables, "files_of", real)
        assert rows_of(spark, base) == (old if stop == 0 else new)
        overwrite_table(read_table(spark, base, "t", "n").select((F.col("x") + 1).alias("x")), base, "t", "n")
        assert rows_of(spark, base) == [x + 1 for x in (old if stop == 0 else new)]
        if done:
            break
    assert done and stops >= 1


def test_a_failing_write_leaves_the_table(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(5).select(F.col("id").alias("x")), base, "t", "n", insert=False, add_id=False)
    with pytest.raises(Exception, match="boom"):
        overwrite_table(read_table(spark, base, "t", "n").select(F.raise_error(F.lit("boom")).cast("long").alias("x")), base, "t", "n")
    assert rows_of(spark, base) == list(range(5))


def test_versions_are_dropped_and_appended_to(spark, tmp_path):
    base = str(tmp_path)
    for i in range(5):
        write_table(spark.range(i, i + 3).select(F.col("id").alias("x")), base, "t", "n", insert=False, add_id=False)
        reader = read_table(spark, base, "t", "n")
        write_table(spark.range(1).select(F.lit(-1).cast("long").alias("x")), base, "t", "n", add_id=False)
        assert rows_of(spark, base) == sorted([-1, i, i + 1, i + 2])
    write_table(spark.range(1).select(F.lit(7).cast("long").alias("x")), base, "t", "n", insert=False, add_id=False)
    assert reader.count() in (3, 4) and rows_of(spark, base) == [7]  # found before the last replacement: still there
    kept = list((tmp_path / "n" / "t" / tables.VERSIONS).glob("v-*"))
    assert len(kept) == 2 and not list((tmp_path / "n" / "t").glob("*.parquet"))


def test_instants_are_inferred_from_the_order(spark):
    zone = zoneinfo.ZoneInfo("Europe/Copenhagen")
    rng = random.Random(2)
    rows, want = [], {}
    for series in range(6):
        at = datetime.datetime(2022, 10, 29, 20) + datetime.timedelta(minutes=rng.randint(0, 90))
        for i in range(200):
            rows.append((series, i, at.replace(tzinfo=datetime.timezone.utc).astimezone(zone).replace(tzinfo=None)))
            want[series, i] = at
            at += datetime.timedelta(minutes=rng.choice([5, 10, 15, 29]))
    df = spark.createDataFrame(rows, "area int, n int, hourdk timestamp_ntz").repartition(6)
    got = {(r["area"], r["n"]): r["utc"] for r in windows.local_to_utc_in_order(df, ["area"], "hourdk", ["n"]).collect()}
    assert got == want
    # A single pass is taken for the first; a missing time stays missing; times that repeat count as the clock going back.
    few = spark.createDataFrame([(0, 0, datetime.datetime(2022, 10, 30, 2, 10)), (0, 1, datetime.datetime(2022, 10, 30, 2, 40)), (0, 2, None),
                                 (1, 0, datetime.datetime(2022, 10, 30, 2, 40)), (1, 1, datetime.datetime(2022, 10, 30, 2, 40))], "area int, n int, hourdk timestamp_ntz")
    got = {(r["area"], r["n"]): r["utc"] for r in windows.local_to_utc_in_order(few, ["area"], "hourdk", ["n"]).collect()}
    hour = lambda h, m: datetime.datetime(2022, 10, 30, h, m)
    assert got == {(0, 0): hour(0, 10), (0, 1): hour(0, 40), (0, 2): None, (1, 0): hour(0, 40), (1, 1): hour(1, 40)}


def test_summaries_with_median_scan_twice(spark):
    import statistics

    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 11}", None if i % 13 == 0 else round(1e6 + rng.gauss(0, 1), 2) if i % 2 else 5.0) for i in range(3000)] + [("one", 2.5), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    hows = ["sum", "mean", "min", "max", "count", "std", "median"]
    got = {r["k"]: r.asDict() for r in aggregates.summaries_by_group(df, "k", "x", hows).collect()}
    groups = {}
    for k, x in rows:
        if k is not None:
            groups.setdefault(k, []).extend([] if x is None else [x])
    assert set(got) == set(groups)
    for k, x in groups.items():
        want = {"sum": sum(x), "mean": statistics.fmean(x) if x else None, "min": min(x, default=None), "max": max(x, default=None), "count": len(x),
                "std": statistics.stdev(x) if len(x) > 1 else None, "median": statistics.median(x) if x else None}
        for how, value in want.items():
            assert got[k][how] == (pytest.approx(value, rel=1e-9) if value is not None else None), (k, how)
    stored = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = aggregates.summaries_by_group(stored, "l_returnflag", "l_quantity", hows)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") <= 2


def test_a_stored_series_is_not_shuffled(spark, tmp_path):
    from meterflow import Series
    from meterflow.operators import correlate, fill
    from meterflow.sources.store import plain, read_store, write_store

    s = Series(("entity",), "hourutc", chunk=50, regular=True)
    rows = spark.range(4000).select((F.col("id") % 4).alias("entity"), F.expr("timestamp_ntz '2022-01-01 00:00:00' + make_dt_interval(0, cast(id div 4 as int), 0, 0)").alias("hourutc"),
                                    F.when(F.col("id") % 7 > 3, F.col("id") % 91 + 0.5).alias("x"), (F.col("id") % 13 * 1.0).alias("y"))
    write_store(rows, s, str(tmp_path), "t", "n", before=30, after=5, buckets=6)
    stored, series = read_store(spark, s, str(tmp_path), "t", "n")
    assert series.halo == (30, 5) and sorted(map(str, plain(stored).collect())) == sorted(map(str, rows.collect()))
    uses = {"W1": lambda d, k: fill.forward_fill(d, k, "x"), "W3": lambda d, k: fill.backward_fill(d, k, "x"), "W2": lambda d, k: fill.rolling_mean(d, k, "x", 24),
            "W5": lambda d, k: fill.impute_threshold(d, k, "x", 24, 99.0), "W8": lambda d, k: correlate.sliding_corr(d, k, "y", "x", 2)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, use in uses.items():
            got = use(stored, series)
            assert got.columns == use(rows, s).columns and sorted(map(str, got.collect())) == sorted(map(str, use(rows, s).collect())), name
            text = use(stored, series)._jdf.queryExecution().executedPlan().toString()
            assert "REPARTITION" not in text and "SelectedBucketsCount: 6 out of 6" in text, name
            # What is shuffled are chunk tables: nothing with the rows' times.
            lines = text.splitlines()
            depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
            for i, line in enumerate(lines):
                if "Exchange" in line:
                    below = next(x for x in lines[i + 1:] if depth(x) > depth(line))
                    assert "hourutc" not in below.split("[", 1)[-1] or "HashAggregate" in below or "Filter" in below, (name, line, below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="stored with"):
        fill.rolling_mean(stored, series, "x", 40)
    with pytest.raises(FileExistsError):
        write_store(rows, s, str(tmp_path), "t", "n")
    with pytest.raises(FileNotFoundError):
        read_store(spark, s, str(tmp_path), "other", "n")


def test_steps_are_removed_with_their_scope(spark, tmp_path):
    from pathlib import Path

    from meterflow.sources.storage import settled, shared_folder, steps_removed

    base = Path(shared_folder(spark))
    outside = settled(spark.range(3), "outside")
    with steps_removed(spark):
        inner = settled(spark.range(5), "inner")
        with steps_removed(spark):
            settled(spark.range(7), "innermost")
        inner.write.parquet(str(tmp_path / "result"))
        assert list(base.glob("scope-*/inner-*")) and not list(base.glob("scope-*/*/innermost-*"))
    assert not list(base.glob("scope-*")) and outside.count() == 3 and spark.read.parquet(str(tmp_path / "result")).count() == 5
    with pytest.raises(ZeroDivisionError), steps_removed(spark):
        settled(spark.range(1), "failing")
        1 / 0
    assert not list(base.glob("scope-*"))


def test_a_split_is_dealt_in_stretches(spark, tmp_path):
    """One split, as a large file has many of, goes to several tasks, and the objects keep their texts."""
    flat = [t for t in TEXTS if "}" not in t]
    records = [{"A": i, "s": flat[i % len(flat)]} for i in range(30_000)]
    (tmp_path / "one.json").write_text(json.dumps({"records": records}))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        rows = read_records(spark, str(tmp_path), "A int, s string")
        assert rows.groupBy(F.spark_partition_id().alias("p")).count().where("count > 2000").count() > 1
        assert sorted((r["A"], r["s"]) for r in rows.collect()) == [(r["A"], r["s"]) for r in records]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_document_of_repeated_and_missing_keys(spark, tmp_path):
    """The document is JSON whatever the keys, in one file, and no task sorts it."""
    from meterflow.catalog import scans
    from meterflow.catalog.views import Tables
    rows = [(k, i, "O", 1.5, None, "a}{") for i, k in enumerate([None, 3, 3, 5, None, 9])]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    written = scans._one_document(Tables(spark, str(tmp_path)).orders.select(F.to_json(scans._record()).alias("value")))
    document = json.loads("\n".join(r["value"] for r in written.collect()))
    assert sorted((r["CustKey"], r.get("OrderKey")) for r in document["records"]) == [(i, r[0]) for i, r in enumerate(rows)]
    assert "Sort" not in written._jdf.queryExecution().executedPlan().toString() and written.rdd.getNumPartitions() == 1
    got = scans.json_one_document(Tables(spark, str(tmp_path))).collect()
    assert sorted((r["CustKey"], r["OrderKey"], r["Priority"]) for r in got) == [(i, r[0], "a}{") for i, r in enumerate(rows)]
