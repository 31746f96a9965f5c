"""From landed files to the dashboard's frames, on a small country."""
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterflow import Series
from meterflow.operators import aggregates, profile, schema
from meterflow.plans import exchange, imputation, ingest, views
from meterflow.sources import schemas
from meterflow.sources.storage import new_folder
from meterflow.sources.tables import read_table, write_table

HOURS = pd.date_range("2022-01-01", periods=60, freq="h")
PAGE = ('<table class="wikitable sortable"><tr><th>LAU-1 code <sup>1</sup></th><th>Municipality</th><th>Administrative Center</th>'
        '<th>Total Area (km²)</th><th>Population (2012-01-01)</th><th>Region</th></tr>'
        '<tr><td>101</td><td>Copenhagen</td><td>Copenhagen</td><td>88.25</td><td>549,050</td><td>Hovedstaden</td></tr>'
        '<tr><td>492</td><td>Ærø</td><td>Ærøskøbing</td><td>91</td><td>6,636</td><td>Syddanmark</td></tr></table>')


def land(folder, name, records):
    (folder / name).mkdir(parents=True)
    for i in range(0, len(records), 50):
        (folder / name / f"{i}.json").write_text(json.dumps({"total": len(records), "records": records[i:i + 50]}))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    hours = [{"HourUTC": t.isoformat(), "HourDK": (t + pd.Timedelta(hours=1)).isoformat(), "i": i} for i, t in enumerate(HOURS)]
    land(landing, "production", [
        {**h, "MunicipalityNo": no, "OffshoreWindGe100MW_MWh": None, "SolarMWh": None if no == "999" else h["i"] / 2, "OnshoreWindMWh": 4.0,
         "ThermalPowerMWh": None if h["i"] % 3 else 1.5} for h in hours for no in ("101", "492", "999")])
    land(landing, "consumption", [{**h, "MunicipalityNo": no, "Branche": b, "ConsumptionkWh": 100.0 + h["i"]}
                                  for h in hours for no in ("101", "492") for b in ("Erhverv", "Privat")])
    land(landing, "prodcons", [{**h, "PriceArea": a, "ExchangeNO_MWh": (h["i"] - 30) * 2.0 if a == "DK1" else None, "ExchangeSE_MWh": 10.0,
                                "ExchangeNL_MWh": -1.0, "ExchangeGE_MWh": 0.0, "ExchangeGB_MWh": None} for h in hours for a in ("DK1", "DK2")])
    land(landing, "gas", [{"GasDay": f"2022-01-0{d}T00:00:00", "PurchasePriceDKK_kWh": 0.5 + d, "SalesPriceDKK_kWh": 0.4 + d,
                           "EEXLowestPriceSaleDKK_kWh": None if d == 2 else 0.1} for d in (3, 1, 2)])
    base = new_folder(spark, "country")
    pages = spark.createDataFrame([("<p>nothing</p>",), (PAGE,)], "html string")
    ingest.ingest_all(spark, str(landing), pages, base, "dk")
    rng = np.random.default_rng(0)
    weather = [(t.to_pydatetime(), m, *[None if rng.random() < miss else float(rng.normal(5, 2)) for _ in schemas.WEATHER_MEASURES], 1.0)
               for m, miss in (("Ærø", 0.2), ("Copenhagen", 0.7)) for t in HOURS]
    ddl = schemas.STORED["weather"].replace(", id string", "")
    write_table(spark.createDataFrame(weather, ddl), base, "weather", "dk")
    areas = spark.read.schema(schemas.STORED["municipalities"]).json(f"{base}/dk/municipalities")
    for name in ("production", "consumption"):
        ingest.enrich_writeback(spark, base, name, "dk", areas, "municipalityno", "municipalityNo", "municipality")
    return base


@pytest.fixture(scope="module")
def tables(spark, stored):
    return views.dashboard_tables(spark, stored, "dk")


def test_loaded_tables(tables):
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {"production": 120, "consumption": 240, "prodcons": 120, "gas": 3, "municipalities": 2, "weather": 120}
    row = tables["municipalities"].collect()[0]
    assert (row.municipalityNo, row.municipality, row.population, row.totalArea_km2) == (101, "Copenhagen", 549050, 88.25)
    assert [r.gasday.day for r in tables["gas"].collect()] == [1, 2, 3]
    assert "hourutc" in tables["weather"].columns and "time" not in tables["weather"].columns
    assert schema.measure_columns(tables["production"], ("id", "hourdk", "hourutc", "municipality", "municipalityno"), ordered=True) == sorted(schemas.PRODUCTION_MEASURES)
    assert tables["production"].filter("id is null").count() == 0


def test_profiles_and_zero_fill(tables):
    raw = {r.column: r.num for r in profile.missing_profile(tables["production"], columns=schemas.PRODUCTION_MEASURES).collect()}
    assert raw == {"offshorewindge100mw_mwh": 120, "offshorewindlt100mw_mwh": 120, "thermalpowermwh": 80}
    filled = imputation.impute_production(tables["production"])
    assert profile.missing_profile(filled, columns=schemas.PRODUCTION_MEASURES).count() == 0
    prices = imputation.impute_price(tables["gas"], "gasday").collect()
    assert [r.eexlowestpricesaledkk_kwh for r in prices] == [0.1, 0.0, 0.1]
    settled = imputation.impute_settlement(tables["prodcons"])
    assert settled.filter("exchangegb_mwh <> 0 or exchangegb_mwh is null").count() == 0 and settled.filter("pricearea is null").count() == 0


def test_weather(tables):
    s = Series(("municipality",), "hourutc", chunk=16, regular=True)
    before = tables["weather"]
    after = imputation.impute_weather(before, s)
    assert after.columns == before.columns and after.count() == before.count()
    gone = {(r.municipality, r.column): r.pct for r in profile.missing_pct_matrix(after, "municipality", schemas.WEATHER_MEASURES).collect()}
    was = {(r.municipality, r.column): r.pct for r in profile.missing_pct_matrix(before, "municipality", schemas.WEATHER_MEASURES).collect()}
    # Copenhagen misses too much to be filled, but for rain, which is filled by name; sunshine is left alone.
    assert all(gone[("Copenhagen", c)] == was[("Copenhagen", c)] for c in schemas.WEATHER_MEASURES if c != "prcp")
    assert ("Copenhagen", "prcp") not in gone
    assert {c for m, c in gone if m == "Ærø"} <= {"tsun", "prcp", "snow"}
    assert gone[("Ærø", "tsun")] == was[("Ærø", "tsun")] and gone[("Ærø", "prcp")] == was[("Ærø", "prcp")]
    codes = [r.coco for r in after.filter("municipality = 'Ærø'").select("coco").collect()]
    assert all(c == int(c) for c in codes)


def test_exchange(tables):
    columns = {country: measure for country, measure, *_ in exchange.COUNTRIES if measure}
    used = exchange.exchange_labels(exchange.exchange_utilisation(tables["prodcons"], "hourutc", columns))
    at = {r.country: r for r in used.filter(F.col("hourutc") == HOURS[50].to_pydatetime()).collect()}
    assert (at["Norway"].exchange, at["Norway"].capacity, at["Norway"].remaining) == (40.0, 60.0, 20.0)
    assert at["Norway"].used_label == "Export: 40.0 MWh" and at["Norway"].unused_label == "Unused: 20.0 MWh"
    assert at["Netherlands"].direction == "Import" and at["Netherlands"].utilisation == 1.0
    assert at["Germany"].capacity == 0.0 and at["Germany"].utilisation is None
    bounds = used.agg(F.min("utilisation"), F.max("utilisation"), F.min("remaining")).collect()[0]
    assert bounds[0] >= 0 and bounds[1] <= 1 and bounds[2] >= 0


def test_frames(spark, tables):
    areas = tables["municipalities"].withColumn("lat", F.lit(55.0)).withColumn("lon", F.lit(11.0))
    t = str(HOURS[10])
    spots = views.map_slice(tables["consumption"], "hourutc", t, "municipality", "consumptionkwh", "consumption", areas, "municipality", branche="Privat").collect()
    assert [s.municipality for s in spots] == ["Copenhagen", "Ærø"] and spots[0].marker == pytest.approx(110 ** 0.5 * 0.05)
    solar = views.map_slice(tables["production"], "hourutc", t, "municipality", "solarmwh", "production", areas, "municipality").collect()
    assert solar[0].marker == pytest.approx(5 ** 0.5 * 3) and solar[0].lat == 55.0
    line = views.line_view(tables["consumption"], Series(("municipality",), "hourutc"), t, "consumptionkwh", 3, municipality="Ærø", branche="Privat")
    rows = line.orderBy("hourutc").collect()
    assert len(rows) == 11 and [r.is_latest for r in rows] == [False] * 10 + [True] and all(r.smoothed_signal for r in rows)
    with pytest.raises(ValueError):
        views.line_view(tables["production"], Series(("municipality",), "hourutc"), t, "solarmwh")
    sums = {r.branche: r.consumptionkwh for r in aggregates.summary_by_group(tables["consumption"], "branche", "consumptionkwh").collect()}
    assert sums["Privat"] == sums["Erhverv"] == 2 * sum(100.0 + i for i in range(60))


def test_storing_again_replaces(spark, stored):
    areas = spark.read.schema(schemas.STORED["municipalities"]).json(f"{stored}/dk/municipalities")
    table = read_table(spark, stored, "consumption", "dk").drop("municipality")
    write_table(table, stored, "copy", "dk", insert=False, add_id=False)
    assert ingest.enrich_writeback(spark, stored, "copy", "dk", areas, "municipalityno", "municipalityNo", "municipality").count() == 240
