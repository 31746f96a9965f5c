"""The six stored tables: declared schemas, and which columns are times and casts on ingest."""
from __future__ import annotations

# Column names and types of the tables and payloads.
PRODUCTION_MEASURES = ("offshorewindge100mw_mwh", "offshorewindlt100mw_mwh", "onshorewindmwh", "solarmwh", "thermalpowermwh")
SETTLEMENT_MEASURES = (
    "centralpowermwh", "commercialpowermwh", "hydropowermwh", "localpowermwh", "localpowerselfconmwh",
    "offshorewindge100mw_mwh", "offshorewindlt100mw_mwh", "onshorewindge50kw_mwh", "onshorewindlt50kw_mwh",
    "powertoheatmwh", "solarpowerge10lt40kw_mwh", "solarpowerge40kw_mwh", "solarpowerlt10kw_mwh",
    "solarpowerselfconmwh", "unknownprodmwh")
EXCHANGE_MEASURES = ("exchangeno_mwh", "exchangese_mwh", "exchangenl_mwh", "exchangege_mwh", "exchangegb_mwh")
WEATHER_MEASURES = ("coco", "dwpt", "prcp", "pres", "rhum", "snow", "temp", "tsun", "wdir", "wpgt", "wspd")
PRICE_MEASURES = ("purchasepricedkk_kwh", "salespricedkk_kwh", "eexlowestpricesaledkk_kwh", "eexhighestpricepurchasedkk_kwh")


def _doubles(names) -> str:
    return ", ".join(f"{n} double" for n in names)


_HOURS = "hourutc timestamp_ntz, hourdk timestamp_ntz"

STORED = {
    "production": f"{_HOURS}, municipalityno int, {_doubles(PRODUCTION_MEASURES)}, id string",
    "consumption": f"{_HOURS}, municipalityno int, branche string, consumptionkwh double, id string",
    "prodcons": f"{_HOURS}, pricearea string, {_doubles(SETTLEMENT_MEASURES)}, {_doubles(EXCHANGE_MEASURES)}, id string",
    "gas": f"_id string, gasday timestamp_ntz, {_doubles(PRICE_MEASURES)}",
    "municipalities": "_id string, municipalityNo int, municipality string, adminCenter string, totalArea_km2 double, "
                      "population int, region string, lat double, lon double",
    "weather": f"time timestamp_ntz, municipality string, {_doubles(WEATHER_MEASURES)}, dist_to_station double, id string",
}

# Per payload: the fields (in any case), the time columns, the casts.
PAYLOADS = {
    "production": (f"hourutc string, hourdk string, municipalityno string, {_doubles(PRODUCTION_MEASURES)}",
                   ("hourutc", "hourdk"), {"municipalityno": "int"}),
    "consumption": ("hourutc string, hourdk string, municipalityno string, branche string, consumptionkwh double",
                    ("hourutc", "hourdk"), {"municipalityno": "int", "branche": "string"}),
    "prodcons": (f"hourutc string, hourdk string, pricearea string, {_doubles(SETTLEMENT_MEASURES)}, {_doubles(EXCHANGE_MEASURES)}",
                 ("hourutc", "hourdk"), {"pricearea": "string", "exchangegb_mwh": "double"}),
    "gas": (f"gasday string, {_doubles(PRICE_MEASURES)}", ("gasday",), {}),
}
DOCUMENTS = ("gas", "municipalities")

AREA_PAGE = ("`LAU-1 code 1` int, `Municipality` string, `Administrative Center` string, `Total Area (km²)` double, "
             "`Population (2012-01-01)` int, `Region` string")
AREA_NAMES = {
    "LAU-1 code 1": "municipalityNo", "Municipality": "municipality", "Administrative Center": "adminCenter",
    "Total Area (km²)": "totalArea_km2", "Population (2012-01-01)": "population", "Region": "region"}
AREA_TABLE_CLASS = "wikitable sortable"
