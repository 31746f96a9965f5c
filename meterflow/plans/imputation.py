"""Imputation of the production, settlement, price and weather tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.scalars import nan_to_null
from ..operators.fill import Rule, fill_all, fill_constant, impute
from ..operators.layout import Series
from ..operators.schema import cast_columns, sort_by_time
from ..sources.schemas import WEATHER_MEASURES

# The measures, areas and windows that the results depend on.
ZERO_FILLED_PRODUCTION = ("offshorewindge100mw_mwh", "offshorewindlt100mw_mwh", "solarmwh", "thermalpowermwh")
ZERO_FILLED_PRICES = ("eexlowestpricesaledkk_kwh", "eexhighestpricepurchasedkk_kwh")
MAX_MISSING_PCT = 40.0
DAY, WEEK = 24, 168
SNOW_AREAS = ("Ærø", "Sønderborg")
PRCP_AREAS = (
    "Billund", "Horsens", "Samsø", "Kerteminde", "Frederikssund", "Odense", "Assens", "Esbjerg", "Varde", "Fanø",
    "Nyborg", "Nordfyn", "Hedensted", "Syddjurs", "Norddjurs", "Odder", "Skanderborg", "Aarhus", "Favrskov", "Rebild",
    "Aalborg", "Ikast-Brande", "Silkeborg", "Holstebro", "Jammerbugt", "Viborg", "Frederikshavn", "Bornholm",
    "Faaborg-Midtfyn", "Fredensborg", "Fredericia", "Ringkøbing-Skjern", "Herning", "Middelfart", "Roskilde", "Vejen",
    "Langeland", "Vejle", "Kolding", "Greve", "Solrød", "Svendborg", "Guldborgsund", "Haderslev", "Hjørring",
    "Hillerød", "Brøndby", "Copenhagen", "Ballerup", "Allerød", "Rødovre", "Rudersdal", "Vallensbæk", "Albertslund",
    "Brønderslev", "Herlev", "Glostrup", "Gladsaxe", "Høje-Taastrup", "Hørsholm", "Ishøj", "Egedal", "Hvidovre",
    "Gentofte", "Furesø", "Lyngby-Taarbæk", "Frederiksberg", "Tårnby", "Dragør", "Læsø", "Kalundborg", "Slagelse",
    "Sorø",
)


def weather_rules(snow_entities: tuple | None = SNOW_AREAS, prcp_entities: tuple | None = PRCP_AREAS) -> list[Rule]:
    """The weather table's rules. Snow and rain are filled only for the areas named, or for all (None)."""
    gated = [Rule(c, window=DAY, max_missing_pct=MAX_MISSING_PCT) for c in ("wpgt", "dwpt", "pres", "rhum", "temp", "wspd")]
    return [
        Rule("snow", method="forward", entities=snow_entities),
        Rule("tsun", method="keep"),
        Rule("prcp", window=DAY, entities=prcp_entities),
        Rule("coco", window=DAY, max_missing_pct=MAX_MISSING_PCT, whole=True),
        Rule("wdir", window=WEEK, max_missing_pct=MAX_MISSING_PCT),
        *gated,
    ]


def impute_weather(weather: DataFrame, s: Series, rules: Sequence[Rule] | None = None,
                   measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """Cast the measures back to numbers and fill them, all in one pass over the table."""
    typed = nan_to_null(cast_columns(weather, {c: "double" for c in measures}))
    return impute(typed, s, rules if rules is not None else weather_rules())


def impute_production(production: DataFrame, columns: Sequence[str] = ZERO_FILLED_PRODUCTION) -> DataFrame:
    """No measurement of a kind of power is taken as none produced."""
    return fill_constant(nan_to_null(production), columns)


def impute_settlement(settlement: DataFrame) -> DataFrame:
    return fill_all(nan_to_null(settlement))


def impute_price(price: DataFrame, time: str, columns: Sequence[str] = ZERO_FILLED_PRICES) -> DataFrame:
    """A day without an exchange price is a day without trade: 0."""
    return sort_by_time(fill_constant(nan_to_null(price), columns), time)
