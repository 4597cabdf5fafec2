"""Three-valued hard filters: a listing is dropped only on a known violation; unknown data keep it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propscan.config import Config
from propscan.functions.parse import INDUSTRIAL, RELEVANT


def geography(province: Column, town: Column, targets: list[str], c: Config, distance_km: Column | None = None, radius_km: float = 30.0) -> Column:
    """Outside the target provinces, or in an excluded town. A row within ``radius_km`` of a target is inside; one whose
    province and distance are unknown is kept (see ``insufficient``)."""
    inside = province.isin(*targets)
    if distance_km is not None:
        inside = F.when(distance_km <= radius_km, F.lit(True)).otherwise(inside)
    return F.when(F.lower(town).isin(*c.excluded_towns), "PERIMETRO_GEOGRAFICO").when(~inside, "PERIMETRO_GEOGRAFICO")


def insufficient(fields: dict[str, Column]) -> Column:
    """Names of the decisive fields that are unknown: such a listing is kept, with DATI_INSUFFICIENTI."""
    return F.array_compact(F.array(*(F.when(v.isNull(), F.lit(n)) for n, v in fields.items())))


def category(kind: Column, text: Column) -> Column:
    hint = F.coalesce(F.lower(text).rlike(RELEVANT), F.lit(False))
    return F.when(kind.isNotNull() & ~kind.isin(*INDUSTRIAL) & ((kind == "garage") | ~hint), "TIPOLOGIA")


def surface(sqm: Column, confidence: Column, c: Config) -> Column:
    return F.when((sqm < c.surface_min * (1 - c.surface_tolerance)) & confidence.isin("alta", "media"), "SUPERFICIE")


def auction_time(deadline: Column, today: Column, c: Config) -> Column:
    days = F.datediff(deadline, today)
    return F.when(days < 0, "ASTA_SCADUTA").when(days < c.min_days, "TEMPO_INSUFFICIENTE")


def tenure(text: Column) -> Column:
    return F.when(F.lower(text).rlike(r"quota (di|pari a)? ?\d+/\d+|nuda propriet|diritto di superficie in scadenza"), "DIRITTO")


def planning(text: Column) -> Column:
    return F.when(F.lower(text).rlike("insanabil|vincolo di inedificabilit"), "VINCOLO")


def price_per_net(price: Column, net: Column, c: Config) -> Column:
    return F.when(F.try_divide(price, net) > c.max_price_per_net_sqm, "PREZZO_MQ")


def flags(sqm: Column, price: Column, deadline: Column, today: Column, c: Config) -> Column:
    days = F.datediff(deadline, today)
    return F.array_compact(F.array(
        F.when((sqm < c.surface_min) & (sqm >= c.surface_min * (1 - c.surface_tolerance)), "AL_LIMITE_SOGLIA"), F.when(sqm > c.surface_max, "FUORI_TAGLIA_GRANDE"),
        F.when(price < c.anomalous_price, "PREZZO_ANOMALO"), F.when(days.between(c.min_days, c.urgent_days), "URGENTE"),
    ))


def reasons(df: DataFrame, checks: list[Column]) -> DataFrame:
    """Add ``reason`` (the first violated filter) and ``all_reasons``."""
    return df.withColumn("all_reasons", F.array_compact(F.array(*checks))).withColumn("reason", F.try_element_at("all_reasons", F.lit(1)))


def first_city(text: Column, cities: list[str], whole: bool = True) -> Column:
    """The first of ``cities`` (slugs, in their order) that a slug holds, or null.

    ``whole``: the city must be hyphen-bounded or end the slug, else any substring counts.
    """
    bounded = lambda c: F.contains(F.concat(F.lit("-"), text, F.lit("-")), F.concat(F.lit("-"), c, F.lit("-"))) | F.endswith(text, c)
    hit = bounded if whole else lambda c: F.contains(text, c)
    return F.try_element_at(F.filter(F.array(*map(F.lit, cities)), hit), F.lit(1))


def path_city(path: Column, cities: list[str]) -> Column:
    """First segment of ``A > B > C`` that is one of the (lower-case) cities."""
    return F.try_element_at(F.filter(F.transform(F.split(path, ">"), lambda s: F.lower(F.trim(s))), lambda s: s.isin(*cities)), F.lit(1))


def composed(df: DataFrame, switches: dict[str, bool], predicates: dict[str, Column]) -> DataFrame:
    """Keep rows that satisfy every predicate that is switched on; a null predicate counts as false."""
    for name, on in switches.items():
        if on:
            df = df.where(F.coalesce(predicates[name], F.lit(False)))
    return df


def unknown_names(requested: DataFrame, known: DataFrame, name: str) -> DataFrame:
    return requested.select(name).distinct().join(known, name, "left_anti")


def in_searched_city(address: Column, city: Column) -> Column:
    """Whether an address names the searched city; unknown ones don't."""
    return F.coalesce(F.contains(F.lower(address), F.lower(city)), F.lit(False))


def fallback_pages(df: DataFrame, address: str, city: str, group: list[str]) -> DataFrame:
    """``group`` columns of the pages without any address that names the searched city: the site's fallback feed."""
    hits = df.groupBy(*group).agg(F.count_if(in_searched_city(F.col(address), F.col(city))).alias("_hits"))
    return hits.where("_hits = 0").drop("_hits")


def pruned(payload: Column, fields: dict[str, tuple[str, str]]) -> Column:
    """A struct of a few paths of a heavy JSON detail: name → (path, type); unreadable values are null."""
    v = F.try_parse_json(payload)
    return F.struct(*(F.try_variant_get(v, path, kind).alias(name) for name, (path, kind) in fields.items()))


#: What the evaluation reads of the richest portal's detail. Paths of its pages.
_P = "$.pageProps.detailData.realEstate.properties[0]"
DETAIL_PATHS = {
    "beam_height": (f"{_P}.industrial.underBeamHeight", "string"), "barn_height": (f"{_P}.industrial.barnHeight", "string"), "bays": (f"{_P}.industrial.bayes", "int"),
    "docks": (f"{_P}.industrial.numberLoadingDock", "int"), "floor": (f"{_P}.floor.value", "string"), "floors": (f"{_P}.floors", "string"), "features": (f"{_P}.features", "array<string>"),
    "availability": (f"{_P}.availability", "string"), "year_built": (f"{_P}.buildingYear", "int"), "condition": (f"{_P}.condition", "string"), "auction": (f"{_P}.auction", "string"),
}


def needs_detail(df: DataFrame, inside: Column) -> DataFrame:
    """Rows inside the area that lack surface, deadline or description: worth a detail page."""
    return df.where(F.coalesce(inside, F.lit(False)) & (F.col("sqm").isNull() | F.col("deadline").isNull() | (F.coalesce(F.trim("description"), F.lit("")) == "")))
