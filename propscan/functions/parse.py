"""Column expressions that read fields of raw listings. Unreadable input gives null, never an error."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords, province codes and formats of the listings' data contract.
RELEVANT = "capannone|magazzino|deposito"
TIME_FORMATS = ["dd/MM/yyyy - HH:mm", "dd/MM/yyyy 'h' HH:mm", "dd/MM/yyyy, HH:mm", "dd/MM/yyyy"]
#: Texts of challenge pages of the two portals that use them. Fixed values.
BLOCKED_MARKERS = ["captcha-delivery.com", "please enable js", "unusual traffic", "traffico insolito", "datadome", "accesso negato"]
CATEGORY_WORDS = [
    ("capannone", "capannon"), ("magazzino", "magazzin|deposit"), ("opificio", "opifici"), ("laboratorio", "laborator"), ("stabilimento", "stabiliment|industrial"),
    ("garage", "garage|box|autorimess"), ("terreno", "terren"), ("residenziale", "appartament|villa|abitazion|residenzial"),
]
INDUSTRIAL = ["capannone", "magazzino", "opificio", "laboratorio", "stabilimento"]
ALERTS = [("asbestos", "fibrocemento|eternit|amianto"), ("contamination", "ex galvanica|carrozzeria|distributore"), ("flood", "alluvion|esond"), ("damp", "umidità|infiltrazion")]


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def price(text: Column, source: Column | None = None) -> Column:
    """Italian amount → DECIMAL(14,2). ``31800.00`` of the dot-decimal source keeps its dot; elsewhere dots separate thousands."""
    bare = F.regexp_replace(text, "[^0-9.,]", "")
    italian = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    dotted = bare.rlike(r"^[0-9]+\.[0-9]{2}$")
    if source is not None:
        dotted = dotted & (source == "asteflorio")
    return F.when(dotted, bare.try_cast("decimal(14,2)")).otherwise(italian.try_cast("decimal(14,2)"))


def timestamp(text: Column) -> Column:
    """The formats of ``TIME_FORMATS`` and ISO."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS), text.try_cast("timestamp"))


def relative_days(text: Column) -> Column:
    """Days of ``oggi``, ``ieri``, ``poco fa``, ``un'ora``, ``un giorno``, ``N giorni``, weeks, months and years.

    Phrases are tried in that order, as whole words; others give null.
    """
    low = F.lower(text)
    number = lambda stem: F.regexp_extract(low, rf"(\d+)\s*{stem}", 1).try_cast("int")
    out = F.when(low.rlike(r"\boggi\b"), F.lit(0)).when(low.rlike(r"\bieri\b"), F.lit(1)).when(low.rlike(r"\bun'?\s*ora\b|\bpoco\s+fa\b"), F.lit(0))
    for one, stem, days in ((r"un\s+giorno", "giorn", 1), (r"una\s+settimana", "settiman", 7), (r"un\s+mese", "mes", 30), (r"un\s+anno", "ann", 365)):
        out = out.when(low.rlike(rf"\b{one}\b"), F.lit(days)).when(low.rlike(rf"\d+\s*{stem}"), number(stem) * days)
    return out


def days_ago(days: Column, now: Column) -> Column:
    """Estimated time of something ``days`` before ``now``."""
    return F.timestamp_add("DAY", -days.cast("int"), now)


def epoch(seconds: Column) -> Column:
    """Unix seconds → timestamp; out of 1970..2100 or not a number gives null."""
    n = seconds.try_cast("long")
    return F.when(n.between(0, 4_102_444_800), F.timestamp_seconds(n))


def italian_number(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(10,2)")


def surfaces(text: Column) -> Column:
    """All areas named in a text: unit after or before the number."""
    unit, number = r"(?:mq|m²|m2|metri quadr[ai]t?i?)", r"(\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+(?:,\d+)?)"
    low = F.lower(text)
    after = F.regexp_extract_all(low, F.lit(number + r"\s*" + unit), F.lit(1))
    before = F.regexp_extract_all(low, F.lit(unit + r"\s*" + number), F.lit(1))
    return F.transform(F.array_distinct(F.concat(after, before)), italian_number)


#: Words before or after an area and the kind that they tell, the one that counts for calculations first.
SURFACE_KINDS = [("coperta", "copert[aio]"), ("scoperta", "scopert[aio]"), ("commerciale", "commerciale"), ("catastale", "catastale")]


def labelled_surfaces(text: Column) -> Column:
    """``[{label, value, confidence}]`` of all areas in order of their place, each with the nearest label within 25 letters."""
    unit, number = r"(?:mq|m²|m2|metri quadr[ai]t?i?)", r"(?:\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+(?:,\d+)?)"
    low = F.lower(text)
    hits = F.regexp_extract_all(low, F.lit(rf"((?:[a-zàèéìòù.]+ ){{0,3}}(?:{number}\s*{unit}|{unit}\s*{number})(?: [a-zàèéìòù]+){{0,2}})"), F.lit(1))

    def one(hit: Column) -> Column:
        value = italian_number(F.regexp_extract(F.regexp_replace(hit, "m2", "m²"), rf"({number})", 1))
        label = F.lit(None).cast("string")
        for name, word in reversed(SURFACE_KINDS):
            label = F.when(hit.rlike(rf"(^|[^a-z]){word}"), F.lit(name)).otherwise(label)
        label = F.when(hit.rlike("scopert"), F.lit("scoperta")).otherwise(label)
        return F.struct(label.alias("label"), value.alias("value"), F.when(value.between(5, 100_000), "alta").otherwise("bassa").alias("confidence"))

    return F.filter(F.transform(hits, one), lambda m: m["value"].isNotNull())


def surface(text: Column) -> Column:
    """The built-up area if one is labelled so, else the first: ``value, origin, confidence``, low outside 5..100,000 m²
    and where several areas without a label differ."""

    def best(found: Column) -> Column:
        built = F.filter(found, lambda m: m["label"] == "coperta")
        first = F.try_element_at(F.when(F.size(built) > 0, built).otherwise(F.filter(found, lambda m: F.coalesce(m["label"], F.lit("")) != "scoperta")), F.lit(1))
        value = first["value"]
        unsure = (F.size(built) == 0) & (F.size(F.array_distinct(F.transform(found, lambda m: m["value"]))) > 1)
        confidence = F.when(value.between(5, 100_000) & ~F.coalesce(unsure, F.lit(False)), F.lit("alta")).when(value.isNotNull(), F.lit("bassa"))
        return F.struct(value.alias("value"), F.when(value.isNotNull(), F.lit("regex_testo")).alias("origin"), confidence.alias("confidence"))

    return F.transform(F.array(labelled_surfaces(text)), best)[0]  # the areas are found once


def item_details(details: Column) -> Column:
    """``{area, area_price}`` of a card's details: the first that names an area, and the first price an area."""
    low = lambda d: F.replace(F.lower(d), F.lit("\xa0"), F.lit(" "))
    area = F.filter(details, lambda d: low(d).rlike("m²|m2") & ~F.contains(d, F.lit("/")))
    price_of = F.filter(details, lambda d: low(d).rlike("/m²|/m2"))
    return F.struct(F.try_element_at(area, F.lit(1)).alias("area"), F.try_element_at(price_of, F.lit(1)).alias("area_price"))


def height(text: Column) -> Column:
    """Metres within 2..20, else null."""
    value = F.replace(F.regexp_extract(text, r"(\d+(?:[.,]\d+)?)\s*m", 1), F.lit(","), F.lit(".")).try_cast("decimal(6,2)")
    return F.when(value.between(2, 20), value)


def best_height(beam: Column, barn: Column, text: Column) -> Column:
    """``value, origin``: height under the beam, else of the barn, else what the text says after ``altezza`` or ``h``."""
    stated = height(F.regexp_extract(F.lower(text), r"(?:altezza(?: utile| interna| sotto ?trave)?|\bh\.?)\s*(?:di |pari a |:)?\s*(?:m\.?|mt\.?|metri)?\s*(\d+(?:[.,]\d+)?\s*m)", 1))
    first, second = height(beam), height(barn)
    value = F.coalesce(first, second, stated)
    return F.struct(value.alias("value"), F.when(first.isNotNull() | second.isNotNull(), F.lit("raw_detail")).when(stated.isNotNull(), F.lit("regex_testo")).alias("origin"))


#: Names of provinces that texts spell out, and their codes. The provinces of the 36 target towns.
PROVINCES = {
    "alessandria": "AL", "ancona": "AN", "asti": "AT", "bergamo": "BG", "bologna": "BO", "brescia": "BS", "cagliari": "CA", "como": "CO", "cremona": "CR",
    "cuneo": "CN", "ferrara": "FE", "firenze": "FI", "forli-cesena": "FC", "genova": "GE", "lecco": "LC", "livorno": "LI", "lodi": "LO", "lucca": "LU",
    "mantova": "MN", "milano": "MI", "modena": "MO", "monza e della brianza": "MB", "monza e brianza": "MB", "novara": "NO", "padova": "PD", "parma": "PR",
    "pavia": "PV", "piacenza": "PC", "pisa": "PI", "prato": "PO", "ravenna": "RA", "reggio emilia": "RE", "rimini": "RN", "roma": "RM", "rovigo": "RO",
    "savona": "SV", "torino": "TO", "trento": "TN", "treviso": "TV", "trieste": "TS", "udine": "UD", "varese": "VA", "venezia": "VE", "verona": "VR", "vicenza": "VI",
}


def province(text: Column, names: dict[str, str] | None = None) -> Column:
    """The first ``(XX)``, else the code of a province that is spelt out after ``provincia di`` or is the whole text."""
    table = F.create_map(*(F.lit(x) for kv in (names or PROVINCES).items() for x in kv))
    bare = F.lower(F.trim(text))
    spelt = F.regexp_extract(bare, "provincia di ([a-zàèéìòù' -]+)", 1)
    known = sorted(names or PROVINCES, key=len, reverse=True)
    first = F.regexp_extract(F.replace(spelt, F.lit("ì"), F.lit("i")), "^(" + "|".join(known) + ")\\b", 1)
    return F.coalesce(empty_to_null(F.regexp_extract(text, r"\(([A-Z]{2})\)", 1)), table[first], table[bare])


def town(text: Column) -> Column:
    """Last segment of ``Region > Province > Town``, else what stands before ``(XX)``."""
    path = F.trim(F.element_at(F.split(text, ">"), -1))
    return F.when(text.contains(">"), path).otherwise(town_before_code(text))


def town_before_code(text: Column) -> Column:
    """The words with a capital before ``(XX)``, after the last comma or dash."""
    return empty_to_null(F.trim(F.regexp_extract(text, r"([^(,>|-]*)\([A-Z]{2}\)", 1)))


def resolved_town(field: Column, address: Column, title: Column, path: Column, city: Column) -> Column:
    """``value, origin, confidence`` by five ways in order: the town's own field; ``Town (XX)`` in the address, then the
    title; the last segment of a path; ``… a Zone, Town`` in a title; the city that was searched, with low confidence."""
    ways = [
        (empty_to_null(F.trim(field)), "json", "alta"), (town_before_code(address), "regex_testo", "alta"), (town_before_code(title), "regex_testo", "alta"),
        (empty_to_null(F.trim(F.element_at(F.split(path, ">"), -1))), "json", "alta"),
        (empty_to_null(F.trim(F.regexp_extract(title, r"\ba [^,]+, *([^,()]+)$", 1))), "regex_testo", "media"), (empty_to_null(F.trim(city)), "json", "bassa"),
    ]
    return F.coalesce(*(F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(o).alias("origin"), F.lit(c).alias("confidence"))) for v, o, c in ways))


def is_target_town(name: Column, towns: list[str]) -> Column:
    """Whether a trimmed name is one of the towns, ignoring case; a null is not."""
    return F.coalesce(F.lower(F.trim(name)).isin(*[t.lower() for t in towns]), F.lit(False))


def in_target_province(text: Column, codes: list[str]) -> Column:
    """Whether the first ``(XX)`` is one of the codes; a text without one is not."""
    return F.coalesce(F.regexp_extract(text, r"\(([A-Z]{2})\)", 1).isin(*codes), F.lit(False))


def procedure(text: Column) -> Column:
    """``N/YYYY``."""
    return empty_to_null(F.regexp_extract(text, r"(\d+/\d{4})", 1))


def court(text: Column) -> Column:
    """``Tribunale di X``, without words that begin in lower case behind the name."""
    greedy = F.regexp_extract(text, r"(Tribunale di (?:(?:dell'|nell'|l')?[A-ZÀ-Ú][\w']*|(?:di|del|della|in|nel|sul|e) )(?: (?:[A-ZÀ-Ú][\w']*|(?:di|del|della|in|nel|sul|e) [A-ZÀ-Ú][\w']*))*)", 1)
    return empty_to_null(F.trim(greedy))


def minimum_offer(text: Column) -> Column:
    """Amount after ``Offerta minima``, as a text."""
    return empty_to_null(F.regexp_extract(text, r"Offerta minima:?\s*\|?\s*€\s?([\d.]+,\d{2})", 1))


def auction_date(text: Column) -> Column:
    """The first ``dd/MM/yyyy - HH:mm``, as a text."""
    return empty_to_null(F.regexp_extract(text, r"(\d{2}/\d{2}/\d{4}\s*-\s*\d{2}:\d{2})", 1))


def identity_key(court: Column, proc: Column, lot: Column) -> Column:
    """Court, procedure and lot normalised; null if court or procedure is unknown."""
    clean = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.when(court.isNotNull() & proc.isNotNull(), F.concat_ws("|", clean(court), clean(proc), F.coalesce(clean(lot.cast("string")), F.lit("?"))))


@cache
def _plain_letters() -> tuple[str, str]:
    """Letters whose compatibility decomposition is one letter or digit with marks, and that letter."""
    found = {}
    for c in (chr(x) for x in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x2190), *range(0xFF00, 0xFF5F))):
        bare = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(bare) == 1 and bare.isalnum():
            found[c] = bare
    return "".join(found), "".join(found.values())


def slug(text: Column) -> Column:
    """Lower-case letters and digits with one hyphen between; accents go, other letters outside ASCII are dropped."""
    plain = F.regexp_replace(F.translate(text, *_plain_letters()), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "-"), F.lit("-"))


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))


def description(raw: Column) -> Column:
    """Text of a description that is a JSON string, or an object with ``text``, ``html``, ``description`` or ``value`` (tags
    go); a bare text stays, other values give their JSON."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    inner = F.coalesce(*(F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) == "STRING", F.try_variant_get(v, f"$.{k}", "string")) for k in ("text", "html", "description", "value")))
    of_object = F.when(inner.isNotNull(), F.trim(F.regexp_replace(inner, "<[^>]+>", " "))).otherwise(raw)
    return F.when(v.isNull(), raw).when(kind == "VOID", F.lit(None)).when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("OBJECT"), of_object).otherwise(raw)


def text_parts(text: Column, separator: str = "|") -> Column:
    """Trimmed parts between separators, without empty ones."""
    return F.filter(F.transform(F.split(text, F.lit("\\Q" + separator + "\\E")), lambda x: F.trim(x)), lambda x: x != "")


def nth_part(text: Column, n: int, separator: str = "|") -> Column:
    """The ``n``-th part from 1, or null."""
    return F.try_element_at(text_parts(text, separator), F.lit(n))


def joined_parts(parts: Column, separator: str = " | ") -> Column:
    """Parts that aren't blank, with a separator between."""
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), separator)


def is_relevant(*texts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *texts)).rlike(RELEVANT)


def category(text: Column) -> Column:
    low, out = F.lower(text), F.when(text.isNull(), F.lit(None).cast("string"))
    for name, words in CATEGORY_WORDS:
        out = out.when(low.rlike(words), F.lit(name))
    return out.otherwise(F.lit("altro"))


def alerts(text: Column) -> Column:
    return F.array_compact(F.array(*(F.when(F.lower(text).rlike(w), F.lit(n)) for n, w in ALERTS)))


def absolute_url(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).when(href.startswith("/"), F.concat(F.lit(base.rstrip("/")), href)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), href))


#: Source → pattern of a listing's address: id, and what tells its category or title. Fixed values.
URL_PATTERNS = {
    "asteannunci": (r"/aste/(\d+)/\d+/(.*)$", 1, 2), "caseasta": (r"/([a-z\-]+)/(\d+)$", 2, 1), "medianord": (r"(?i)/([a-z\-]*)/?([a-z]\d+(?:-[a-z0-9]+)?)/?$", 2, 1),
    "asteflorio": (r"-(\d+)\.html$", 1, 0), "astalegale": (r"/Aste/Detail/([A-Z0-9]+)-(.+)$", 1, 2), "idealista": (r"/immobile/(\d+)/", 1, 0),
    "immobiliare": (r"/annunci/(\d+)/", 1, 0),
}


def url_parts(url: Column, source: str) -> Column:
    """``id, rest`` of a listing's address: its number or code, and the slug or category in it; the id is the whole
    address where the pattern doesn't fit."""
    pattern, at, rest = URL_PATTERNS[source]
    found = empty_to_null(F.regexp_extract(url, pattern, at))
    return F.struct(F.coalesce(found, url).alias("id"), (empty_to_null(F.regexp_extract(url, pattern, rest)) if rest else F.lit(None).cast("string")).alias("rest"))


def slug_category(rest: Column) -> Column:
    """The first letters of a slug: ``Magazzino-Via-Piave`` → ``Magazzino``."""
    return empty_to_null(F.regexp_extract(rest, r"^([A-Za-z]+)", 1))


def listing_number(key: Column) -> Column:
    return empty_to_null(F.regexp_extract(key, r"(\d+)$", 1))


def is_blocked(html: Column) -> Column:
    """Whether a page holds one of ``BLOCKED_MARKERS``; a null doesn't."""
    return F.coalesce(F.lower(html).rlike("|".join(re.escape(m) for m in BLOCKED_MARKERS)), F.lit(False))


def sale_type(channel: Column, auction: Column, title: Column) -> Column:
    """``asta`` for the auction channel, an embedded auction object or a title that says so, else ``vendita``."""
    by_text = F.coalesce(F.lower(title).rlike(r"\basta\b|\baste\b"), F.lit(False))
    return F.when(F.coalesce(channel == "ASTE", F.lit(False)) | (auction.isNotNull() & (F.lower(F.trim(auction)) != "null")) | by_text, F.lit("asta")).otherwise(F.lit("vendita"))


#: Attribute → pattern of its explicit mention and the group that holds a value (0: the mention itself). Fixed values.
ATTRIBUTES = {
    "floors": (r"(?:su|disposto su|articolato su) (\d+) piani|(\d+) piani fuori terra", 1), "office_share": (r"uffici[^.%]{0,40}?(\d{1,2}) ?%", 1),
    "yard_sqm": (r"(?:piazzale|area esterna|corte)[^.\d]{0,30}(\d{1,3}(?:\.\d{3})+|\d+) ?(?:mq|m²)", 1), "driveway": (r"(passo carrabile|accesso carrabile|accesso carraio)", 1),
    "dock": (r"(banchin[ae]|ribalt[ae]|baie? di carico)", 1), "gate": (r"(porton[ei])", 1), "zoning": (r"(?:zona|destinazione urbanistica|zto)[: ]+\"?([a-z]\d(?:[./]\d)?)\b", 1),
    "abuse": (r"(difformit[àa]|abus[oi] edilizi[oi]?|abusiv[oi]|non sanat[oi])", 1), "asbestos": (r"(amianto|eternit|fibrocemento)", 1),
    "occupied": (r"(?:immobile|bene|capannone|attualmente) (?:risulta |è )?(libero|occupato|locato)", 1),
    "tenure": (r"(piena propriet[àa]|nuda propriet[àa]|quota (?:indivisa )?(?:di |pari a )?\d+/\d+|diritto di superficie)", 1),
}


def attributes(text: Column) -> Column:
    """Map of the attributes that a text states explicitly: name → words or number; nothing is inferred."""
    low = F.lower(text)
    pairs = []
    for name, (pattern, group) in ATTRIBUTES.items():
        value = F.regexp_extract(low, pattern, group)
        if name == "floors":
            value = F.coalesce(empty_to_null(value), F.regexp_extract(low, pattern, 2))
        pairs.append(F.when(value != "", F.struct(F.lit(name).alias("key"), value.alias("value"))))
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def tagged(value: Column, origin: str, confidence: str) -> Column:
    """Field with provenance; origin and confidence only where there is a value."""
    known = value.isNotNull()
    return F.struct(value.alias("value"), F.when(known, F.lit(origin)).alias("origin"), F.when(known, F.lit(confidence)).alias("confidence"))


def richness(*columns: Column) -> Column:
    """How many of the columns are known."""
    out = F.lit(0)
    for c in columns:
        out = out + c.isNotNull().cast("int")
    return out


def italian_amount(x: Column, digits: int = 0) -> Column:
    """``144.000,00``; halves go up."""
    return F.translate(F.format_number(F.round(x, digits), digits), ",.", ".,")


def report_name(day: Column) -> Column:
    return F.date_format(day, "'report_'yyyy_MM_dd'.json'")


def days_between(later: Column, earlier: Column, mode: str = "forward") -> Column:
    """Days as a double; ``abs`` ignores the direction."""
    days = F.timestamp_diff("SECOND", earlier, later) / 86400
    return F.abs(days) if mode == "abs" else days
