"""Tables from raw pages: cards by layout, JSON-LD, embedded state, serialised texts, key-value details."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propscan.functions import parse
from propscan.storage import written

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Part:
    """An element by tag, class and attribute; ``*`` is any tag. Its text counts, or its attribute ``take``."""

    tag: str = "*"
    cls: str | None = None
    attr: str | None = None
    take: str | None = None

    def fits(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return self.tag in ("*", tag) and (self.cls is None or self.cls in (attrs.get("class") or "").split()) and (self.attr is None or self.attr in attrs)


@dataclass(frozen=True)
class Layout:
    """How a portal prints its cards: the card's element, the fields in it, and an attribute of the card itself."""

    card: Part
    fields: dict[str, Part] = field(default_factory=dict)


class _Cards(HTMLParser):
    """Texts, first link, attributes and fields of every card; cards in cards belong to the outer one."""

    def __init__(self, layout: Layout):
        super().__init__()
        self.layout = layout
        self.cards: list[tuple[str, str | None, dict[str, str]]] = []
        self.open: list[tuple[str, list[str]]] = []  # tags inside the card, with the fields that begin there
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        if not self.open:
            if not self.layout.card.fits(tag, found):
                return
            self.text, self.href, self.fields = [], found.get("href"), {k: [v or ""] for k, v in found.items() if k.startswith("data-")}
        elif tag == "a" and self.href is None:
            self.href = found.get("href")
        begun = []
        for name, part in self.layout.fields.items():
            if name not in self.fields and part.fits(tag, found):
                if part.take:
                    if found.get(part.take):
                        self.fields[name] = [found[part.take] or ""]
                else:
                    self.fields[name] = []
                    begun.append(name)
        if tag not in _VOID:
            self.open.append((tag, begun))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        at = max((i for i, (t, _) in enumerate(self.open) if t == tag), default=-1)
        if at >= 0:
            del self.open[at:]
            if not self.open:
                self.cards.append((" | ".join(self.text), self.href, {k: " ".join(v) for k, v in self.fields.items()}))

    def handle_data(self, data):
        words = " ".join(data.split())
        if self.open and not self.skip and words:
            self.text.append(words)
            for _, begun in self.open:
                for name in begun:
                    self.fields[name].append(words)

    def close(self):
        super().close()
        if self.open:  # the page ends inside a card
            self.cards.append((" | ".join(self.text), self.href, {k: " ".join(v) for k, v in self.fields.items()}))


def layout_cards(pages: DataFrame, layout: Layout) -> DataFrame:
    """``page_id, position, text, href, fields``, one row a card; a null page has none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for page, html in zip(f["page_id"], f["html"], strict=True):
                parser = _Cards(layout)
                parser.feed(html or "")
                parser.close()
                rows += [(page, i, *card) for i, card in enumerate(parser.cards)]
            yield pd.DataFrame(rows, columns=["page_id", "position", "text", "href", "fields"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, position int, text string, href string, fields map<string,string>")


def cards(pages: DataFrame, tag: str, cls: str | None = None) -> DataFrame:
    """``page_id, position, text, href``, one row an element with a tag (and class)."""
    return layout_cards(pages, Layout(Part(tag, cls))).drop("fields")


#: Portal → its cards. Tags, classes and attributes of the portals' own pages.
LAYOUTS = {
    "asteannunci": Layout(Part("a", attr="href")),
    "caseasta": Layout(Part("a", "card-immobile"), {"title": Part("p", "titolo"), "price": Part("p", "prezzo"), "address": Part("p", "info"), "description": Part("p", "descrizione")}),
    "fallcoaste": Layout(
        Part("article", attr="data-auction-id"),
        {"title": Part("a", attr="title", take="title"), "heading": Part("h3"), "court_text": Part("*", "trib-info"), "price_text": Part("*", "price-block"), "deadline_text": Part("*", "cd-block")},
    ),
    "medianord": Layout(Part("div", "offer_box"), {"link": Part("a", "trigger_zoom", take="href"), "tag": Part("span", "top_tag"), "place": Part("div", "place"), "kind": Part("h6")}),
    "worldcapital": Layout(Part("article", "rh_list_card"), {"link": Part("a", attr="aria-label", take="href"), "label": Part("a", attr="aria-label", take="aria-label"), "status": Part("*", "rh_label__status")}),
    "astalegale": Layout(Part("div", "card"), {"link": Part("a", attr="href", take="href")}),
    "idealista": Layout(
        Part("article", attr="data-element-id"),
        {"link": Part("a", "item-link", take="href"), "title": Part("a", "item-link"), "price": Part("span", "item-price"), "area": Part("span", "item-detail"), "zone": Part("*", "item-detail-location"), "agency": Part("img", attr="alt", take="alt"), "description": Part("*", "item-description")},
    ),
}


def _columns(source: str) -> dict[str, Column]:
    """Columns of a portal's cards: ``id, href, title, address, price, sqm, court, procedure, deadline, description, in_sale``."""
    text, href, f = F.col("text"), F.col("href"), lambda name: parse.empty_to_null(F.trim(F.col("fields")[name]))
    first = lambda x, pattern, i=1: parse.empty_to_null(F.regexp_extract(x, pattern, i))
    amount = r"([\d.]+,\d{2})"
    out: dict[str, Column] = {"id": parse.url_parts(href, source)["id"] if source in parse.URL_PATTERNS else F.lit(None), "href": href, "description": text}
    if source == "asteannunci":
        second = parse.nth_part(text, 2)
        out |= {
            "title": parse.nth_part(text, 1), "address": F.when(~F.lower(second).startswith("prezzo"), second), "price": first(text, rf"Prezzo base:.*?{amount}"), "court": parse.court(text),
            "procedure": first(text, r"Proc\.?\s*([\d/]+)"), "deadline": parse.auction_date(text), "code": F.coalesce(first(text, r"Codice inserzione:\s*(\d+)"), out["id"]),
        }
    elif source == "caseasta":
        out |= {n: f(n) for n in ("title", "price", "address", "description")}
    elif source == "fallcoaste":
        title = F.coalesce(f("title"), f("heading"))
        court_text = F.coalesce(f("court_text"), text)
        out |= {
            "id": f("data-auction-id"), "title": title, "court": parse.court(court_text), "procedure": first(court_text, r"Procedura\s*n\.?\s*([\d/]+)"),
            "price": F.coalesce(first(f("price_text"), rf"{amount}"), first(text, rf"Prezzo base\s*€?:?\s*\|?\s*{amount}")), "deadline": F.coalesce(f("deadline_text"), f("data-auction-data-termine")),
            "sqm": F.coalesce(first(title, r"(?i)mq\.?\s*(\d[\d.,]*\d|\d)"), first(title, r"(?i)(\d[\d.,]*\d|\d)\s*mq\b")),
        }
    elif source == "medianord":
        link = F.coalesce(f("link"), href)
        out |= {
            "id": parse.url_parts(link, source)["id"], "href": link, "title": f("kind"), "address": f("place"), "sqm": first(text, r"([\d.]+)\s*mq"), "price": first(text, r"€\s*([\d.]+)"),
            "code": first(text, r"Cod\.\s*\|?\s*([\w.\-]+)"), "in_sale": F.coalesce(F.lower(f("tag")).contains("vendita"), F.lit(False)),
        }
    elif source == "worldcapital":
        title = parse.strip_tags(f("label"))
        out |= {
            "id": f("data-rh-id"), "href": f("link"), "title": title, "description": title, "sqm": first(title, r"(?i)([\d.]+)\s*mq"), "code": first(title, r"(?i)rif\.?\s*([\w\-]+)"),
            "in_sale": F.coalesce(F.lower(f("status")).contains("vendita"), F.lit(False)),
        }
    elif source == "astalegale":
        link = f("link")
        slug = parse.url_parts(link, source)["rest"]
        out |= {
            "id": parse.url_parts(link, source)["id"], "href": link, "title": F.replace(slug, F.lit("-"), F.lit(" ")), "category": parse.slug_category(slug), "price": first(text, rf"€\s?{amount}"),
            "minimum_offer": parse.minimum_offer(text), "court": parse.court(text), "deadline": parse.auction_date(text),
        }
    elif source == "idealista":
        out |= {"id": F.coalesce(f("data-element-id"), out["id"]), "href": F.coalesce(f("link"), href), **{n: f(n) for n in ("title", "price", "description", "agency")}, "address": f("zone"), "sqm": f("area")}
    return out


#: Columns of ``portal_cards``, with nulls where a portal doesn't print them.
CARD_COLUMNS = ["id", "href", "title", "category", "address", "price", "minimum_offer", "sqm", "court", "procedure", "deadline", "code", "agency", "description", "in_sale"]


def portal_cards(pages: DataFrame, source: str) -> DataFrame:
    """Cards of a portal's list pages: ``page_id, position, source`` and ``CARD_COLUMNS``, texts as printed (``in_sale`` boolean).

    Cards whose link isn't a listing's are left out; of cards of one id in a page the first counts.
    """
    found = layout_cards(pages, LAYOUTS[source])
    known = _columns(source)
    kind = lambda n: "boolean" if n == "in_sale" else "string"
    rows = found.select("page_id", "position", F.lit(source).alias("source"), *[known.get(n, F.lit(None)).cast(kind(n)).alias(n) for n in CARD_COLUMNS])
    if source in ("asteannunci", "caseasta", "astalegale"):
        rows = rows.where(F.col("href").rlike(parse.URL_PATTERNS[source][0]))
    rows = rows.where("id is not null and href is not null")
    firsts = rows.groupBy("page_id", "id").agg(F.min("position").alias("position"))
    return rows.join(firsts, ["page_id", "id", "position"], "left_semi").select("page_id", "position", "source", *CARD_COLUMNS)


def scripts(html: Column, kind: str) -> Column:
    """Bodies of script blocks of a type."""
    return F.regexp_extract_all(html, F.lit(rf'(?s)<script[^>]*type="{kind}"[^>]*>(.*?)</script>'), F.lit(1))


def json_ld(pages: DataFrame) -> DataFrame:
    """``page_id, url, name, description`` of the items of JSON-LD lists."""
    blocks = pages.select("page_id", F.explode(scripts(F.col("html"), "application/ld\\+json")).alias("body"))
    items = blocks.select("page_id", F.explode(F.from_json("body", "itemListElement array<struct<url string, name string, description string, item struct<url string, name string, description string>>>")["itemListElement"]).alias("i"))
    return items.select("page_id", *[F.coalesce(f"i.{c}", f"i.item.{c}").alias(c) for c in ("url", "name", "description")])


def json_ld_descriptions(pages: DataFrame) -> DataFrame:
    """``page_id, url, description`` of JSON-LD blocks, each an object or an array of objects; blank descriptions are left out."""
    blocks = pages.select("page_id", F.explode(scripts(F.col("html"), "application/ld\\+json")).alias("body"))
    objects = F.when(F.trim("body").startswith("["), F.from_json("body", "array<struct<url string, description string>>")).otherwise(F.array(F.from_json("body", "url string, description string")))
    rows = blocks.select("page_id", F.explode(objects).alias("o")).select("page_id", "o.url", F.trim("o.description").alias("description"))
    return rows.where("url is not null and description <> ''")


#: The embedded state of a page. Fixed value: the page's own marker.
_STATE = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'


def found_keys(rows: DataFrame, key_col: str, json_col: str, name: str) -> DataFrame:
    """``<key_col>, path, value`` of all fields called ``name`` in JSON documents, at any depth, in document order of ``path``.

    A level is one ``posexplode`` over objects and arrays; what is a hit or holds more is written and opened next, until
    nothing holds more. Strings that look like JSON count as such.
    """
    low = F.ltrim("value")
    container = low.startswith("{") | low.startswith("[")
    items = F.transform(F.from_json("value", "array<string>"), lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")))
    entries = F.when(low.startswith("{"), F.map_entries(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}))).otherwise(items)
    level = rows.select(F.col(key_col), F.array().cast("array<int>").alias("path"), F.col(json_col).alias("value"))
    out = None
    while True:
        opened = level.where(container).select(key_col, "path", F.posexplode(entries).alias("_at", "_e"))
        opened = opened.select(key_col, F.concat("path", F.array("_at")).alias("path"), F.col("_e.value").alias("value"), F.coalesce(F.col("_e.key") == name, F.lit(False)).alias("_hit"))
        level = written(opened.where(F.col("_hit") | container), "json-level")
        hits = level.where("_hit").drop("_hit")
        out = hits if out is None else out.unionByName(hits)
        if level.where(container).isEmpty():
            return out
        level = level.drop("_hit")


def app_state(pages: DataFrame) -> DataFrame:
    """``page_id, position, payload``: the listings of a page's embedded state.

    They are the elements' ``realEstate`` of the first ``results`` list whose first element has one; where no such list is left,
    by a change of the page's schema, every ``realEstate`` found anywhere.
    """
    state = pages.select("page_id", F.regexp_extract("html", _STATE, 1).alias("state")).where("state <> ''")
    lists = found_keys(state, "page_id", "state", "results").withColumn("items", F.from_json("value", "array<string>"))
    lists = lists.where(F.get_json_object(F.try_element_at("items", F.lit(1)), "$.realEstate").isNotNull())
    first = lists.groupBy("page_id").agg(F.min_by("items", "path").alias("items"))
    usual = first.select("page_id", F.posexplode("items").alias("position", "item")).select("page_id", "position", F.get_json_object("item", "$.realEstate").alias("payload")).where("payload is not null")
    drifted = found_keys(state.join(first, "page_id", "left_anti"), "page_id", "state", "realEstate")
    order = F.transform(F.array_sort(F.collect_list(F.struct("path", "value"))), lambda x: x["value"])
    rest = drifted.groupBy("page_id").agg(order.alias("items")).select("page_id", F.posexplode("items").alias("position", "payload"))
    return usual.unionByName(rest)


def search_documents(docs: DataFrame, value: str = "value") -> DataFrame:
    """Flat records of search-API documents: fields at the top, of the sale, of the procedure, texts and sites joined.

    Fields that have another shape than expected are null, and goods may be a list or one text.
    """
    get = lambda *ps: F.coalesce(*(parse.empty_to_null(F.get_json_object(value, p)) for p in ps))
    sale, case = "$.datiVendita", "$.datiProcedura.proceduraGiudiziaria"
    goods = get("$.descrizioneBeni")
    url = get("$.urlInserzione.url")
    sites = F.from_json(get("$.siti"), "array<struct<url string>>")
    return docs.select(
        get("$.idInserzioneEspVendita", "$.id").alias("id"), get("$.urlInserzioneH1").alias("title"), F.concat(F.lit("https://www.venditegiudiziarieitalia.it"), url).alias("url"),
        get("$.citta").alias("town_path"), get("$.regione").alias("region"), get("$.tribunale").alias("court"), get(f"{case}.numeroProcedura").alias("procedure_number"),
        get(f"{case}.annoProcedura").alias("procedure_year"), get("$.category").alias("category"), get("$.subcategory").alias("subcategory"), get(f"{sale}.prezzoValoreBase").alias("price"),
        get(f"{sale}.offertaMinima").alias("minimum_offer"), get(f"{sale}.dataOraVendita").alias("sold_at"), get(f"{sale}.terminePresentazioneOfferte").alias("deadline"),
        F.when(goods.startswith("["), F.array_join(F.from_json(goods, "array<string>"), " | ")).otherwise(goods).alias("description"),
        F.coalesce(F.filter(F.transform(sites, lambda s: s["url"]), lambda u: F.coalesce(u, F.lit("")) != ""), F.array().cast("array<string>")).alias("also_on"),
    )


def detail(html: Column, label: str) -> Column:
    """Value after ``Label:`` in a page's text."""
    return F.nullif(F.trim(F.regexp_extract(F.regexp_replace(html, "<[^>]+>", "\n"), rf"(?i){label}\s*:?\s*([^\n]+)", 1)), F.lit(""))


#: A serialised description that names a size, and a listing's id soon behind it. Fixed value: the portal's own form.
_DESCRIBED = r'"(-\s*[^"]{20,700}?consistenza[^"]{0,400}?)"(?=([\s\S]{0,300}))'


def described_ids(pages: DataFrame) -> DataFrame:
    """``page_id, id, sqm, appraisal, description``: texts that name a size (``consistenza … mq``) in a page's serialised state, each
    with the first id (a letter and 6 to 8 digits in quotes) within the next 300 characters; of an id's texts the first counts."""
    pattern, html = F.lit(_DESCRIBED), F.col("html")
    pairs = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("raw"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("tail"))
    rows = pages.select("page_id", F.posexplode(pairs).alias("at", "p")).select("page_id", "at", "p.raw", F.regexp_extract("p.tail", r'"([A-Z]\d{6,8})"', 1).alias("id")).where("id <> ''")
    first = rows.groupBy("page_id", "id").agg(F.min_by("raw", "at").alias("raw"))
    text = F.coalesce(F.from_json(F.concat(F.lit('{"t":"'), "raw", F.lit('"}')), "t string")["t"], F.replace(F.replace("raw", F.lit("\\n"), F.lit(" ")), F.lit("\\u002F"), F.lit("/")))
    number = lambda before, after: parse.empty_to_null(F.regexp_extract("text", rf"(?i){before}\s*([\d.,]+){after}", 1))
    return first.withColumn("text", text).select("page_id", "id", number("consistenza", r"\s*mq").alias("sqm"), number(r"valore in\s*perizia", "").alias("appraisal"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("description"))


def longer(a: Column, b: Column) -> Column:
    return F.when(F.length(a) > F.coalesce(F.length(b), F.lit(0)), a).otherwise(b)
