"""Queries over raw material: pages, snapshots, logs and texts that Spark prints from the given tables, and read back.

Pages and files are printed as the portals print them; the SQL knows nothing of them and tells what must be read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from propscan.functions import parse as P
from propscan.operators import audits as A
from propscan.operators import filters as X
from propscan.operators import joins as J
from propscan.plans.demo import facts, listings, table
from propscan.plans.expected import FACTS_SQL, L
from propscan.plans.registry import query
from propscan.sources import pages as Pages
from propscan.sources import snapshots as Snap
from propscan.storage import written

_PER_PAGE = 20
_AMOUNT = "translate(format_number(price, 2), ',.', '.,')"
_DAY = "date_format(deadline, 'dd/MM/yyyy')"
#: Portal → its card of one listing, in Spark SQL: what ``Pages.LAYOUTS`` reads.
_PRINTED = {
    "asteannunci": f"""concat('<div><a href="/aste/', number, '/77/capannone-a-', town, '"><b>Capannone industriale</b><span>Via Roma 1, ', initcap(town), ' (MI)</span><i>Prezzo base: € ', {_AMOUNT},
        '</i><i>', {_DAY}, ' - 15:30</i><i>Tribunale di Busto Arsizio</i><i>Proc. ', procedure, '</i><i>Codice inserzione: ', number + 9, '</i></a><a href="/chi-siamo/">Chi siamo</a></div>')""",
    "caseasta": f"""concat('<a class="box card-immobile" href="https://www.caseasta.it/capannoni/', number, '"><img src="x.png"><p class="titolo">Capannone &amp; uffici</p><p class="prezzo">€ ', {_AMOUNT}, '</p><p class="info">Via Po<br>',
        initcap(town), '</p><p class="descrizione">Bene di mq ', number % 900 + 100, '</p></a>')""",
    "fallcoaste": f"""concat('<article data-auction-id="', number, '" data-auction-data-termine="', {_DAY}, ' 12:00"><a href="/vendita/', number, '" title="Deposito di ', number % 900 + 100, ' mq"><h3>Deposito</h3></a>',
        '<span class="trib-info">Tribunale di Monza in forza di sentenza <em>Procedura n. ', procedure, '</em></span><span class="price-block"><strong>', {_AMOUNT}, ' €</strong></span>',
        case when number % 20 = 3 then concat('<div class="cd-block"><strong>', {_DAY}, ' h 12:00</strong></div>') else '' end, '</article>')""",
    "medianord": f"""concat('<div class="offer_box"><a class="trigger_zoom" href="/capannoni/v', number, '-f3/"></a><span class="top_tag">', case when number % 20 = 4 then 'Affitto' else 'In Vendita' end, '</span><div class="place"><span class="fal"></span><span>',
        initcap(town), '</span></div><div class="top_info"><h6><a href="#">Capannone</a></h6></div><p>', number % 900 + 100, ' mq</p><p>Cod. V-', number, '</p><p>€ ', translate(format_number(floor(price), 0), ',', '.'), '</p></div>')""",
    "worldcapital": """concat('<article class="x rh_list_card" data-rh-id="', number, '"><a href="https://www.worldcapital.it/immobile/capannone-', town, '/" aria-label="Capannone&lt;br&gt;&lt;h3&gt;', number % 900 + 100, ' mq rif. W', number, '&lt;/h3&gt;"></a>',
        '<div class="rh_label__status"><span class="rh_label__wrap">', case when number % 20 = 6 then 'Affitto' else 'Vendita' end, '</span></div></article>')""",
    "astalegale": f"""concat('<div class="card"><a href="/Aste/Detail/B', number + 1000000, '-Magazzino-Via-Piave-', town, '"><h5>Lotto</h5></a><p>€ ', {_AMOUNT}, '</p><p>Offerta minima:</p><p>€ ', translate(format_number(price * 0.75, 2), ',.', '.,'), '</p><p>', {_DAY}, ' - 10:00</p>',
        '<p>Tribunale di Padova</p></div><script>window.s=["- magazzino a ', town, ' con consistenza ', number % 900 + 100, ' mq, Valore in perizia ', number, '","x","B', number + 1000000, '"]</script>')""",
    "idealista": f"""concat('<article class="item" data-element-id="', number, '"><a class="item-link" href="/immobile/', number, '/">Capannone in vendita a Zona, ', initcap(town), '</a><span class="item-price">', translate(format_number(floor(price), 0), ',', '.'), '€</span>',
        '<span class="item-detail">', number % 900 + 100, ' m²</span><span class="item-detail">2 locali</span><picture class="logo-branding"><img alt="Agenzia ', number % 7, '" src="l.png"></picture><div class="item-description"><p>Bel capannone</p></div></article>')""",
}


def printed_pages(spark, d):
    """``page_id, source, html``: list pages of the portals, 20 cards each, every listing once (and the first of a page twice)."""
    card = F.lit(None).cast("string")
    for source, text in _PRINTED.items():
        card = F.when(F.col("source") == source, F.expr(text)).otherwise(card)
    rows = listings(spark, d).where(F.col("source").isin(*_PRINTED)).withColumn("card", card).withColumn("page", F.floor(F.col("number") / (10 * _PER_PAGE)).cast("long"))
    body = F.transform(F.array_sort(F.collect_list(F.struct("number", "card"))), lambda x: x["card"])
    g = rows.groupBy("source", "page").agg(body.alias("b"))
    index = F.array_position(F.array(*map(F.lit, _PRINTED)), F.col("source"))
    return g.select((F.col("page") * 10 + index).alias("page_id"), "source", F.concat(F.lit("<html><body>"), F.array_join("b", "\n"), F.col("b")[0], F.lit("</body></html>")).alias("html"))


_EURO = "replace(replace(replace(format('{:,.2f}', cast(price as double)), ',', '#'), '.', ','), '#', '.')"
_WHOLE = "replace(format('{:,.0f}', floor(cast(price as double))), ',', '.')"
_CAP = "upper(town[1]) || lower(town[2:])"


@query(f"""{L}, c as (select *, array_to_string(list_transform(string_split(town, ' '), lambda w: upper(w[1]) || w[2:]), ' ') as cap, date '2026-09-16' + days_left as day, number % 900 + 100 as area from l)
select source, case source when 'astalegale' then 'B' || (number + 1000000) when 'medianord' then 'v' || number || '-f3' else number::varchar end as id,
  case source when 'asteannunci' then 'Capannone industriale' when 'caseasta' then 'Capannone & uffici' when 'fallcoaste' then 'Deposito di ' || area || ' mq' when 'medianord' then 'Capannone' when 'worldcapital' then 'Capannone ' || area || ' mq rif. W' || number
    when 'astalegale' then 'Magazzino Via Piave ' || replace(town, '-', ' ') when 'idealista' then 'Capannone in vendita a Zona, ' || cap end as title,
  case source when 'asteannunci' then 'Via Roma 1, ' || cap || ' (MI)' when 'caseasta' then 'Via Po ' || cap when 'medianord' then cap end as address,
  case when source in ('medianord', 'idealista') then cast(floor(price) as decimal(14,2)) when source <> 'worldcapital' then price end as price,
  case when source in ('fallcoaste', 'medianord', 'worldcapital', 'idealista') then cast(area as decimal(10,2)) end as sqm,
  case source when 'asteannunci' then 'Tribunale di Busto Arsizio' when 'fallcoaste' then 'Tribunale di Monza' when 'astalegale' then 'Tribunale di Padova' end as court,
  case when source in ('asteannunci', 'fallcoaste') then procedure end as procedure, case when source in ('asteannunci', 'fallcoaste', 'astalegale') then day end as deadline,
  case source when 'asteannunci' then (number + 9)::varchar when 'medianord' then 'V-' || number when 'worldcapital' then 'W' || number end as code, case source when 'idealista' then 'Agenzia ' || (number % 7) end as agency,
  case source when 'medianord' then number % 20 <> 4 when 'worldcapital' then number % 20 <> 6 end as in_sale
from c where source in ('asteannunci', 'caseasta', 'fallcoaste', 'medianord', 'worldcapital', 'astalegale', 'idealista')""")
def portal_listings(spark, d):
    """Listings read from the list pages of seven portals."""
    pages = written(printed_pages(spark, d), "pages")
    found = None
    for source in _PRINTED:
        cards = Pages.portal_cards(pages.where(F.col("source") == source), source)
        found = cards if found is None else found.unionByName(cards)
    sqm = F.coalesce(P.italian_number(F.col("sqm")), F.try_element_at(P.surfaces(F.col("sqm")), F.lit(1)))
    day = F.coalesce(P.timestamp(F.col("deadline")), F.try_to_timestamp("deadline", F.lit("dd/MM/yyyy HH:mm"))).cast("date")
    return found.select("source", "id", "title", "address", P.price(F.col("price"), F.col("source")).alias("price"), sqm.cast("decimal(10,2)").alias("sqm"), "court", "procedure", day.alias("deadline"), "code", "agency", "in_sale")


@query(f"{L} select 'B' || (number + 1000000) as id, (number % 900 + 100)::varchar as sqm, number::varchar as appraisal, '- magazzino a ' || town || ' con consistenza ' || (number % 900 + 100) || ' mq, Valore in perizia ' || number as description from l where source = 'astalegale'")
def described_lots(spark, d):
    """Descriptions in a portal's serialised state, each with the id behind it; the first card of a page comes twice."""
    return Pages.described_ids(printed_pages(spark, d).where("source = 'astalegale'")).select("id", "sqm", "appraisal", "description")


@query(f"{L} select number, case when number % 40 < 8 then 'usual' else 'drifted' end as form, price::varchar as price from l where source = 'immobiliare'")
def embedded_listings(spark, d):
    """Listings of a page's embedded state: in its results list, or, after a change of schema, anywhere."""
    rows = listings(spark, d).where("source = 'immobiliare'").withColumn("page_id", F.floor(F.col("number") / 8).cast("long"))
    item = F.format_string('{"seo":1,"realEstate":{"id":%d,"price":"%s"}}', "number", F.col("price").cast("string"))
    g = rows.groupBy("page_id").agg(F.array_join(F.collect_list(item), ",").alias("items"))
    usual = F.concat(F.lit('{"props":{"filters":{"results":[{"id":141,"value":"Agenzia"}]},"queries":[{"state":{"data":{"results":['), "items", F.lit("]}}}]}}"))
    drifted = F.concat(F.lit('{"props":{"list":{"entries":['), "items", F.lit(']}},"results":[]}'))
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), F.when(F.col("page_id") % 5 == 0, usual).otherwise(drifted), F.lit("</script></html>"))
    found = Pages.app_state(g.select("page_id", html.alias("html")))
    number = F.get_json_object("payload", "$.id").cast("long")
    return found.select(number.alias("number"), F.when(F.col("page_id") % 5 == 0, "usual").otherwise("drifted").alias("form"), F.get_json_object("payload", "$.price").alias("price"))


@query(f"{L} select number, case when number % 3 = 0 then 'Capannone ' || town || ' con area esterna e uffici' else 'Capannone' end as description from l where source = 'asteflorio'")
def longer_descriptions(spark, d):
    """Cards whose page's JSON-LD has a longer description."""
    rows = listings(spark, d).where("source = 'asteflorio'").withColumn("page_id", F.floor(F.col("number") / 200).cast("long")).withColumn("url", F.concat(F.lit("/x/"), F.col("number").cast("string")))
    text = F.when(F.expr("number % 3 = 0"), F.concat(F.lit("Capannone "), "town", F.lit(" con area esterna e uffici"))).otherwise(F.lit(" Capan "))
    block = F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct("url", text.alias("description"))), F.lit("</script>"))
    many = F.concat(F.lit('<script type="application/ld+json">[{"url":null,"description":"x"},{"url":"/y","description":" "},3]</script>'), F.array_join(F.collect_list(block), ""))
    pages = rows.groupBy("page_id").agg(many.alias("html"))
    cards = rows.select("number", "url", F.lit("Capannone").alias("description"))
    return J.longer_text(cards, Pages.json_ld_descriptions(pages), "url", "description").select("number", "description")


@query(f"{L} select number, 'Lotto ' || number as name, '/lotto-' || number || '.html' as url from l where source = 'asteflorio'")
def item_lists(spark, d):
    """Rows of JSON-LD item lists."""
    rows = listings(spark, d).where("source = 'asteflorio'").withColumn("page_id", F.floor(F.col("number") / 200).cast("long"))
    item = F.to_json(F.struct(F.lit("ListItem").alias("@type"), F.struct(F.concat(F.lit("/lotto-"), F.col("number").cast("string"), F.lit(".html")).alias("url"), F.concat(F.lit("Lotto "), F.col("number").cast("string")).alias("name")).alias("item")))
    html = F.concat(F.lit('<script type="application/ld+json">{"itemListElement":['), F.array_join(F.collect_list(item), ","), F.lit("]}</script>"))
    found = Pages.json_ld(rows.groupBy("page_id").agg(html.alias("html")))
    return found.select(P.url_parts(F.col("url"), "asteflorio")["id"].cast("long").alias("number"), "name", "url")


@query(f"""{L} select number::varchar as id, price::varchar as price, 'Italia > ' || town as town_path, case when number % 3 = 0 then 'capannone | ' || town when number % 3 = 1 then 'solo testo' end as description,
  case when number % 2 = 0 then procedure end as procedure, case when number % 4 = 0 then 2 else 0 end as sites from l where source = 'vgi'""")
def search_records(spark, d):
    """Search-API documents with nested parts that are missing, lists or single texts."""
    goods = F.when(F.expr("number % 3 = 0"), F.to_json(F.array(F.lit("capannone"), "town"))).when(F.expr("number % 3 = 1"), F.lit('"solo testo"')).otherwise(F.lit("null"))
    case = F.when(F.expr("number % 2 = 0"), F.to_json(F.struct(F.struct(F.split("procedure", "/")[0].alias("numeroProcedura"), F.split("procedure", "/")[1].alias("annoProcedura")).alias("proceduraGiudiziaria")))).otherwise(F.lit('"chiusa"'))
    sites = F.when(F.expr("number % 4 = 0"), F.lit('[{"url":"a"},{"nome":"x"},{"url":"b"},{"url":""}]')).otherwise(F.lit("[]"))
    value = F.concat(F.lit('{"idInserzioneEspVendita":'), F.col("number").cast("string"), F.lit(',"citta":"Italia > '), "town", F.lit('","datiVendita":{"prezzoValoreBase":"'), F.col("price").cast("string"), F.lit('"},"datiProcedura":'), case, F.lit(',"descrizioneBeni":'), goods, F.lit(',"siti":'), sites, F.lit("}"))
    found = Pages.search_documents(listings(spark, d).where("source = 'vgi'").select(value.alias("value")))
    joined = F.when(F.col("procedure_number").isNotNull(), F.concat_ws("/", "procedure_number", "procedure_year"))
    return found.select("id", "price", "town_path", "description", joined.alias("procedure"), F.size("also_on").alias("sites"))


@query(f"{L} select number, price, cast(number % 900 + 100 as decimal(10,2)) as sqm from l where source = 'worldcapital'")
def detail_pages(spark, d):
    """Price and size from listings' own pages."""
    rows = listings(spark, d).where("source = 'worldcapital'")
    html = F.expr(f"""concat('<p class="wcg-detail-item"><strong>Prezzo:</strong> € ', {_AMOUNT}, '</p><p class="wcg-detail-item"><strong>Dimensione:</strong> ', number % 900 + 100, ' mq</p>')""")
    pages = rows.select("number", html.alias("html"))
    return pages.select("number", P.price(Pages.detail(F.col("html"), "Prezzo")).alias("price"), F.try_element_at(P.surfaces(Pages.detail(F.col("html"), "Dimensione")), F.lit(1)).alias("sqm"))


def _payload():
    """Listings as snapshot records, in the fields of their source."""
    return F.to_json(F.struct(
        F.concat(F.lit("https://x/"), F.col("number").cast("string")).alias("url"), F.concat("category", F.lit(" a "), "town").alias("titolo"), F.concat(F.lit("<p>lotto</p> di mq "), F.expr("number % 900 + 100").cast("string")).alias("descrizione_completa"),
        "procedure", F.col("court").alias("tribunale"), F.concat(F.lit("Proc. "), "procedure").alias("procedura"), F.expr(_AMOUNT).alias("prezzo"), F.expr(_AMOUNT).alias("prezzo_base"), F.expr("case when number % 6 = 0 then 'ieri' else '2026-09-15T08:00:00' end").alias("scraped_at"),
        F.concat("town", F.lit(" (MI)")).alias("indirizzo"), F.col("town").alias("comune"), F.col("town").alias("citta"), F.col("town").alias("zona"), F.concat(F.lit("Italia > Lombardia > "), "town").alias("citta_completa"),
    ))


def printed_snapshots(spark, d, per_file=50):
    """``value, file``: snapshot envelopes of at most 50 listings, beside one broken file and one empty one a source."""
    rows = listings(spark, d).withColumn("part", F.floor(F.col("number") / (10 * per_file)).cast("long")).withColumn("payload", _payload())
    g = rows.groupBy("source", "channel", "part").agg(F.map_from_entries(F.collect_list(F.struct("listing_id", F.parse_json("payload").alias("v")))).alias("listings"), F.count("*").alias("total"))
    whole = g.select(F.to_json(F.struct(F.lit("2026-09-16T06:00:00").alias("generated_at"), "total", "listings")).alias("value"), F.concat(F.lit("/INPUT/"), "channel", F.lit("/part"), F.col("part").cast("string"), F.when(F.col("channel") == "IMM_ID", "/current_week").otherwise(""), F.lit("/dataset_"), "source", F.lit(".json")).alias("file"))
    kinds = rows.select("source", "channel").distinct()
    name = lambda n: F.concat(F.lit("/INPUT/"), "channel", F.lit(f"/{n}"), F.when(F.col("channel") == "IMM_ID", "/current_week").otherwise(""), F.lit("/dataset_"), "source", F.lit(".json")).alias("file")
    old = g.where("channel = 'IMM_ID'").select(F.lit('{"listings":{"old_1":{}}}').alias("value"), F.concat(F.lit("/INPUT/IMM_ID/part"), F.col("part").cast("string"), F.lit("/past_week/dataset_"), "source", F.lit(".json")).alias("file"))
    return whole.unionByName(kinds.select(F.lit('{"listings": {"x": ').alias("value"), name("broken"))).unionByName(kinds.select(F.lit("").alias("value"), name("empty"))).unionByName(old)


@query(f"{L} select listing_id as listing_key, source, channel, price, procedure, case when number % 6 <> 0 then timestamp '2026-09-15 08:00:00' end as scraped_at from l")
def snapshot_listings(spark, d):
    """Listings of snapshot envelopes: broken and empty files, and last week's of the sale portals, give none."""
    rows = Snap.of_files(Snap.exploded(Snap.current_files(printed_snapshots(spark, d)))).where("listing_key is not null")
    base = Snap.baseline(rows)
    p = lambda path: F.get_json_object("payload", path)
    read = rows.select("listing_key", "source", "channel", P.price(p("$.prezzo_base")).alias("price"), P.procedure(p("$.procedura")).alias("procedure"))
    return read.join(base, "listing_key", "left")


@query(f"""{L}, g as (select source, channel, count(*) as listings, count(distinct floor(number / 500)) as files from l group by all) select source, channel, files + 2 as files, listings, cast(2 as bigint) as unreadable from g""")
def input_manifest(spark, d):
    """Files, listings and unreadable files of each source."""
    m = Snap.of_files(Snap.manifest(Snap.exploded(Snap.current_files(printed_snapshots(spark, d)))))
    return m.groupBy("source", "channel").agg(F.count("*").alias("files"), F.sum("listings").alias("listings"), F.count_if(F.col("listings") == 0).alias("unreadable"))


@query(f"{L} select 'procedure' as field, count(*) as n from l")
def unknown_fields(spark, d):
    """Fields of snapshot records that no adapter reads."""
    rows = Snap.exploded(Snap.current_files(printed_snapshots(spark, d))).where("listing_key is not null")
    return Snap.unknown_fields(rows, Snap.FIELDS).select("field", F.col("count").alias("n"))


@query(f"""{L}, c as (select source, cast(count(*) as double) as n, count(*) filter (where number % 6 <> 0) as open, count(*) filter (where number % 4 <> 0) as was, count(*) filter (where number % 4 <> 0 and number % 6 <> 0) as mq from l group by source),
u as (select source, 'luogo.citta' as path, 'gone' as change, 'STRING' as kinds_before, null as kinds_now, 1.0 as share_before, null as share_now, null as renamed_from from c
  union all select source, 'luogo.comune', 'new', null, 'STRING', null, 1.0, 'luogo.citta' from c
  union all select source, 'lotti[]', 'share', 'OBJECT', 'OBJECT', 1.0, open / n, null from c where 1 - open / n > 0.02
  union all select source, 'lotti[].n', case source when 'vgi' then 'kind' else 'share' end, 'BIGINT', case source when 'vgi' then 'STRING' else 'BIGINT' end, 1.0, open / n, null from c where source = 'vgi' or 1 - open / n > 0.02
  union all select source, 'lotti[].mq', 'share', 'BIGINT', 'BIGINT', was / n, mq / n, null from c where (was - mq) / n > 0.02)
select source, path, change, kinds_before, kinds_now, round(share_before, 6) as share_before, round(share_now, 6) as share_now, renamed_from from u""")
def schema_drift(spark, d):
    """Nested records of two weeks: a field renamed, one of another kind at one source, and lists that are empty more often."""
    lot = lambda n: f"named_struct('n', {n}, 'mq', case when number % 4 <> 0 then number % 900 end)"
    record = lambda place, lots: f"to_json(named_struct('id', listing_id, 'luogo', named_struct('{place}', town, 'lotto', lot), 'lotti', {lots}))"
    few = lambda n: f"filter(array({lot(n)}), x -> number % 6 <> 0)"
    before = record("citta", f"array({lot('number')})")
    now = f"case when source = 'vgi' then {record('comune', few('cast(number as string)'))} else {record('comune', few('number'))} end"
    paths = lambda text: A.json_paths(listings(spark, d).select("source", F.expr(text).alias("payload")), "source", "payload")
    found = A.schema_drift(paths(now), paths(before), "source")
    return found.withColumns({c: F.round(c, 6) for c in ("share_before", "share_now")})


@query(f"""{L} select listing_id as listing_key, source, price, cast(number % 900 + 100 as decimal(10,2)) as sqm, case source when 'asteflorio' then null when 'fallcoaste' then null else town end as town, case category when 'residenziale' then 'residenziale' else category end as category,
  procedure, court from l""")
def canonical_listings(spark, d):
    """Snapshot records of all ten sources in one table."""
    rows = Snap.exploded(Snap.current_files(printed_snapshots(spark, d))).where("listing_key is not null")
    town = F.when(~F.col("source").isin("asteflorio", "fallcoaste"), F.col("town"))
    return Snap.canonical(rows).select("listing_key", "source", "price", F.col("sqm").cast("decimal(10,2)").alias("sqm"), town.alias("town"), "category", "procedure", "court")


@query("select event_id, date_trunc('second', ts) as ts, case when value > 90 then 'ERROR' when value > 70 then 'WARNING' else 'INFO' end as level, 'utente ' || user_id as message from events where event_id % 9 > 0 union all select event_id, null, null, 'Traceback ' || event_id from events where event_id % 9 = 0")
def log_lines(spark, d):
    """Lines of a log: time, level and message, and lines of another form."""
    e = table(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts"))
    level = F.when(F.col("value") > 90, "ERROR").when(F.col("value") > 70, "WARNING").otherwise("INFO")
    line = F.when(F.expr("event_id % 9 > 0"), F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), level, F.lit("] utente "), F.col("user_id").cast("string"))).otherwise(F.concat(F.lit("Traceback "), F.col("event_id").cast("string")))
    return Snap.log_rows(e.select("event_id", line.alias("value")), keep=["event_id"]).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "level", "message")


_RELATIVE = [
    ("oggi", 0), ("Aggiornato ieri", 1), ("un'ora fa", 0), ("poco fa", 0), ("un giorno fa", 1), ("alloggio aggiornato 3 giorni fa", 3), ("una settimana fa", 7), ("2 settimane fa", 14), ("un mese fa", 30),
    ("più di 3 mesi fa", 90), ("un anno fa", 365), ("2 anni fa", 730), ("3 ore fa", None), ("", None), ("uno di 5 mesi, oggi", 0),
]


@query(f"""{L}, p(i, days) as (values {", ".join(f"({i}, {n if n is not None else 'null'})" for i, (_, n) in enumerate(_RELATIVE))}) select listing_id, cast(days as int) as days, timestamp '2026-09-16 12:00:00' - to_days(cast(days as int)) as seen from l join p on i = number % {len(_RELATIVE)}""")
def relative_days(spark, d):
    """Days of relative phrases, and the time that they mean."""
    texts = F.array(*(F.lit(t) for t, _ in _RELATIVE))
    days = P.relative_days(texts[F.expr(f"cast(number % {len(_RELATIVE)} as int)")])
    return listings(spark, d).select("listing_id", days.alias("days"), P.days_ago(days, F.lit("2026-09-16 12:00:00").cast("timestamp")).cast("timestamp_ntz").alias("seen"))


_SCREENS = ["<html>Please enable JS and disable any ad blocker</html>", "<p>captcha</p>", "geo.CAPTCHA-delivery.com", "Unusual traffic", "traffico insolito", "DataDome", "Accesso negato", "are you a robot", None, "normale"]


@query("select page_id, regexp_matches(lower(html), 'captcha-delivery[.]com|please enable js|unusual traffic|traffico insolito|datadome|accesso negato') as blocked, page_id % 9 in (0, 2, 3, 4, 5, 6) as screen_blocked from pages")
def blocked_pages(spark, d):
    """Challenge pages among the given pages, and the portals' own forms of them."""
    texts = F.array(*(F.lit(t) for t in _SCREENS[:9]))
    return table(spark, d, "pages").select("page_id", P.is_blocked(F.col("html")).alias("blocked"), P.is_blocked(texts[F.expr("cast(page_id % 9 as int)")]).alias("screen_blocked"))


_TOWNS = ["milano", "roma", "pavia"]


@query("""with s as (select p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') as slug from part)
select p_partkey, case when ('-' || slug || '-') like '%-economy-%' or slug like '%economy' then 'economy' when ('-' || slug || '-') like '%-small-%' or slug like '%small' then 'small' end as city,
  case when contains(slug, 'ass') then 'ass' when contains(slug, 'st') then 'st' end as loose from (select p_partkey, case when p_partkey % 5 = 0 then 'via-economy' else slug end as slug from s) x""")
def slug_cities(spark, d):
    """The first searched city in a slug, bounded by hyphens or anywhere; a row for each part, whatever repeats."""
    slug = F.when(F.expr("p_partkey % 5 = 0"), F.lit("via-economy")).otherwise(P.slug(F.concat_ws(" ", "p_name", "p_type")))
    rows = table(spark, d, "part").select("p_partkey", slug.alias("slug"))
    return rows.select("p_partkey", X.first_city(F.col("slug"), ["economy", "small"]).alias("city"), X.first_city(F.col("slug"), ["ass", "st"], whole=False).alias("loose"))


@query(f"""{L} select listing_id, case when number % 5 = 0 then town end as path_city, number % 3 = 0 as exact, number % 4 = 0 as in_province, case number % 4 when 0 then 'MI' when 1 then 'PV' when 2 then 'MB' end as province from l""")
def place_predicates(spark, d):
    """Places: a searched town in a path, a town that is one exactly, a target province, and the province of a text."""
    rows = listings(spark, d)
    path = F.expr("case when number % 5 = 0 then concat('Lombardia >  ', upper(town), ' > Zona') else 'Lazio > Ostia' end")
    name = F.expr("case when number % 3 = 0 then '  MILANO ' when number % 3 = 1 then 'milano nord' end")
    text = F.expr("case number % 4 when 0 then 'Via Po, Rho (MI)' when 1 then 'in provincia di Pavia, zona nord' when 2 then 'Monza e Brianza' else 'ignota' end")
    names = sorted(r.town for r in rows.select("town").distinct().collect())  # 25 nations at most
    return rows.select("listing_id", X.path_city(path, names).alias("path_city"), P.is_target_town(name, _TOWNS).alias("exact"), P.in_target_province(text, ["MI", "LO"]).alias("in_province"), P.province(text).alias("province"))


@query(f"""{L} select listing_id, case number % 6 when 0 then 'Rho' when 1 then 'Lodi' when 2 then 'Crema' when 3 then town when 4 then 'Segrate' when 5 then 'Bergamo' end as value,
  case number % 6 when 4 then 'media' when 5 then 'bassa' else 'alta' end as confidence from l""")
def resolved_towns(spark, d):
    """Towns by the five ways, in order."""
    case = lambda *xs: F.expr("case number % 6 " + " ".join(f"when {i} then {x}" for i, x in xs) + " end")
    got = P.resolved_town(
        case((0, "' Rho '"), (1, "''")), case((0, "'x (PV)'"), (1, "'Via Po 3, Lodi (LO)'")), case((2, "'Capannone - Crema (CR)'"), (4, "'Capannone a Zona Ovest, Segrate'"), (5, "'Box'")), case((3, "concat('Italia > Nord > ', town)")),
        F.lit("Bergamo"),
    )
    return listings(spark, d).select("listing_id", got["value"].alias("value"), got["confidence"].alias("confidence"))


@query(f"""{L} select listing_id, case number % 3 when 0 then 1 when 1 then 2 else 0 end as n, case number % 3 when 0 then cast(number % 900 + 100 as decimal(10,2)) when 1 then cast(1250 as decimal(10,2)) end as value,
  case number % 3 when 0 then 'commerciale' when 1 then 'scoperta,coperta' else '' end as labels, case number % 3 when 0 then 'alta' when 1 then 'alta' end as confidence from l""")
def labelled_areas(spark, d):
    """All areas of a text with their labels; the built-up one counts."""
    text = F.expr("case number % 3 when 0 then concat('sup. commerciale di ', number % 900 + 100, ' mq in zona 3') when 1 then 'area scoperta di m² 3.000, e superficie coperta mq 1.250' else 'lotto 7' end")
    rows = listings(spark, d).select("listing_id", text.alias("t"))
    found, best = P.labelled_surfaces(F.col("t")), P.surface(F.col("t"))
    return rows.select("listing_id", F.size(found).alias("n"), best["value"].alias("value"), F.array_join(F.transform(found, lambda m: m["label"]), ",").alias("labels"), best["confidence"].alias("confidence"))


@query(f"""{L} select listing_id, case when number % 2 = 0 then (number % 5 + 1)::varchar end as floors, case when number % 3 = 0 then (number % 30 + 1)::varchar end as office_share, case when number % 4 = 0 then 'eternit' end as asbestos, case when number % 5 = 0 then 'quota di 2/6' end as tenure,
  case when number % 7 = 0 then 'occupato' end as occupied, case when number % 6 = 0 then 'd1' end as zoning, case when number % 9 = 0 then 'banchine' end as dock, case when number % 10 = 0 then cast(4 + number % 9 as decimal(6,2)) end as height from l""")
def text_attributes(spark, d):
    """Attributes that a free text states explicitly."""
    part = lambda n, text: f"case when number % {n} = 0 then {text} else '' end"
    text = F.expr("concat('Capannone. ', " + ", ".join([
        part(2, "concat('Disposto su ', number % 5 + 1, ' piani. ')"), part(3, "concat('Uffici per il ', number % 30 + 1, ' %. ')"), part(4, "'Tetto in Eternit. '"), part(5, "'Quota di 2/6 della proprietà. '"), part(7, "'Immobile risulta occupato. '"),
        part(6, "'Zona D1. '"), part(9, "'Dotato di Banchine di carico. '"), part(10, "concat('Altezza sotto trave m ', 4 + number % 9, ',00 m. ')"),
    ]) + ")")
    rows = listings(spark, d).select("listing_id", text.alias("t"))
    none = F.lit(None).cast("string")
    height = P.best_height(F.lit("650 m"), none, F.col("t"))["value"]
    m = P.attributes(F.col("t"))
    return rows.select("listing_id", *[m[n].alias(n) for n in ("floors", "office_share", "asbestos", "tenure", "occupied", "zoning", "dock")], height.alias("height"))


@query(f"""{L} select listing_id, case number % 6 when 0 then 'testo' when 1 then 'a b' when 2 then 'uno' when 3 then null when 4 then '{{"other":1}}' when 5 then 'semplice' end as description,
  case number % 3 when 0 then '120 m²' end as area, case number % 3 when 2 then null else '900 €/m²' end as area_price, 'b c' as second, case when number % 2 = 0 then 'asta' else 'vendita' end as sale_type from l""")
def small_parsers(spark, d):
    """Descriptions of several shapes, details of cards, parts of texts and the kind of sale."""
    raw = F.expr("""case number % 6 when 0 then '"testo"' when 1 then '{"html":"<b>a</b> b"}' when 2 then '{"x":1,"text":"uno"}' when 3 then 'null' when 4 then '{"other":1}' else 'semplice' end""")
    details = F.expr("case number % 3 when 0 then array('2 locali', '120 m²', '900 €/m²', '80 m2') when 1 then array('900 €/m²') else array('3° piano') end")
    text = F.regexp_replace(P.description(raw), r"\s+", " ")
    item = P.item_details(details)
    kind = P.sale_type(F.expr("case when number % 4 = 0 then 'ASTE' else 'IMM_ID' end"), F.expr("case when number % 4 = 2 then '{\"custode\":1}' when number % 4 = 1 then 'null' end"), F.lit("Capannone in vendita"))
    return listings(spark, d).select("listing_id", text.alias("description"), item["area"].alias("area"), item["area_price"].alias("area_price"), P.nth_part(F.lit("a | | b c |"), 2).alias("second"), kind.alias("sale_type"))


@query(f"""{L} select listing_id, number as id, number % 900 as second, cast(7.1 as decimal(6,2)) as height, cast(number % 5 as int) as bays, 'libero' as availability, case when number % 2 = 0 then timestamp '1970-01-01' + to_seconds(cast(1700000000 + number as bigint)) end as updated from l where source = 'immobiliare'""")
def pruned_details(spark, d):
    """A few paths of a heavy detail, and fields found at any depth."""
    rows = listings(spark, d).where("source = 'immobiliare'")
    p = F.format_string('{"industrial":{"underBeamHeight":"7,1 m","barnHeight":"650 m","bayes":%d},"availability":"libero","photos":[%s]}', F.expr("number % 5"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.lit('{"u":"x"}')), ","))
    raw = F.concat(F.lit('{"pageProps":{"detailData":{"realEstate":{"updatedAt":'), F.expr("case when number % 2 = 0 then cast(1700000000 + number as string) else '\"ieri\"' end"), F.lit(',"properties":['), p, F.lit(']}},"meta":{"ids":[{"id":'), F.col("number").cast("string"), F.lit('},{"id":'), F.expr("number % 900").cast("string"), F.lit("}]}}}"))
    rows = rows.select("listing_id", raw.alias("raw"))
    ids = Pages.found_keys(rows, "listing_id", "raw", "id").groupBy("listing_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "value"))), lambda x: x["value"].cast("long")).alias("ids"))
    v = X.pruned(F.col("raw"), X.DETAIL_PATHS)
    updated = P.epoch(F.get_json_object("raw", "$.pageProps.detailData.realEstate.updatedAt"))
    none = F.lit(None).cast("string")
    out = rows.join(ids, "listing_id").withColumn("v", v)
    return out.select("listing_id", F.col("ids")[0].alias("id"), F.col("ids")[1].alias("second"), P.best_height(F.col("v.beam_height"), F.col("v.barn_height"), none)["value"].alias("height"), F.col("v.bays").alias("bays"), F.col("v.availability").alias("availability"), updated.cast("timestamp_ntz").alias("updated"))


@query(f"""{FACTS_SQL} select listing_id, round(competitor_sqm, 2) as competitor_sqm, round(junction_km, 6) as junction_km, retail_poles, inhabitants from f""")
def surroundings(spark, d):
    """Competitors within 5 km, the nearest junction and retail poles within 2 km of each listing."""
    return facts(spark, d).select("listing_id", F.round("competitor_sqm", 2).alias("competitor_sqm"), F.round("junction_km", 6).alias("junction_km"), "retail_poles", "inhabitants")
