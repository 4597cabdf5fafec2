"""Listing-like tables derived from the driver's tables by arithmetic that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propscan.operators.joins import surrounded, with_town

#: The ten sources, and the run date of the examples.
SOURCES = ["asteannunci", "asteflorio", "caseasta", "fallcoaste", "medianord", "vgi", "worldcapital", "astalegale", "idealista", "immobiliare"]
KINDS = ["capannone", "magazzino", "laboratorio", "garage", "residenziale"]
RUN_DATE = "2026-09-16"

_SOURCE = "case o_orderkey % 10 " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(SOURCES)) + " end"
_KIND = "case o_orderkey % 5 " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(KINDS)) + " end"
#: Both engines run this text; {orders} and so on name the tables.
LISTING_SQL = f"""
select {_SOURCE} || '_' || o_orderkey as listing_id, {_SOURCE} as source, {_KIND} as category,
  case when o_orderkey % 10 < 8 then 'ASTE' else 'IMM_ID' end as channel, o_orderkey as number, o_custkey as custkey,
  cast(o_totalprice as decimal(14,2)) as price, cast((o_orderkey * 37) % 90 - 10 as int) as days_left, lower(n_name) as town,
  case when o_orderkey % 7 = 0 then null else cast(q * 10 as decimal(12,2)) end as sqm, cast(year(o_orderdate) as int) as year,
  'tribunale ' || (o_custkey % 5) as court, cast(o_custkey as varchar(20)) || '/' || cast(year(o_orderdate) as varchar(4)) as procedure,
  case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 4 as varchar(9)) end as lot, o_orderdate as seen_at,
  36.0 + (o_custkey * 13 % 1000) / 100.0 as lat, 7.0 + (o_custkey * 29 % 1000) / 100.0 as lon
from {{orders}} o join {{customer}} c on o_custkey = c_custkey join {{nation}} n on c_nationkey = n_nationkey
left join (select l_orderkey, sum(l_quantity) as q from {{lineitem}} group by l_orderkey) s on l_orderkey = o_orderkey
"""
#: More columns of a listing, by arithmetic on its number; both engines run these texts.
FACTS = {
    "title": "case number % 11 when 3 then 'capannone con quota di 2/6' when 5 then 'magazzino, abuso insanabile' when 7 then 'deposito con tetto in eternit' when 9 then 'locale' else 'capannone industriale' end",
    "height": "case when number % 4 > 0 then cast(2.5 + (number % 9) * 0.5 as double) end", "permit": "case number % 6 when 0 then 'libero' when 1 then 'scia' when 2 then 'pdc' when 3 then 'variante' when 4 then 'incerto' end",
    "floor": "case when number % 8 > 0 then cast(number % 3 - 1 as int) end", "office_share": "case when number % 10 > 0 then cast((number % 5) * 0.07 as double) end",
    "bays": "case when number % 9 > 0 then cast(number % 4 as int) end", "yard": "case number % 3 when 0 then true when 1 then false end", "entrance": "case number % 4 when 1 then false when 2 then null else true end",
    "docks": "case when number % 6 > 0 then cast(number % 3 as int) end", "gates": "number % 2 = 0", "year_built": "case when number % 7 <> 3 then cast(1980 + number % 40 as int) end",
    "certified": "case number % 5 when 0 then true when 1 then false end", "adjacent": "number % 3 = 1", "second_bay": "number % 4 = 1", "phased": "case when number % 5 <> 2 then number % 5 = 1 end",
    "auction": "channel = 'ASTE'", "free": "case number % 3 when 0 then true when 1 then false end", "failed": "cast(number % 4 - 1 as int)", "custodian": "number % 2 = 1",
    "min_offer": "case when channel = 'ASTE' then cast(price as double) * 0.75 end", "address": "case number % 4 when 0 then 'Via Statale 12' when 1 then 'viale Europa 3' when 2 then 'via Roma' end",
    "barrier": "case number % 3 when 0 then true when 1 then false end", "strip_out": "number % 13 = 0", "asbestos": "number % 11 = 7", "regularising": "case when number % 6 = 3 then 10000.0 end",
}
#: Points around listings: competitors, junctions (even numbers) and retail poles (multiples of three).
POINTS = "select s_suppkey as k, 36.0 + (s_suppkey * 17 % 1000) / 100.0 as lat, 7.0 + (s_suppkey * 23 % 1000) / 100.0 as lon, cast(500 + s_suppkey % 7 * 900 as double) as sqm from {supplier}"
#: Towns with their province, an index that some lack, and inhabitants.
TOWNS = "select lower(n_name) as town, lower(r_name) as province, case when n_nationkey % 4 > 0 then cast(n_nationkey * 37 % 100 as double) end as town_index, cast(50000 + n_nationkey * 7000 as double) as inhabitants from {nation} join {region} on n_regionkey = r_regionkey"
LISTING_DUCK = LISTING_SQL.format(orders="orders", customer="customer", nation="nation", lineitem="lineitem")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    names = ("orders", "customer", "nation", "lineitem")
    return spark.sql(LISTING_SQL, **{n: table(spark, folder, n) for n in names}).withColumn("deadline", F.date_add(F.lit(RUN_DATE).cast("date"), F.col("days_left")))


def towns(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TOWNS, nation=table(spark, folder, "nation"), region=table(spark, folder, "region"))


def points(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(POINTS, supplier=table(spark, folder, "supplier"))


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """Listings with all that the scorecard reads: facts of their own, their town's index and what lies around them."""
    rows = listings(spark, folder).withColumns({n: F.expr(e) for n, e in FACTS.items()})
    return surrounded(with_town(rows, towns(spark, folder)), points(spark, folder))


def raw_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listings as portals print them: Italian amounts, four date formats, areas with a unit."""
    rows = listings(spark, folder)
    at = F.to_timestamp(F.col("deadline")) + F.expr("make_dt_interval(0, 12, 30)")
    form = F.col("number") % 4
    when = F.when(form == 0, F.date_format(at, "dd/MM/yyyy - HH:mm")).when(form == 1, F.date_format(at, "dd/MM/yyyy 'h' HH:mm")).when(form == 2, F.date_format(at, "dd/MM/yyyy, HH:mm")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
    amount = F.when(F.col("source") == "asteflorio", F.col("price").cast("string")).otherwise(F.concat(F.lit("€ "), F.translate(F.format_number("price", 2), ",.", ".,")))
    whole = F.translate(F.format_number(F.floor("sqm"), 0), ",", ".")
    area = F.when(form < 2, F.concat(F.lit("area di mq "), whole)).otherwise(F.concat(whole, F.lit("MQ coperti")))
    return rows.select("listing_id", "source", "number", "channel", "category", "town", amount.alias("price_text"), when.alias("deadline_text"), area.alias("area_text"), F.concat(F.lit("Proc. "), "procedure").alias("procedure_text"))
