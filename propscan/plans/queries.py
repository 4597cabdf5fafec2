"""Queries over listing tables derived from the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from propscan.config import Config
from propscan.functions import parse as P
from propscan.functions import score as S
from propscan.operators import filters as X
from propscan.operators import joins as J
from propscan.operators import resolve as R
from propscan.operators import windows as W
from propscan.plans import freshness as Fresh
from propscan.plans import publish as Pub
from propscan.plans.demo import RUN_DATE, facts, listings, raw_listings, table
from propscan.plans.evaluate import announced, evaluated
from propscan.plans.expected import EVAL_SQL, L
from propscan.plans.registry import ORACLE_SQL, QUERIES, query
from propscan.sources.pages import cards
from propscan.storage import written

def _evaluated(spark, d):
    """The evaluation, written once, so that later filters don't repeat the scorecard's expressions."""
    few = ["listing_id", "channel", "reason", "outcome", "vote", "yoc_base", "deadline"]
    return written(evaluated(facts(spark, d), RUN_DATE).select(*few), "evaluated")


def _today():
    return F.lit(RUN_DATE).cast("date")


@query(f"""{EVAL_SQL} select listing_id, vote, outcome, rank from (select *, row_number() over (order by vote desc, yoc desc nulls last, days_left, listing_id) as rank from o
  where outcome in ('PROMUOVI', 'DA APPROFONDIRE')) where rank <= 10""")
def top_listings(spark, d):
    return announced(_evaluated(spark, d)).select("listing_id", "vote", "outcome", F.col("rank").cast("long").alias("rank"))


@query(f"""{EVAL_SQL} select channel, outcome, reason, count(*) as n, cast(sum(vote) as bigint) as votes, cast(grouping(channel) as int) as g from (select channel, outcome, vote, coalesce(reason, '-') as reason from o)
  group by grouping sets ((channel, outcome, reason), (outcome), ())""")
def run_statistics(spark, d):
    e = _evaluated(spark, d).select("channel", "outcome", F.coalesce("reason", F.lit("-")).alias("reason"), "vote")
    return spark.sql("select channel, outcome, reason, count(*) n, sum(vote) votes, cast(grouping(channel) as int) g from {e} group by grouping sets ((channel, outcome, reason), (outcome), ())", e=e)


@query(f"{EVAL_SQL} select reason, array_to_string(list_sort(list(listing_id)), ',') as ids from o where reason is not null and outcome = 'SCARTA' group by reason")
def discarded_ids(spark, d):
    e = _evaluated(spark, d).where("reason is not null and outcome = 'SCARTA'")
    return e.groupBy("reason").agg(F.array_join(F.sort_array(F.collect_list("listing_id")), ",").alias("ids"))


@query(f"{L} select listing_id, price, cast('{RUN_DATE}' as date) + days_left as deadline, cast(floor(sqm) as decimal(10,2)) as sqm, procedure from l")
def parsed_listings(spark, d):
    r = raw_listings(spark, d)
    return r.select("listing_id", P.price(F.col("price_text"), F.col("source")).alias("price"), P.timestamp(F.col("deadline_text")).cast("date").alias("deadline"), P.surface(F.col("area_text"))["value"].alias("sqm"), P.procedure(F.col("procedure_text")).alias("procedure"))


@query(f"""{L} select source, count(*) as n, count(sqm) as with_sqm, count(lot) as with_lot, cast(count(sqm) as double) / count(*) as fill from l group by rollup(source)""")
def fill_rates(spark, d):
    r = listings(spark, d).rollup("source").agg(F.count("*").alias("n"), F.count("sqm").alias("with_sqm"), F.count("lot").alias("with_lot"))
    return r.withColumn("fill", F.col("with_sqm") / F.col("n"))


@query(f"""{L}, t as (select * from l where source in ('caseasta','idealista') and sqm > 0) select a.listing_id as a, b.listing_id as b from t a join t b on a.town = b.town and a.listing_id < b.listing_id
  and abs(a.sqm - b.sqm) <= 0.03 * greatest(a.sqm, b.sqm) and abs(a.price - b.price) <= 0.02 * greatest(a.price, b.price)""")
def tolerance_pairs(spark, d):
    return J.tolerance_pairs(listings(spark, d).where("source in ('caseasta','idealista')"), "listing_id", ["town"], {"sqm": 0.03, "price": 0.02})


@query(f"""{L}, t as (select * from l where sqm > 0) select a.listing_id as a, b.listing_id as b from t a join t b on a.town = b.town and a.listing_id < b.listing_id and a.source <> b.source
  and abs(a.sqm - b.sqm) <= 0.03 * greatest(a.sqm, b.sqm) and abs(a.price - b.price) <= 0.02 * greatest(a.price, b.price)""")
def portal_pairs(spark, d):
    """The two-portal rule over all sources."""
    rows = written(listings(spark, d).select("listing_id", "source", "town", "sqm", "price"), "listings")
    return J.tolerance_pairs(rows, "listing_id", ["town"], {"sqm": 0.03, "price": 0.02}, "source")


@query(f"""{L}, e as (select a.listing_id as x, b.listing_id as y from l a join l b on lower(trim(a.court)) = lower(trim(b.court)) and a.procedure = b.procedure and a.lot = b.lot)
select x as listing_id, min(y) as property_id from e group by x union all select listing_id, listing_id from l where lot is null""")
def same_lot_properties(spark, d):
    rows = listings(spark, d)
    keyed = rows.where("lot is not null").withColumn("_k", P.identity_key(F.col("court"), F.col("procedure"), F.col("lot")))
    heads = keyed.groupBy("_k").agg(F.min("listing_id").alias("head"))
    return R.properties(rows, keyed.join(heads, "_k").select(F.col("head").alias("a"), F.col("listing_id").alias("b")))


@query("""with s as (select s_suppkey, 36.0 + (s_suppkey * 17 % 1000) / 100.0 as lat, 7.0 + (s_suppkey * 31 % 1000) / 100.0 as lon, s_acctbal from supplier),
c as (select c_custkey, 36.0 + (c_custkey * 13 % 1000) / 100.0 as lat, 7.0 + (c_custkey * 29 % 1000) / 100.0 as lon from customer)
select c_custkey, count(*) as n from c join s on 2 * 6371.0 * asin(sqrt(least(pow(sin(radians(s.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - c.lon) / 2), 2), 1.0))) <= 25 group by c_custkey""")
def competitors_in_radius(spark, d):
    point = lambda t, k, a, b: table(spark, d, t).withColumns({"lat": F.expr(f"36.0D + ({k} * {a} % 1000) / 100.0D"), "lon": F.expr(f"7.0D + ({k} * {b} % 1000) / 100.0D")})
    near = J.radius_join(point("customer", "c_custkey", 13, 29).select("c_custkey", "lat", "lon"), point("supplier", "s_suppkey", 17, 31).select("s_suppkey", "lat", "lon"), 25.0)
    return near.groupBy("c_custkey").agg(F.count("*").alias("n"))


_WEEKS = "select l_partkey as part, cast(date_trunc('week', l_shipdate) as date) as week, cast(min(l_extendedprice) as decimal(14,2)) as price from {lineitem} group by 1, 2"


def _weeks(spark, d):
    return spark.sql(_WEEKS, lineitem=table(spark, d, "lineitem"))


@query(f"""with w as ({_WEEKS.format(lineitem='lineitem')}), a as (select * from w where week = (select max(week) - 350 from w)), b as (select * from w where week = (select max(week) - 357 from w))
select coalesce(a.part, b.part) as part, case when b.part is null then 'new' when a.part is null then 'gone' when a.price = b.price then 'same' else 'changed' end as change from a full join b on a.part = b.part""")
def snapshot_diff(spark, d):
    w = _weeks(spark, d)
    last = w.agg(F.max("week").alias("last"))
    at = lambda n: w.join(F.broadcast(last), F.col("week") == F.date_sub("last", n)).select("part", "price")
    return J.diff(at(350), at(357), "part", ["price"])


@query(f"""with w as ({_WEEKS.format(lineitem='lineitem')}), k as (select week, row_number() over (order by week) as n from (select distinct week from w)), x as (select part, price, n from w join k using (week)),
c as (select coalesce(a.part, b.part) as part, coalesce(a.n, b.n + 1) as n, case when b.part is null then 'new' when a.part is null then 'gone' when a.price is not distinct from b.price then 'same' else 'changed' end as change
  from x a full join x b on a.part = b.part and a.n = b.n + 1)
select part, week, change from c join k using (n)""")
def weekly_changes(spark, d):
    """Every week against the week before, the first against none."""
    w = _weeks(spark, d)
    weeks = w.select("week").distinct().withColumn("n", F.row_number().over(Window.orderBy("week")))
    x = w.join(F.broadcast(weeks), "week")
    key = F.struct("part", "n")
    changes = J.diff(x.select(key.alias("key"), "price"), x.select(F.struct("part", (F.col("n") + 1).alias("n")).alias("key"), "price"), "key", ["price"])
    return changes.select("key.*", "change").join(F.broadcast(weeks), "n").select("part", "week", "change")


@query(f"""with w as ({_WEEKS.format(lineitem='lineitem')}), p as (select *, lag(price) over (partition by part order by week) as prev_price from w)
select part, week, price, prev_price, cast(sum(case when price < prev_price then 1 else 0 end) over (partition by part order by week rows unbounded preceding) as bigint) as failed from p""")
def price_history(spark, d):
    rows = W.history(W.failed_auctions(_weeks(spark, d).withColumn("deadline", F.col("week")), "part", "week", "price", "deadline"), "part", "week", ["price"])
    return rows.select("part", "week", "price", "prev_price", "failed")


@query("""select o_custkey as custkey, o_orderkey as listing, o_totalprice as price from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n from orders) where n = 1""")
def latest_per_key(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("listing"), F.col("o_totalprice").alias("price"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return J.upsert(o.where("listing % 2 = 0"), o.where("listing % 2 = 1"), "custkey", "at").drop("at")


@query("""select o.o_orderkey as listing, max_by(p.o_totalprice, strftime(p.o_orderdate, '%Y%m%d%H%M%S') || lpad(cast(p.o_orderkey as varchar), 12, '0')) as last_price from orders o left join orders p on p.o_custkey = o.o_custkey and p.o_orderdate < o.o_orderdate and p.o_orderkey % 3 = 0
  where o.o_orderkey % 3 = 1 group by o.o_orderkey""")
def as_of_announcement(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("listing"), F.col("o_custkey").alias("custkey"), "o_orderdate", F.col("o_totalprice").alias("price"))
    log = o.where("listing % 3 = 0").groupBy("custkey", "o_orderdate").agg(F.max_by("price", "listing").alias("price"))
    return J.as_of(o.where("listing % 3 = 1").drop("price"), log, "custkey", "o_orderdate", "o_orderdate", ["price"]).select("listing", "last_price")


@query("""select o.o_orderkey as listing, max_by(p.o_totalprice, strftime(p.o_orderdate, '%Y%m%d%H%M%S') || lpad(cast(p.o_orderkey as varchar), 12, '0')) as last_price from orders o left join orders p on p.o_custkey = o.o_custkey and p.o_orderdate < o.o_orderdate
  group by o.o_orderkey""")
def as_of_all_orders(spark, d):
    """Each order looked up in the log of all earlier orders."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("listing"), F.col("o_custkey").alias("custkey"), "o_orderdate", F.col("o_totalprice").alias("price"))
    log = o.groupBy("custkey", "o_orderdate").agg(F.max_by("price", "listing").alias("price"))
    return J.as_of(o.drop("price"), log, "custkey", "o_orderdate", "o_orderdate", ["price"]).select("listing", "last_price")


@query("""with s as (select user_id, event_id, ts, value > 50 as stale, row_number() over (partition by user_id order by ts, event_id) as pos from events),
i as (select *, sum(case when stale then 0 else 1 end) over (partition by user_id order by pos rows unbounded preceding) as island from s),
r as (select *, sum(case when stale then 1 else 0 end) over (partition by user_id, island order by pos rows unbounded preceding) as streak from i),
c as (select *, min(case when stale and streak >= 3 then pos end) over (partition by user_id) as cut from r)
select event_id, cast(streak as bigint) as streak from c where cut is null or pos <= cut""")
def stale_streak(spark, d):
    e = table(spark, d, "events")
    return W.streak_cut(e, ["user_id"], ["ts", "event_id"], F.col("value") > 50, 3).select("event_id", "streak")


@query("select event_type as level, cast(date_trunc('week', ts) as date) as week, count(*) as n, count(*) - coalesce(lag(count(*)) over (partition by event_type order by date_trunc('week', ts)), 0) as change from events group by event_type, date_trunc('week', ts)")
def weekly_levels(spark, d):
    g = table(spark, d, "events").groupBy(F.col("event_type").alias("level"), F.date_trunc("week", "ts").cast("date").alias("week")).agg(F.count("*").alias("n"))
    return g.withColumn("change", F.col("n") - F.coalesce(F.lag("n").over(Window.partitionBy("level").orderBy("week")), F.lit(0)))


@query("select event_type, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as k from events group by event_type")
def nested_json(spark, d):
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(v).alias("k"))


@query("select page_id, cast(len(regexp_extract_all(html, '<li>')) as bigint) as cards, length(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) as text_length from pages")
def page_cards(spark, d):
    p = table(spark, d, "pages")
    n = cards(p, "li").groupBy("page_id").agg(F.count("*").alias("cards"))
    return p.select("page_id", F.length(P.strip_tags(F.col("html"))).cast("long").alias("text_length")).join(n, "page_id", "left").select("page_id", F.coalesce("cards", F.lit(0)).alias("cards"), "text_length")


@query("select doc_id, concat_ws(',', case when regexp_matches(lower(text), 'fibrocemento|eternit|amianto') then 'asbestos' end, case when regexp_matches(lower(text), 'ex galvanica|carrozzeria|distributore') then 'contamination' end, case when regexp_matches(lower(text), 'alluvion|esond') then 'flood' end, case when regexp_matches(lower(text), 'umidità|infiltrazion') then 'damp' end) as alerts, coalesce(regexp_matches(lower(text), 'capannone|magazzino|deposito'), false) as relevant from documents")
def text_alerts(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", F.array_join(P.alerts(F.col("text")), ",").alias("alerts"), F.coalesce(P.is_relevant(F.col("text")), F.lit(False)).alias("relevant"))


@query(f"""{L}, s as (select unnest([261.0, 320.0, 380.0]) as tariff), h as (select unnest([3.5, 6.0]) as height)
select listing_id, cast(tariff as double) as tariff, cast(height as double) as height, n * tariff * 0.82 * 0.58 / nullif(p * 1.06 + g * 525.0 + g * 0.68 * m * 185.0, 0) as yoc from
 (select listing_id, tariff, height, cast(sqm as double) as g, cast(price as double) as p, case when height >= 5.5 then 0.8 when height >= 4.5 then 0.5 else 0.0 end as m, cast(sqm as double) * 0.68 * (1 + case when height >= 5.5 then 0.8 when height >= 4.5 then 0.5 else 0.0 end) as n from l, s, h)""")
def yield_scenarios(spark, d):
    c = Config()
    grid = F.explode(F.array(*(F.struct(F.lit(t).alias("tariff"), F.lit(h).alias("height")) for t in c.tariffs for h in (3.5, 6.0)))).alias("s")
    r = listings(spark, d).select("listing_id", F.col("sqm").cast("double").alias("g"), F.col("price").cast("double").alias("p"), grid).select("listing_id", "g", "p", "s.*")
    return r.select("listing_id", "tariff", "height", S.yield_on_cost(S.net_sqm(F.col("g"), F.col("height"), c), S.all_in_cost(F.col("p"), F.col("g"), F.col("height"), c), F.col("tariff"), c).alias("yoc"))


@query(f"{L} select listing_id, coalesce(cast(sqm as double), avg(cast(sqm as double)) over (partition by town)) as imputed, case when sqm is not null then 'alta' else 'bassa' end as confidence from l")
def imputed_surface(spark, d):
    rows = listings(spark, d)
    return J.imputed(rows.select("listing_id", "town"), rows.select("listing_id", "sqm"), "listing_id", "town", "sqm").select("listing_id", F.round("imputed", 6).alias("imputed"), "confidence")


@query(f"""{L}, r as (select *, number % 2 = 0 as past from l), m as (select a.listing_id, b.listing_id as id, b.number from r a join r b on a.court = b.court and a.procedure = b.procedure and coalesce(a.lot, '?') = coalesce(b.lot, '?') where not a.past and b.past)
select listing_id, max_by(id, lpad(cast(number as varchar), 12, '0')) as id from m group by listing_id""")
def known_announcements(spark, d):
    rows = listings(spark, d).withColumns({"identity_key": P.identity_key(F.col("court"), F.col("procedure"), F.col("lot")), "alias_ids": F.array().cast("array<string>")})
    registry = rows.where("number % 2 = 0").select(F.col("listing_id").alias("id"), F.lpad(F.col("number").cast("string"), 12, "0").alias("date"), F.lit("old").alias("file"), "alias_ids", "identity_key")
    return J.matched_history(rows.where("number % 2 = 1"), registry, "new").select("listing_id", "id")


@query(f"""{L}, n as (select *, price * (1 - 0.013 * (number % 9 - 4)) as now_price, cast(number % 17 - 8 as int) as gain from l)
select listing_id, case when ((now_price - price) / price <= -0.03 or gain >= 5) and not gain <= -5 then 'MIGLIORATA' when (now_price - price) / price > 0.03 or gain <= -5 then 'PEGGIORATA' else 'INVARIATA' end as verdict from n""")
def comparison_verdicts(spark, d):
    r = listings(spark, d)
    none = F.array().cast("array<string>")
    same = {"deadline": F.col("deadline"), "outcome": F.lit("PROMUOVI"), "missing": none, "width": F.lit(0.0), "config": F.lit("x"), "run_date": _today()}
    now = same | {"price": F.expr("price * (1 - 0.013 * (number % 9 - 4))"), "vote": F.expr("cast(50 + number % 17 - 8 as int)")}
    return r.select("listing_id", S.comparison(now, same | {"price": F.col("price"), "vote": F.lit(50)}, Config())["verdict"].alias("verdict"))


@query(f"{L} select listing_id, town, price from l where contains(lower(listing_id), 'vgi_1') or contains(town, 'ger')")
def history_search(spark, d):
    return listings(spark, d).where(F.contains(F.lower("listing_id"), F.lit("vgi_1")) | F.contains("town", F.lit("ger"))).select("listing_id", "town", "price")


@query(f"""{L}, p as (select source, cast(floor(number / 40) as bigint) as page, town from l), f as (select *, min(page) over (partition by source, town) as first from p), n as (select *, sum(case when first = page then 1 else 0 end) over (partition by source, page) as new from f),
s as (select *, min(case when new = 0 then page end) over (partition by source) as stop from n) select source, page, count(*) as n from s where stop is null or page < stop group by source, page""")
def pages_before_repeat(spark, d):
    p = listings(spark, d).select("source", F.floor(F.col("number") / 40).cast("long").alias("page"), "town")
    return W.before_repeat(p, ["source"], "page", "town").groupBy("source", "page").agg(F.count("*").alias("n"))


@query(f"""{L} select listing_id, rule from (select listing_id, case when price is null then 'price' end as rule from l union all select listing_id, case when sqm is null then 'sqm' end from l union all select listing_id, case when days_left < 0 then 'deadline' end from l) where rule is not null""")
def contract_violations(spark, d):
    rules = F.array_compact(F.array(F.when(F.col("price").isNull(), "price"), F.when(F.col("sqm").isNull(), "sqm"), F.when(F.col("days_left") < 0, "deadline")))
    return listings(spark, d).select("listing_id", F.explode(rules).alias("rule"))


@query(f"{L} select town, count(*) as n from l where category in ('capannone', 'residenziale') and source = 'medianord' group by town")
def requested_towns(spark, d):
    on = {"town": True, "sale": True, "off": False}
    r = X.composed(listings(spark, d), on, {"town": F.col("category").isin("capannone", "residenziale"), "sale": F.col("source") == "medianord", "off": F.lit(False)})
    return r.groupBy("town").agg(F.count("*").alias("n"))


@query(f"""{L}, k as (select source, year, count(*) as n from l group by source, year) select source, year, n, coalesce(n < 0.5 * lag(n) over (partition by source order by year), false) as alarm from k""")
def volume_alarm(spark, d):
    g = listings(spark, d).groupBy("source", "year").agg(F.count("*").alias("n"))
    return g.withColumn("alarm", F.coalesce(F.col("n") < 0.5 * F.lag("n").over(Window.partitionBy("source").orderBy("year")), F.lit(False)))


@query("""with f as (select o_orderkey as k, o_custkey as c, o_orderdate as updated_at from orders where o_orderkey % 2 = 1), b as (select o_custkey as c, max(o_orderdate) as scraped_at from orders where o_orderkey % 2 = 0 and o_custkey % 5 > 0 group by 1),
s as (select case when b.c is null then 'new' when scraped_at is null or updated_at is null then 'unverifiable' when epoch(scraped_at) - epoch(updated_at) < 7 * 86400 then 'recent' else 'stale' end as status from f left join b using (c))
select status, count(*) as n from s group by status""")
def weekly_freshness(spark, d):
    o = table(spark, d, "orders")
    fresh = o.where("o_orderkey % 2 = 1").select(F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("updated_at"))
    base = o.where("o_orderkey % 2 = 0 and o_custkey % 5 > 0").groupBy(F.col("o_custkey").alias("c")).agg(F.max("o_orderdate").alias("scraped_at"))
    return Fresh.status_counts(Fresh.weekly_status(fresh, base, "c"))


@query("""with s as (select *, value > 70 as b, row_number() over (partition by user_id order by ts, event_id) as pos from events), i as (select *, sum(case when b then 0 else 1 end) over (partition by user_id order by pos rows unbounded preceding) as island from s),
r as (select *, sum(case when b then 1 else 0 end) over (partition by user_id, island order by pos rows unbounded preceding) as run from i), c as (select *, min(case when run >= 2 then pos end) over (partition by user_id) as cut from r)
select event_id, cut is null or pos <= cut as attempted from c""")
def load_breaker(spark, d):
    return Fresh.breaker(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value") > 70, 2).select("event_id", "attempted")


@query("select event_id from (select event_id, row_number() over (partition by user_id order by event_id desc) as n from events) where n <= 20")
def last_log_lines(spark, d):
    return Fresh.last_lines(table(spark, d, "events"), "user_id", "event_id", 20).select("event_id")


@query(f"""{L}, a as (select year as file, listing_id as id from l where number % 4 > 0), b as (select year as file, listing_id as id from l where number % 5 > 0)
select file, id, 'registry' as side from a where not exists (select 1 from b where a.file = b.file and a.id = b.id) union all select file, id, 'report' from b where not exists (select 1 from a where a.file = b.file and a.id = b.id)""")
def registry_links(spark, d):
    rows = listings(spark, d).select(F.col("year").alias("file"), F.col("listing_id").alias("id"), "number")
    return Pub.broken_links(rows.where("number % 4 > 0"), rows.where("number % 5 > 0"))


@query(f"""{L}, g as (select make_date(year, 1, 1) as run_date, count(*) as n, count(*) filter (where number % 3 = 0) as n_new, max(number % 100) as best from l group by year)
select run_date, n, n_new, best, cast(run_date - lag(run_date) over (order by run_date) as int) as days_since from g""")
def report_summaries(spark, d):
    rows = listings(spark, d).select(F.make_date("year", F.lit(1), F.lit(1)).alias("run_date"), F.when(F.expr("number % 3 = 0"), "NUOVA").alias("state"), F.expr("number % 100").alias("vote"))
    return Pub.summaries(rows)


@query(f"{L} select listing_id, number % 101 as vote from l where year = (select max(year) from l) order by vote desc, listing_id limit 3")
def latest_top(spark, d):
    return Pub.latest(listings(spark, d).select("listing_id", F.expr("number % 101").alias("vote"), F.col("year").alias("run_date"))).select("listing_id", "vote")


@query("""with s as (select p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') as slug, p_retailprice from part)
select p_partkey, slug, translate(format('{:,.2f}', p_retailprice), ',.', '.,') as amount from s""")
def slugs_and_amounts(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", P.slug(F.concat_ws(" ", "p_name", "p_type")).alias("slug"), P.italian_amount(F.col("p_retailprice"), 2).alias("amount"))


@query(f"{L}, x as (select listing_id from l where number % 2 = 0), y as (select listing_id from l where number % 3 = 0) select 'only first' as side, count(*) as n from (select * from x except select * from y) union all select 'both', count(*) from (select * from x intersect select * from y)")
def set_differences(spark, d):
    rows = listings(spark, d)
    x, y = rows.where("number % 2 = 0").select("listing_id"), rows.where("number % 3 = 0").select("listing_id")
    count = lambda r, s: r.agg(F.lit(s).alias("side"), F.count("*").alias("n"))
    return count(x.subtract(y), "only first").union(count(x.intersect(y), "both"))


@query(f"{L} select source, count(*) filter (where regexp_matches(listing_id, '^[a-z]+_[0-9]+$')) as well_formed, count(*) - count(distinct custkey) as repeated from l group by source")
def key_audit(spark, d):
    return listings(spark, d).groupBy("source").agg(F.count_if(F.col("listing_id").rlike("^[a-z]+_[0-9]+$")).alias("well_formed"), (F.count("*") - F.count_distinct("custkey")).alias("repeated"))


@query(f"{EVAL_SQL} select reason, listing_id from o where reason is not null and outcome = 'SCARTA'")
def discarded_listings(spark, d):
    """One row a discarded listing; ``publish.publish_discarded`` writes them by reason."""
    return _evaluated(spark, d).where("reason is not null and outcome = 'SCARTA'").select("reason", "listing_id")


@query(f"{EVAL_SQL} select reason, count(*) as n from o where reason is not null and outcome = 'SCARTA' group by reason")
def discarded_counts(spark, d):
    return discarded_listings(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{L}, e as (select source, count(*) + 10 as expected from l group by source), f as (select source, count(*) as found from l where number % 3 > 0 group by source) select source, expected, coalesce(found, 0) as found, coalesce(found, 0) / expected as share from e left join f using (source)")
def hub_coverage(spark, d):
    rows = listings(spark, d)
    return Fresh.coverage(rows.where("number % 3 > 0"), rows.groupBy("source").agg((F.count("*") + 10).alias("expected")), ["source"])


from propscan.plans import evaluation_queries, source_queries  # noqa: E402, F401  (they register themselves)

__all__ = ["ORACLE_SQL", "QUERIES"]
