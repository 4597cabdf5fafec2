"""Queries over the evaluation: scorecard, resolution, ranking, history and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from propscan.config import Config
from propscan.functions import describe as D
from propscan.functions import score as S
from propscan.operators import audits as A
from propscan.operators import filters as X
from propscan.operators import joins as J
from propscan.operators import resolve as R
from propscan.operators import windows as W
from propscan.plans import freshness as Fresh
from propscan.plans import publish as Pub
from propscan.plans import releases as Rel
from propscan.plans.demo import RUN_DATE, TOWNS, facts, listings, points, table, towns
from propscan.plans.evaluate import announced, evaluated, ranking_key, scorecard, with_optional
from propscan.plans.expected import CRITERIA, EVAL_SQL, L, km
from propscan.plans.registry import query
from propscan.storage import new_path, written


def _evaluated(spark, d):
    """The evaluation, written once: what is ranked, counted and compared reads columns and not the scorecard's expressions."""
    return written(evaluated(facts(spark, d), RUN_DATE).drop("scores"), "evaluated")


@query(f"{EVAL_SQL} select listing_id, {', '.join(f'round({c}_{x}, 6) as {c}_{x}' for c in CRITERIA for x in ('lo', 'mid', 'hi'))} from o")
def criteria(spark, d):
    """The eleven criteria of each listing."""
    rows = with_optional(facts(spark, d)).select("listing_id", *[v.alias(n) for n, v in scorecard().items()])
    return rows.select("listing_id", *[F.round(F.col(f"{n}.{x}"), 6).alias(f"{n}_{x}") for n in CRITERIA for x in ("lo", "mid", "hi")])


@query(f"""{EVAL_SQL} select listing_id, reason, all_reasons, flags, case when q_hi - q_lo > 15 then null when q_mid >= 75 then 'A' when q_mid >= 60 then 'B' when q_mid >= 45 then 'C' end as class, vote, outcome, hurdle, round(yoc, 8) as yoc,
  round(yoc_offer, 8) as yoc_offer, round(cost / nullif(net, 0), 4) as cost_per_net, cast(case permit when 'libero' then 0 when 'scia' then 8 when 'pdc' then 12 when 'variante' then 18 when 'incerto' then 18 end as int) as months,
  round(net * 261.0 * 0.82 * 0.58 / 12 * months + cost * 0.05 * months / 12, 2) as discount from o""")
def evaluation(spark, d):
    e = _evaluated(spark, d)
    r = lambda c, n, as_: F.round(c, n).alias(as_)
    return e.select(
        "listing_id", "reason", F.array_join("all_reasons", ",").alias("all_reasons"), F.array_join("flags", ",").alias("flags"), "class", "vote", "outcome", "hurdle",
        r("yoc_base", 8, "yoc"), r("yoc_offer", 8, "yoc_offer"), r("cost_per_net", 4, "cost_per_net"), "months", r("discount", 2, "discount"),
    )


_RANKED = f"""{EVAL_SQL}, rk as (select *, row_number() over (order by vote desc, yoc desc nulls last, days_left, listing_id) as rank from o where outcome in ('PROMUOVI', 'DA APPROFONDIRE')),
  kept as (select *, row_number() over (order by rank) as position from rk where number % 5 <> 0)"""


@query(f"{_RANKED} select listing_id, rank, position, rank - position as skipped, cast(null as varchar) as note from kept where position <= 10")
def announced_after_history(spark, d):
    """The ranking without what was announced before and hasn't changed: every fifth listing here, each named twice."""
    e = _evaluated(spark, d)
    old = e.where("number % 5 = 0").select("listing_id")
    long = lambda c: F.col(c).cast("long").alias(c)
    return announced(e, old.union(old)).select("listing_id", long("rank"), long("position"), long("skipped"), "note")


@query(f"{_RANKED} select (select count(*) from o) as n_read, (select count(*) from rk) as ranked, (select max(rank - position) from kept where position <= 10) as skipped, (select count(*) from kept where position <= 10) as announced")
def ranking_counts(spark, d):
    e = _evaluated(spark, d)
    best = announced(e, e.where("number % 5 = 0").select("listing_id")).agg(F.max("skipped").cast("long").alias("skipped"), F.count("*").alias("announced"))
    return e.agg(F.count("*").alias("n_read"), F.count_if(F.col("outcome").isin("PROMUOVI", "DA APPROFONDIRE")).alias("ranked")).crossJoin(best)


#: Edges of the four rules; a lot's edges lead from its smallest listing.
_EDGES = f"""{L}, t as (select *, lower(trim(court)) as k, cast(regexp_extract(listing_id, '[0-9]+$') as bigint) as num from l),
one as (select h.a, t.listing_id as b, 1 as rule from t join (select num, min(listing_id) as a from t where source = 'vgi' group by num) h on h.num = t.num where t.source in ('vgi', 'asteannunci') and t.listing_id <> h.a),
two as (select h.a, t.listing_id as b, 2 as rule from t join (select k, procedure, lot, min(listing_id) as a from t where lot is not null group by k, procedure, lot) h on h.k = t.k and h.procedure = t.procedure and h.lot = t.lot where t.listing_id <> h.a),
three as (select x.listing_id as a, y.listing_id as b, 3 as rule from t x join t y on x.k = y.k and x.procedure = y.procedure and x.town = y.town and x.listing_id < y.listing_id where x.lot is null and y.lot is null and abs(x.sqm - y.sqm) <= 0.05 * greatest(x.sqm, y.sqm)),
four as (select x.listing_id as a, y.listing_id as b, 4 as rule from t x join t y on x.category = y.category and abs(x.lat - y.lat) < 0.005 and abs(x.lon - y.lon) < 0.005 and x.listing_id < y.listing_id where {km("x.", "y.")} <= 0.1),
five as (select x.listing_id as a, y.listing_id as b, 5 as rule from t x join t y on x.town = y.town and x.listing_id < y.listing_id and x.source <> y.source and abs(x.sqm - y.sqm) <= 0.03 * greatest(x.sqm, y.sqm) and abs(x.price - y.price) <= 0.02 * greatest(x.price, y.price) where x.sqm > 0 and y.sqm > 0),
u as (select * from one union all select * from two union all select * from three union all select * from four union all select * from five),
e as (select distinct u.a, u.b, u.rule from u join t x on x.listing_id = u.a join t y on y.listing_id = u.b where not coalesce(x.k = y.k and x.procedure = y.procedure and x.lot <> y.lot, false))"""


@query(f"{_EDGES} select a, b, rule from e")
def property_edges(spark, d):
    """Which listings are the same property, by rule, over all listings."""
    return R.edges(listings(spark, d))


def _listings(spark, d):
    """What tells properties, written once: each rule of the links reads it."""
    return written(listings(spark, d).select("listing_id", "source", "number", "court", "procedure", "lot", "town", "sqm", "price", "category", "lat", "lon"), "listings")


def _properties(spark, d):
    rows = _listings(spark, d)
    return rows, R.properties(rows, R.links(rows, markets=None))


_SITE = f"{L}, w as (select *, case when number % 5 > 0 then 1 end as one, case when number % 7 > 0 then 2 end as two from l)"


@query(f"""{_SITE} select 'current' as release, source, count(*) as n, cast(sum(price * 2) as decimal(20,2)) as prices from w where two = 2 group by source union all select 'past', source, count(*), sum(price) from w where one = 1 group by source
  union all select 'registry', source, count(one) + count(two), cast(sum(case when one = 1 then price else 0 end + case when two = 2 then price * 2 else 0 end) as decimal(20,2)) from w where number % 3 = 0 group by source""")
def published_releases(spark, d):
    """Two weeks published one after the other, the second twice: current and past listings, and the registry of both."""
    site, rows = new_path(spark, "site"), listings(spark, d).select("listing_id", "source", "price", "number")
    one, two = rows.where("number % 5 > 0"), rows.where("number % 7 > 0").withColumn("price", (F.col("price") * 2).cast("decimal(14,2)"))
    for version, t in (("2026-09-09", one), (RUN_DATE, two), (RUN_DATE, two)):
        Rel.publish(site, version, {"listings": t, "registry": t.where("number % 3 = 0")}, appended=("registry",))
    count = lambda name, t: t.groupBy("source").agg(F.count("*").alias("n"), F.sum("price").cast("decimal(20,2)").alias("prices")).select(F.lit(name).alias("release"), "*")
    return count("current", Rel.released(spark, site, "listings")).union(count("past", Rel.released(spark, site, "listings", 1))).union(count("registry", Rel.released(spark, site, "registry")))


@query()  # components that keep lots apart are too slow in SQL: tests join the rules' links one after another
def resolved_properties(spark, d):
    """Each listing's property: all rules' links, without two lots of a procedure in one property."""
    return _properties(spark, d)[1]


def _merged(spark, d):
    rows, of = _properties(spark, d)
    rows, of = rows.withColumn("url", F.concat(F.lit("https://"), "source", F.lit("/"), "listing_id")), written(of, "properties")
    return rows, of, R.survivors(rows, of, ["price", "sqm", "lot", "court", "procedure"])


@query()
def merged_properties(spark, d):
    """The richest listing of each property, and how many it has."""
    return _merged(spark, d)[2].select("property_id", "listing_id", "n_listings")


@query()
def properties_over_weeks(spark, d):
    """Properties of all listings after a week that lacked one in fifty and priced one in forty otherwise: last week's ids stay."""
    rows = _listings(spark, d)
    past = rows.where("number % 50 <> 1").withColumn("price", F.expr("case when number % 40 = 0 then cast(price * 2 as decimal(14,2)) else price end"))
    before = R.weekly_properties(past, R.links(past, markets=None), "2026-09-09")
    return R.weekly_properties(rows, R.links(rows, markets=None), RUN_DATE, before).select("listing_id", "property_id", "component")


@query()
def property_aliases(spark, d):
    """The other listings of each property, a row each."""
    return R.aliases(*_merged(spark, d))


@query()
def weekly_announcements(spark, d):
    """The whole chain: properties of all listings, one record each, evaluation, history of earlier announcements, comparison and
    the ten best that are new or better."""
    rows = written(facts(spark, d), "facts")
    of = R.properties(rows, R.links(rows, markets=None))
    best = R.survivors(rows, of, ["price", "sqm", "lot", "height", "permit"])
    now = written(evaluated(best, RUN_DATE), "evaluated")
    compared = _compared(now, *_past(now))
    old = compared.where("snapshot is not null and verdict <> 'MIGLIORATA'").select("listing_id")
    top = announced(now, old)
    state = F.when(F.col("verdict") == "MIGLIORATA", "RISEGNALATA").otherwise("NUOVA")
    return top.join(compared.select("listing_id", "verdict", "positives"), "listing_id", "left").select("position", "rank", "listing_id", "property_id", "vote", "outcome", state.alias("state"), F.array_join("positives", ",").alias("reasons"))


def _past(now):
    """Registry and report items of earlier weeks, derived from this week's: a third of the listings, some twice, some items lost."""
    keys = now.select(F.col("listing_id").alias("id"), "number", "court", "procedure", "lot", "price", "vote", "deadline", "outcome", "quality", "height", "sqm", "free", "title")
    rows = keys.where("number % 3 = 0").select("*", F.explode(F.when(F.expr("number % 6 = 0"), F.array(F.lit("2026-09-02"), F.lit("2026-09-09"))).otherwise(F.array(F.lit("2026-09-02")))).alias("date"))
    rows = rows.withColumn("file", F.concat(F.lit("report_"), F.replace("date", F.lit("-"), F.lit("_")), F.lit(".json")))
    registry = rows.select("id", "date", "file", F.array().cast("array<string>").alias("alias_ids"), F.lit(None).cast("string").alias("identity_key"))
    late = F.col("date") == "2026-09-09"
    items = rows.where("number % 15 <> 0").select(
        "file", "id", (F.col("price") * F.expr("1 + 0.013 * (number % 9 - 4) - case when number % 24 = 0 then 0 when number % 27 = 0 then -2 else 0 end")).cast("double").alias("price"),
        (F.col("vote") + F.expr("number % 17 - 8") + F.when(late, 1).otherwise(0)).cast("int").alias("vote"), F.date_add("deadline", F.expr("case when number % 4 = 0 then -40 else 0 end")).alias("deadline"),
        F.when(F.expr("number % 7 = 0"), "PROMUOVI").when(F.expr("number % 7 = 1"), "SCARTA").otherwise(F.col("outcome")).alias("outcome"), F.expr("case when number % 5 = 0 then array('height') else array() end").cast("array<string>").alias("missing"),
        (F.col("quality.hi") - F.col("quality.lo") + F.expr("case when number % 2 = 0 then 12 else 0 end")).alias("width"), F.expr("case when number % 4 = 2 then 'other' else 'this' end").alias("config"),
        F.expr("case when number % 5 <> 0 then height end").alias("height"), F.expr("case when number % 9 <> 0 then not free end").alias("occupied"), F.lit(None).cast("string").alias("tenure"),
    )
    return registry, items


def _compared(now, registry, items, c=None):
    c = c or Config()
    own = now.withColumns({"alias_ids": F.array().cast("array<string>"), "identity_key": F.lit(None).cast("string")})
    found = J.with_snapshot(J.matched_history(own, registry, "report_2026_09_16.json"), items)
    both = now.join(found, "listing_id")
    missing = D.missing_data({"height": F.col("height"), "sqm": F.col("sqm")})
    is_now = {"price": F.col("price").cast("double"), "vote": F.col("vote"), "deadline": F.col("deadline"), "run_date": F.lit(RUN_DATE).cast("date"), "outcome": F.col("outcome"), "missing": F.transform(missing, lambda m: m["field"]), "width": F.col("quality.hi") - F.col("quality.lo"), "config": F.lit("this"), "height": F.col("height"), "occupied": ~F.col("free"), "tenure": F.col("title")}
    was = {n: F.col(f"snapshot.{n}") for n in is_now if n != "run_date"}
    result = S.comparison(is_now, was, c)
    return both.select("listing_id", "id", "date", "file", "snapshot", "note", *[v.alias(n) for n, v in result.items()])


#: CTE ``g``: this week's listings against their latest announcement, reason by reason.
_HISTORY = f"""{EVAL_SQL}, w as (select *, date '{RUN_DATE}' + days_left as deadline, q_hi - q_lo as width_now from o),
r as (select *, unnest(case when number % 6 = 0 then ['2026-09-02', '2026-09-09'] else ['2026-09-02'] end) as day from w where number % 3 = 0),
m as (select * from r qualify row_number() over (partition by listing_id order by day desc) = 1),
i as (select *, number % 15 <> 0 as has, cast(price * (1 + 0.013 * (number % 9 - 4) - case when number % 24 = 0 then 0 when number % 27 = 0 then -2 else 0 end) as double) as was_price, vote + number % 17 - 8 + case when day = '2026-09-09' then 1 else 0 end as was_vote,
  deadline - cast(case when number % 4 = 0 then 40 else 0 end as int) as was_deadline, case when number % 7 = 0 then 'PROMUOVI' when number % 7 = 1 then 'SCARTA' else outcome end as was_outcome,
  width_now + case when number % 2 = 0 then 12 else 0 end as was_width, number % 4 <> 2 as same_config from m),
c as (select *, (p - was_price) / nullif(was_price, 0) as change, vote - was_vote as gain, case outcome when 'SCARTA' then 0 when 'MONITORA' then 1 when 'DA APPROFONDIRE' then 2 else 3 end as rk_now,
  case was_outcome when 'SCARTA' then 0 when 'MONITORA' then 1 when 'DA APPROFONDIRE' then 2 else 3 end as rk_was from i),
b as (select *, change <= -0.03 as p1, (number % 5 = 0 and height is not null) and (rk_now > rk_was or was_width - width_now >= 10) as p2, deadline <> was_deadline and days_left >= 20 as p3,
  change > 0.03 as n1, gain <= -5 as n2, rk_now < rk_was as n3, (number % 5 = 0 and coalesce(height < 3, false)) or ((number % 9 = 0 or free is null) and coalesce(not free, false)) or regexp_matches(title, 'quota|nuda') as n4 from c),
g as (select *, gain >= 5 and (same_config or p1 or p2 or p3) as p4 from b)"""
_VERDICT = "case when not has then null when (p1 or p2 or p3 or p4) and not (n2 or n3) then 'MIGLIORATA' when n1 or n2 or n3 or n4 then 'PEGGIORATA' else 'INVARIATA' end as verdict"


@query(f"""{_HISTORY}
select listing_id, day as date, case when has then concat_ws(',', case when p1 then 'PREZZO_SCESO' end, case when p2 then 'DATO_SBLOCCATO' end, case when p3 then 'ASTA_DI_NUOVO_AZIONABILE' end, case when p4 then 'VOTO_SALITO' end) end as positives,
  case when has then concat_ws(',', case when n1 then 'PREZZO_SALITO' end, case when n2 then 'VOTO_SCESO' end, case when n3 then 'ESITO_PEGGIORATO' end, case when n4 then 'DATO_SFAVOREVOLE' end) end as negatives,
  case when has then case when change <= -0.5 then 'VERIFICARE_PERIMETRO_LOTTO' else '' end end as flags,
  {_VERDICT},
  case when not has then 'segnalata il ' || day || ' ma il file storico report_' || replace(day, '-', '_') || '.json è illeggibile: confronto impossibile' end as note from g""")
def compared_history(spark, d):
    """Each listing against its latest announcement's snapshot, with all reasons; lost snapshots have a note."""
    now = _evaluated(spark, d)
    rows = _compared(now, *_past(now))
    known = F.col("snapshot").isNotNull()
    return rows.select("listing_id", "date", *[F.when(known, F.array_join(n, ",")).alias(n) for n in ("positives", "negatives", "flags")], F.when(known, F.col("verdict")).alias("verdict"), "note")


@query(f"""{_HISTORY}, z_v as (select listing_id, {_VERDICT} from g),
z_m as (select o.*, z_v.verdict from o left join z_v using (listing_id) qualify lot is null or listing_id = (min(listing_id) over (partition by lower(trim(court)), procedure, lot))),
z_m2 as (select *, outcome in ('PROMUOVI', 'DA APPROFONDIRE') as ranked from z_m),
z_rk as (select *, row_number() over (order by vote desc, yoc desc nulls last, days_left, listing_id) as rank from z_m2 where ranked),
z_top as (select *, row_number() over (order by rank) as position from z_rk where coalesce(verdict, 'MIGLIORATA') = 'MIGLIORATA' qualify position <= 10),
z_pa as (select verdict from z_rk where verdict in ('INVARIATA', 'PEGGIORATA') and ((select count(*) from z_top) < 10 or rank < (select max(rank) from z_top)))
select statistic, key, cast(n as bigint) as n from (select 'record_letti' as statistic, null as key, count(*) as n from o union all select 'duplicati_uniti', null, (select count(*) from o) - count(*) from z_m2
  union all select 'per_esito', k, (select count(*) from z_m2 where outcome = k) from (values ('PROMUOVI'), ('DA APPROFONDIRE'), ('MONITORA'), ('SCARTA')) t(k)
  union all select 'scarti_per_motivo', reason, count(*) from z_m2 where outcome = 'SCARTA' and reason is not null group by reason
  union all select 'in_classifica', null, count(*) from z_rk union all select 'posizioni_scorse', null, count(*) from z_pa
  union all select 'escluse_per_storico', k, (select count(*) from z_pa where verdict = k) from (values ('INVARIATA'), ('PEGGIORATA')) t(k)
  union all select 'segnalate', 'totale', count(*) from z_top union all select 'segnalate', 'nuove', count(*) filter (where verdict is null) from z_top union all select 'segnalate', 'risegnalate', count(*) filter (where verdict is not null) from z_top
  union all select 'segnalate', 'da_' || k, (select count(*) from z_top where channel = k) from (values ('ASTE'), ('IMM_ID')) t(k))""")
def report_numbers(spark, d):
    """All numbers of a report: read, merged (listings of one lot), outcomes, reasons, ranked, passed over by verdict, announced."""
    read = facts(spark, d)
    head = R.same_lot(read).select(F.col("b").alias("listing_id"))
    now = written(evaluated(read.join(head, "listing_id", "left_anti"), RUN_DATE).drop("scores"), "evaluated")
    verdicts = _compared(now, *_past(now)).where("snapshot is not null").select("listing_id", "verdict")
    top = announced(now, verdicts.where("verdict <> 'MIGLIORATA'"))
    return Pub.report_statistics(read, now, verdicts, top, ranking_key())


_TARGETS = "select lower(n_name) as town, 36.0 + (n_nationkey * 137 % 1000) / 100.0 as lat, 7.0 + (n_nationkey * 311 % 1000) / 100.0 as lon from {nation} where n_nationkey % 6 = 1"
_PLACED = "listing_id, case when number % 13 > 0 then town end as town, case when number % 11 > 0 then cast(lat as double) end as lat, case when number % 11 > 0 then cast(lon as double) end as lon"


@query(f"""{L}, p as (select {_PLACED} from l), t as ({_TARGETS.format(nation="nation")}),
n as (select listing_id, min({km("p.", "t.")}) as km from p join t on abs(p.lat - t.lat) < 1 where {km("p.", "t.")} <= 30 group by listing_id),
x as (select p.*, n.km, p.town in (select town from t) as hit from p left join n using (listing_id))
select listing_id, round(case when hit then 0.0 else km end, 6) as km, case when town = 'china' then false when hit or km is not null then true when lat is not null then false end as inside, not coalesce(hit, false) and lat is not null and km is null as beyond from x""")
def inside_perimeter(spark, d):
    """Listings in a target town or within 30 km of one, by name or place; unknown places stay unknown."""
    targets = spark.sql(_TARGETS, nation=table(spark, d, "nation")).select("town", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    rows = J.with_perimeter(listings(spark, d).selectExpr(*_PLACED.split(", case")[:1], *("case" + x for x in _PLACED.split(", case")[1:])), targets, ["china"])
    beyond = F.coalesce(F.col("distance_km") == float("inf"), F.lit(False))
    return rows.select("listing_id", F.round(F.when(~beyond, F.col("distance_km")), 6).alias("km"), "inside", beyond.alias("beyond"))


@query("""with tw as (select lower(n_name) as town, lower(r_name) as province, case when n_nationkey % 4 > 0 then cast(n_nationkey * 37 % 100 as double) end as i from nation join region on n_regionkey = r_regionkey)
select c_custkey, province, i as town_index, round(avg_i, 6) as province_index, case when i is not null then 'alta' when avg_i is not null then 'bassa' end as confidence
from customer join nation on c_nationkey = n_nationkey left join tw on tw.town = lower(n_name) left join (select province, avg(i) as avg_i from tw group by province) using (province)""")
def town_index(spark, d):
    """Index of each customer's town, and the mean of its province where the town has none."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit(" "), "n_name").alias("town"))
    confidence = F.when(F.col("town_index").isNotNull(), "alta").when(F.col("province_index").isNotNull(), "bassa")
    return J.with_town(rows, towns(spark, d)).select("c_custkey", "province", "town_index", F.round("province_index", 6).alias("province_index"), confidence.alias("confidence"))


@query(f"""with c as (select c_custkey as id, (c_custkey * 37 % 1779) / 10.0 - 88.9 as lat, (c_custkey * 73 % 3601) / 10.0 - 180 as lon from customer)
select a.id as a, b.id as b, round({km("a.", "b.")}, 6) as km from c a join c b on a.id < b.id and abs(a.lat - b.lat) < 1 where {km("a.", "b.")} <= 100""")
def neighbours_everywhere(spark, d):
    """Pairs within 100 km from pole to pole and round the meridian of 180 degrees."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.expr("(c_custkey * 37 % 1779) / 10.0 - 88.9").cast("double").alias("lat"), F.expr("(c_custkey * 73 % 3601) / 10.0 - 180").cast("double").alias("lon"))
    return J.radius_join(c, c, 100.0, spread=True).where("id < r_id").select(F.col("id").alias("a"), F.col("r_id").alias("b"), F.round("km", 6).alias("km"))


@query(f"""{L}, i as (select listing_id, case when number % 9 = 0 then 'FIERE' when number % 10 < 8 then 'ASTE' else 'IMM_ID' end as channel, number % 103 as vote, case when number % 8 = 0 then ' ' else 'x' end as text, number % 4 = 0 as again, number % 12 > 0 as with_reason from l)
select listing_id, rule from (select listing_id, case when channel = 'FIERE' then 'channel' end as rule from i union all select listing_id, case when vote > 100 then 'vote' end from i union all select listing_id, case when text = ' ' then 'text' end from i
  union all select listing_id, case when again and not with_reason then 'again_without_reason' end from i) where rule is not null""")
def broken_contract(spark, d):
    """Rules that published items break."""
    i = listings(spark, d).select(
        "listing_id", F.expr("case when number % 9 = 0 then 'FIERE' else channel end").alias("channel"), F.expr("number % 103").alias("vote"), F.expr("case when number % 8 = 0 then ' ' else 'x' end").alias("text"),
        F.expr("case when number % 4 = 0 then 'RISEGNALATA' else 'NUOVA' end").alias("state"), F.expr("case when number % 12 > 0 then array('PREZZO_SCESO') else array() end").alias("reasons"),
    )
    return Pub.contract_breaks(i)


_ITEMS = f"{L}, i as (select listing_id, town, price, make_date(2020 + cast(number % 6 as int), 3, 4) as run_date, case when number % 3 = 0 then 'NUOVA' when number % 3 = 1 then 'RISEGNALATA' end as state, number % 101 as vote, case number % 4 when 0 then 'MONITORA' else 'PROMUOVI' end as outcome, channel, days_left from l)"


def _items(spark, d):
    return listings(spark, d).select(
        "listing_id", "town", "price", F.expr("make_date(2020 + cast(number % 6 as int), 3, 4)").alias("run_date"), F.expr("case when number % 3 = 0 then 'NUOVA' when number % 3 = 1 then 'RISEGNALATA' end").alias("state"),
        F.expr("number % 101").alias("vote"), F.expr("case number % 4 when 0 then 'MONITORA' else 'PROMUOVI' end").alias("outcome"), "channel", "deadline", "days_left",
    )


@query(f"{_ITEMS} select run_date, 'report_' || strftime(run_date, '%Y_%m_%d') || '.json' as file, count(*) as n, count(*) filter (where state = 'NUOVA') as n_new, count(*) filter (where state = 'RISEGNALATA') as n_again from i group by run_date")
def reports(spark, d):
    return Pub.report_list(_items(spark, d))


@query(f"{_ITEMS} select listing_id, vote from i where run_date = date '2023-03-04'")
def report_by_name(spark, d):
    return Pub.one_report(_items(spark, d), "report_2023_03_04.json").select("listing_id", "vote")


@query(f"{_ITEMS} select listing_id, vote from i where outcome = 'MONITORA' order by vote desc, listing_id limit 30")
def monitored(spark, d):
    return Pub.monitor_preview(_items(spark, d)).select("listing_id", "vote")


@query(f"{_ITEMS} select listing_id, row_number() over (order by days_left, listing_id) as place from i where channel = 'ASTE' and outcome = 'PROMUOVI' and state = 'NUOVA' qualify place <= 50")
def results_by_deadline(spark, d):
    """The first page (50 items) of one channel, outcome and state, nearest deadline first, with places."""
    page = W.by_choice(_items(spark, d), "deadline", channel="ASTE", outcome="PROMUOVI", state="NUOVA").limit(50)
    return page.select("listing_id", F.row_number().over(W.Window.orderBy(F.asc_nulls_last("deadline"), "listing_id")).cast("long").alias("place"))


@query(f"{_ITEMS} select listing_id, town from i where contains(lower(listing_id), 'vgi_1') or contains(town, 'ger')")
def report_search(spark, d):
    return Pub.search(_items(spark, d), " GER ").union(Pub.search(_items(spark, d), "vgi_1")).select("listing_id", "town").distinct()


@query(f"{L}, r as (select year as file, listing_id from l where number % 2 = 0), n as (select year as file, listing_id from l where number % 2 = 1 and year % 3 = 0) select file, listing_id from r where file % 3 <> 0 union all select * from n")
def registry_after_report(spark, d):
    """The registry with the rows of the files that a new report holds replaced."""
    rows = listings(spark, d).select(F.col("year").alias("file"), "listing_id", "number")
    return Pub.replaced(rows.where("number % 2 = 0").drop("number"), rows.where("number % 2 = 1 and file % 3 = 0").drop("number"))


@query(f"""{L}, a as (select listing_id, price, number from l), b as (select listing_id, case when number % 50 = 0 then price + 1 else price end as price from l where number % 40 <> 0)
select listing_id, side from (select a.listing_id, 'first' as side from a left join b using (listing_id) where b.price is null or a.price <> b.price union all select b.listing_id, 'second' from b join a using (listing_id) where a.price <> b.price)""")
def run_differences(spark, d):
    """Rows in which two runs differ; none for equal ones."""
    rows = listings(spark, d).select("listing_id", "price", "number")
    again = rows.where("number % 40 <> 0").select("listing_id", F.expr("cast(case when number % 50 = 0 then price + 1 else price end as decimal(14,2))").alias("price"))
    return Pub.differences(rows.drop("number"), again).select("listing_id", "side")


@query("""with w as (select event_id, user_id, ts, lag(value) over (partition by user_id order by ts, event_id) as before, value, row_number() over (partition by user_id order by ts, event_id) as pos from events),
v as (select *, row_number() over (partition by user_id order by pos) as n from w where value > before) select event_id, user_id from v where n = 1""")
def first_disorder(spark, d):
    """The first row of each user that is greater than the one before."""
    return W.order_violation(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "user_id")


@query(f"{L} select listing_id from l where town > 'f' and (sqm is null or days_left % 4 = 0 or number % 5 = 0)")
def detail_wanted(spark, d):
    rows = listings(spark, d).withColumn("deadline", F.expr("case when days_left % 4 <> 0 then deadline end")).withColumn("description", F.expr("case when number % 5 > 0 then 'text' when number % 2 = 0 then ' ' end"))
    return X.needs_detail(rows, F.col("town") > "f").select("listing_id")


@query("""with r as (select event_type as source, ts, event_id, value, row_number() over (partition by event_type order by ts desc, event_id desc) as n from events) select source, round(avg(value), 6) as minutes from r where n <= 4 group by source""")
def usual_minutes(spark, d):
    runs = table(spark, d, "events").select(F.col("event_type").alias("source"), F.struct("ts", "event_id").alias("started"), F.col("value").alias("minutes"))
    return Fresh.expected_minutes(runs).select("source", F.round("minutes", 6).alias("minutes"))


@query("""select user_id as source, arg_max(event_type, event_id) as status, max(event_id) as "at" from events group by user_id""")
def source_status(spark, d):
    return Fresh.load_status(table(spark, d, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("at"), F.col("event_type").alias("status")))


@query(f"{L} select listing_id, coalesce(case when number % 3 = 0 then 'scia' end, 'incerto') as permit, case when number % 3 = 0 then 'analisi' else 'stima_euristica' end as origin, case when number % 3 = 0 then 'alta' else 'bassa' end as confidence from l")
def judged_permits(spark, d):
    rows = listings(spark, d).select("listing_id", "number")
    notes = rows.where("number % 3 = 0").select("listing_id", F.lit("scia").alias("permit"))
    return J.annotated(rows.select("listing_id"), notes, "listing_id", "permit", F.lit("incerto")).select("listing_id", "permit", "origin", "confidence")


@query(f"{L} select listing_id from l where not (number % 4 = 0 and number % 8 <> 0)")
def to_load(spark, d):
    """Keys to load: unseen ones, and seen ones that weren't enriched."""
    rows = listings(spark, d).select("listing_id", "number")
    return J.unseen(rows, rows.where("number % 4 = 0").withColumn("enriched", F.expr("number % 8 <> 0")), "listing_id", F.col("enriched")).select("listing_id")


@query(f"""{L}, w as (select listing_id, price, round(price * (1 + 0.01 * (number % 7 - 3)), 2) as now, days_left, cast(number % 100 as int) as v from l)
select listing_id, case when days_left < 0 then 'scaduta' when days_left < 20 then 'rossa' when days_left <= 35 then 'gialla' else 'verde' end as urgency, 'Voto ' || v || ' → ' || (v + 5) as vote_text,
  'Asta ignota → ' || strftime(date '{RUN_DATE}' + days_left, '%d/%m/%Y') as date_text, replace(format('{{:,}}', cast(floor(price + 0.5) as bigint)), ',', '.') || ' €' as euros from w""")
def reader_texts(spark, d):
    r = listings(spark, d).withColumn("v", F.expr("cast(number % 100 as int)"))
    today = F.lit(RUN_DATE).cast("date")
    return r.select("listing_id", D.urgency(F.col("deadline"), today).alias("urgency"), D.vote_reason(F.col("v"), F.col("v") + 5).alias("vote_text"), D.date_reason(F.lit(None).cast("date"), F.col("deadline")).alias("date_text"), D.euro_text(F.col("price")).alias("euros"))


@query(f"{L} select town, cast(floor(number / 40) as bigint) as page, count(*) as n from l where floor(number / 40) <= 200 group by 1, 2")
def pages_under_cap(spark, d):
    p = listings(spark, d).select("town", F.expr("cast(floor(number / 40) as bigint)").alias("page"))
    return W.capped_pages(p, ["town"], "page", 200)[0].groupBy("town", "page").agg(F.count("*").alias("n"))


@query(f"{L} select town, cast(max(floor(number / 40)) as bigint) as last_page from l group by town having max(floor(number / 40)) >= 200")
def towns_over_cap(spark, d):
    p = listings(spark, d).select("town", F.expr("cast(floor(number / 40) as bigint)").alias("page"))
    return W.capped_pages(p, ["town"], "page", 200)[1]


@query(f"{L} select source, cast(floor(number / 60) as bigint) as page from l group by all having count(*) filter (where contains(town, 'a') and number % 7 = 0) = 0")
def fallback_feeds(spark, d):
    """Pages of a search on which no address names the searched city."""
    p = listings(spark, d).select("source", F.expr("cast(floor(number / 60) as bigint)").alias("page"), F.expr("case when number % 7 = 0 then concat('Via ', upper(town)) end").alias("address"), F.lit("A").alias("city"))
    p = p.withColumn("address", F.when(F.contains(F.lower("address"), F.lit("via ")), F.substring("address", 5, 99)))
    return X.fallback_pages(p, "address", "city", ["source", "page"])


@query(f"""with p as (select s_suppkey as k, 36.0 + (s_suppkey * 17 % 1000) / 100.0 as lat, 7.0 + (s_suppkey * 23 % 1000) / 100.0 as lon, cast(500 + s_suppkey % 7 * 900 as double) as sqm from supplier)
select a.k, count(*) as n, round(sum(b.sqm), 2) as sqm from p a join p b on a.k <> b.k where {km("a.", "b.")} <= 100 group by a.k""")
def competitors_of_competitors(spark, d):
    return J.sums_around(points(spark, d), "k", "sqm", 100.0).select("k", "n", F.round("sum", 2).alias("sqm"))


@query(f"""{L}, x as (select source, case when number % 9 = 0 then ' ' else town end as town, sqm, lot from l)
select source, field, n, filled, filled / n as share from (select source, 'town' as field, count(*) as n, count(*) filter (where trim(town) <> '') as filled from x group by source
  union all select source, 'sqm', count(*), count(sqm) from x group by source union all select source, 'lot', count(*), count(lot) from x group by source)""")
def field_fill(spark, d):
    """Share of known and non-blank values, by source and field."""
    rows = listings(spark, d).withColumn("town", F.expr("case when number % 9 = 0 then ' ' else town end"))
    return A.fill_rates(rows, ["source"], ["town", "sqm", "lot"])


@query(f"""{L} select source, count(*) as n, count(sqm) as with_sqm, count(*) filter (where number % 5 > 0) as with_deadline, count(*) filter (where number % 4 > 0 and number % 7 > 0) as with_place from l group by rollup(source)""")
def data_quality(spark, d):
    """Rows with surface, deadline and coordinates, by source and in total."""
    rows = listings(spark, d).withColumns({"deadline": F.expr("case when number % 5 > 0 then deadline end"), "lat": F.expr("case when number % 4 > 0 then lat end"), "lon": F.expr("case when number % 7 > 0 then lon end")})
    return A.quality_table(rows)


@query(f"""{L}, x as (select source, case when number % 50 = 0 then 'x-' || number when number % 60 < 10 then source || '_' || (number - number % 60) else listing_id end as k from l)
select source, count(*) as n, count(*) filter (where regexp_matches(k, '^[a-z]+_[0-9]+$')) as well_formed, count(*) - count(distinct k) as repeated from x group by source""")
def key_report(spark, d):
    """Keys of the right form and repeated keys, by source."""
    rows = listings(spark, d).select("source", F.expr("case when number % 50 = 0 then concat('x-', number) when number % 60 < 10 then concat(source, '_', number - number % 60) else listing_id end").alias("k"))
    return A.key_audit(rows, "k", "^[a-z]+_[0-9]+$", ["source"])


@query(f"""{L}, c as (select source, year, count(*) as n from l where year % 3 <> 1 or number % 4 = 0 group by all) select source, year, n, coalesce(n < 0.5 * lag(n) over (partition by source order by year), false) as alarm from c""")
def volume_drops(spark, d):
    rows = listings(spark, d).where("year % 3 <> 1 or number % 4 = 0").groupBy("source", "year").agg(F.count("*").alias("n"))
    return A.volume_alarm(rows, "source", "year")


@query("select event_type, count(*) filter (where value > 90) as error, count(*) filter (where value > 70 and value <= 90) as warning from events group by event_type")
def alarm_levels(spark, d):
    level = F.when(F.col("value") > 90, "ERROR").when(F.col("value") > 70, "WARNING").when(F.col("value") > 20, "INFO")
    return A.level_counts(table(spark, d, "events").select("event_type", level.alias("level")), "event_type")


@query(f"""{L}, r as (select case when number % 5 = 0 then listing_id else 'was_' || number end as id, 'r1' as file, '2026-09-02' as date, number, case when number % 5 = 1 then 'alias_' || number end as alias, case when number % 5 = 2 then 'key_' || number end as k from l where number % 5 < 3
  union all select 'new_' || number, 'r2', '2026-09-09', number, listing_id, null from l where number % 10 = 0 union all select listing_id, 'this', '2026-09-16', number, null, null from l)
select listing_id, id, date, file from (select l.listing_id, r.*, row_number() over (partition by l.listing_id order by case when r.id = l.listing_id then 1 when r.k is not null then 3 else 2 end, r.date desc) as n
  from l join r on r.number = l.number and r.file <> 'this' and (r.id = l.listing_id or r.alias is not null or r.k is not null)) where n = 1""")
def history_matches(spark, d):
    """Earlier announcements by id, else by an alias of either side, else by the identity key."""
    rows = listings(spark, d).select("listing_id", "number")
    own = rows.select("listing_id", F.expr("case when number % 5 = 1 then array(concat('alias_', number)) end").alias("alias_ids"), F.expr("case when number % 5 = 2 then concat('key_', number) end").alias("identity_key"))
    first = rows.where("number % 5 < 3").select(
        F.expr("case when number % 5 = 0 then listing_id else concat('was_', number) end").alias("id"), F.lit("2026-09-02").alias("date"), F.lit("r1").alias("file"),
        F.expr("case when number % 5 = 1 then array(concat('alias_', number)) end").alias("alias_ids"), F.expr("case when number % 5 = 2 then concat('key_', number) end").alias("identity_key"),
    )
    none = [F.array().cast("array<string>").alias("alias_ids"), F.lit(None).cast("string").alias("identity_key")]
    second = rows.where("number % 10 = 0").select(F.expr("concat('new_', number)").alias("id"), F.lit("2026-09-09").alias("date"), F.lit("r2").alias("file"), F.array("listing_id").alias("alias_ids"), none[1])
    today = rows.select(F.col("listing_id").alias("id"), F.lit("2026-09-16").alias("date"), F.lit("this").alias("file"), *none)
    return J.matched_history(own, first.union(second).union(today), "this")


@query(f"""{L} select listing_id, concat_ws(',', case when sqm is null then 'sqm' end, case when lot is null then 'lot' end) as missing, (sqm is null)::int + (lot is null)::int as n, replace(format('{{:,.0f}}', cast(number as double)), ',', '.') || ' m²' as area from l""")
def missing_fields(spark, d):
    """Unknown fields with where to find them, and an area as readers see it."""
    from propscan.functions import parse as P

    rows = listings(spark, d)
    missing = D.missing_data({"sqm": F.col("sqm"), "lot": F.col("lot")})
    n = F.lit(2) - P.richness(F.col("sqm"), F.col("lot"))
    return rows.select("listing_id", F.array_join(F.transform(missing, lambda m: m["field"]), ",").alias("missing"), n.alias("n"), D.area_text(F.col("number").cast("double")).alias("area"))


@query("""with f as (select o_orderkey as k, o_custkey as c, o_orderdate as u from orders), b as (select o_custkey as c, min(o_orderdate) as s from orders where o_custkey % 5 > 0 group by 1), g as (select k, (epoch(s) - epoch(u)) / 86400.0 as days from f left join b using (c))
select k, case when days is null then 'new' when days < 7 then 'recent' else 'stale' end as forward, case when days is null then 'new' when abs(days) < 7 then 'recent' else 'stale' end as either from g""")
def freshness_both_ways(spark, d):
    """Weekly status where only an older update counts as stale, and where a gap in either direction does."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("updated_at"))
    base = o.where("c % 5 > 0").groupBy("c").agg(F.min("updated_at").alias("scraped_at"))
    one = Fresh.weekly_status(o, base, "c").select("k", F.col("status").alias("forward"))
    return one.join(Fresh.weekly_status(o, base, "c", mode="abs").select("k", F.col("status").alias("either")), "k")


@query("select event_id, row_number() over (order by ts desc, event_id) as place from events qualify place <= 50")
def recent_events(spark, d):
    """The first page (50 rows) by recency, with places."""
    page = W.recent_first(table(spark, d, "events"), "ts", "event_id").limit(50)
    return page.select("event_id", F.row_number().over(W.Window.orderBy(F.desc("ts"), "event_id")).cast("long").alias("place"))


@query(f"{L} select listing_id, concat_ws(',', case when number % 9 = 0 then 'town' end, case when sqm is null then 'sqm' end, case when number % 8 = 0 then 'price' end) as unknown, town in ('germany', 'france') and number % 9 > 0 as excluded from l")
def undecided_listings(spark, d):
    """Decisive fields that are unknown, and the town filter, which never drops an unknown town."""
    rows = listings(spark, d).withColumns({"town": F.expr("case when number % 9 > 0 then town end"), "price": F.expr("case when number % 8 > 0 then price end")})
    unknown = X.insufficient({"town": F.col("town"), "sqm": F.col("sqm"), "price": F.col("price")})
    out = X.geography(F.lit("MI"), F.col("town"), ["MI"], Config(excluded_towns=("germany", "france")), F.lit(None).cast("double"))
    return rows.select("listing_id", F.array_join(unknown, ",").alias("unknown"), out.isNotNull().alias("excluded"))


@query(f"""{L}, tw as ({TOWNS.format(nation="nation", region="region")}) select listing_id, l.town, tw.province, case number % 3 when 0 then 'alta' else 'media' end as confidence from l join tw on tw.town = l.town where number % 3 < 2""")
def towns_in_titles(spark, d):
    """The town that a title names, by the gazetteer; titles that name none give no row."""
    rows = listings(spark, d).join(towns(spark, d).select("town", "province"), "town")
    title = F.expr("case number % 3 when 0 then concat('Capannone a ', upper(town), ' (', upper(province), ')') when 1 then concat('Magazzino, zona nord, ', initcap(town)) else 'Deposito altrove' end")
    return J.town_of_text(rows.select("listing_id", title.alias("title")), "listing_id", "title", towns(spark, d).select("town", "province"))
