"""DuckDB SQL of the evaluation, criterion by criterion, written from the scorecard's tables and not from the plan's code."""

from __future__ import annotations

from propscan.plans.demo import FACTS, LISTING_DUCK, POINTS, TOWNS

L = f"with l as ({LISTING_DUCK})"

_KM = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"


def km(a: str, b: str) -> str:
    """Great-circle distance between the points ``a`` and ``b`` (prefixes with a dot)."""
    return _KM.format(a=a, b=b)


#: CTE ``f``: listings with their facts, their town and what lies around them.
FACTS_SQL = f"""with l0 as ({LISTING_DUCK}), lf as (select l0.*, {", ".join(f"{e} as {n}" for n, e in FACTS.items())} from l0),
tw as ({TOWNS.format(nation="nation", region="region")}), pm as (select province, avg(town_index) as province_index from tw group by province), pt as ({POINTS.format(supplier="supplier")}),
nr as (select listing_id, pt.k, pt.sqm as psqm, {km("l0.", "pt.")} as km from l0 join pt on abs(l0.lat - pt.lat) < 0.06),
ar as (select listing_id, sum(psqm) as csqm, min(case when k % 2 = 0 then km end) as junction_km, cast(count(*) filter (where k % 3 = 0 and km <= 2) as int) as poles from nr where km <= 5 group by listing_id),
f as (select lf.*, tw.province, tw.town_index, tw.inhabitants, pm.province_index, coalesce(csqm, 0.0) as competitor_sqm, junction_km, coalesce(poles, 0) as retail_poles
  from lf left join tw on tw.town = lf.town left join pm on pm.province = tw.province left join ar on ar.listing_id = lf.listing_id)"""


def _points(flags: dict[str, float], top: float) -> tuple[str, str]:
    """Least and most points of flags: an unknown flag counts in the most only."""
    lo = " + ".join(f"case when coalesce({c}, false) then {p} else 0.0 end" for c, p in flags.items())
    hi = " + ".join(f"case when coalesce({c}, true) then {p} else 0.0 end" for c, p in flags.items())
    return f"least({lo}, {top})", f"least({hi}, {top})"


_ACCESS = _points({"yard": 3.0, "entrance": 3.0, "(docks >= 1)": 2.0, "gates": 1.0}, 9.0)
_EXPANSION = _points({"adjacent": 2.0, "second_bay": 2.0, "phased": 1.0}, 5.0)
_DEAL = _points({"(not auction)": 1.0, "free": 2.0, "(failed >= 1)": 1.0, "custodian": 1.0}, 5.0)
CRITERIA = ["index", "saturation", "visibility", "basin", "height", "plan", "access", "structure", "permit", "expansion", "transaction"]
_SUM = {part: " + ".join(f"{c}_{part}" for c in CRITERIA) for part in ("lo", "mid", "hi")}
_D = "cast({} as double)"

#: CTE ``o``: the whole evaluation of each listing.
EVAL_SQL = f"""{FACTS_SQL},
a as (select *, coalesce(town_index, province_index) as ix, competitor_sqm / nullif(inhabitants, 0) as sat,
  (least(1.0, case when regexp_matches(lower(address), 'statale|provinciale|tangenziale|autostrad') then 0.8 when regexp_matches(lower(address), 'viale|corso|via nazionale') then 0.6 else 0.4 end
    + case when junction_km <= 1 then 0.2 when junction_km <= 5 then 0.1 else 0.0 end)) * 12.0 as vis,
  least(6.0, retail_poles * 2.0 + 2.0) as bas, case when category in ('capannone', 'opificio', 'stabilimento') then 4 else 0 end as hlo, case when category in ('magazzino', 'laboratorio') then 8 else 13 end as hhi,
  case when height < 3 then 0 when height < 4.5 then 4 when height < 5.5 then 8 when height >= 5.5 then 13 end as hx,
  case when floor = 0 then 6.0 when floor is not null then 1.0 end as plv, case when office_share > 0 and office_share <= 0.20 then 3.0 when office_share is not null then 1.0 end as pof,
  case when bays >= 2 then 2.0 when bays is not null then 1.0 end as pba, case when year_built >= 2008 then 3.0 when year_built is not null then 1.0 end as st,
  case permit when 'libero' then 12 when 'scia' then 10 when 'pdc' then 7 when 'variante' then 5 when 'incerto' then 2 end as pe,
  case when height >= 5.5 then 0.8 when height >= 4.5 then 0.5 else 0.0 end as mz, cast(sqm as double) as g, cast(price as double) as p from f),
s as (select *,
  case when ix is null then 0.0 else ix / 100 * 12 end as index_lo, case when ix is null then 6.0 else ix / 100 * 12 end as index_mid, case when ix is null then 12.0 else ix / 100 * 12 end as index_hi,
  case when sat is null then 0.0 else greatest(0.0, 10 * (1 - sat / 0.05)) end as saturation_lo, case when sat is null then 5.0 else greatest(0.0, 10 * (1 - sat / 0.05)) end as saturation_mid, case when sat is null then 10.0 else greatest(0.0, 10 * (1 - sat / 0.05)) end as saturation_hi,
  greatest(0.0, vis - 3.0) as visibility_lo, vis as visibility_mid, least(12.0, vis + 3.0) as visibility_hi,
  case when barrier is null or barrier then bas * 2 / 3 else bas end as basin_lo, case when barrier is null then (bas * 2 / 3 + bas) / 2 when barrier then bas * 2 / 3 else bas end as basin_mid, case when barrier then bas * 2 / 3 else bas end as basin_hi,
  coalesce(hx, hlo) as height_lo, coalesce(hx, (hlo + hhi) / 2.0) as height_mid, coalesce(hx, hhi) as height_hi,
  coalesce(plv, 1.0) + coalesce(pof, 1.0) + coalesce(pba, 1.0) as plan_lo, least(11.0, coalesce(plv, 6.0) + coalesce(pof, 3.0) + coalesce(pba, 2.0)) as plan_hi, (plan_lo + plan_hi) / 2 as plan_mid,
  {_ACCESS[0]} as access_lo, {_ACCESS[1]} as access_hi, (access_lo + access_hi) / 2 as access_mid,
  coalesce(st, 1.0) + case when coalesce(certified, false) then 2.0 else 0.0 end as structure_lo, coalesce(st, 3.0) + case when coalesce(certified, true) then 2.0 else 0.0 end as structure_hi, (structure_lo + structure_hi) / 2 as structure_mid,
  coalesce(pe, 2) as permit_lo, coalesce(pe, 7) as permit_mid, coalesce(pe, 12) as permit_hi,
  {_EXPANSION[0]} as expansion_lo, {_EXPANSION[1]} as expansion_hi, (expansion_lo + expansion_hi) / 2 as expansion_mid,
  {_DEAL[0]} as transaction_lo, {_DEAL[1]} as transaction_hi, (transaction_lo + transaction_hi) / 2 as transaction_mid from a),
d as (select * exclude ({", ".join(f"{c}_{x}" for c in CRITERIA for x in ("lo", "mid", "hi"))}), {", ".join(f"cast({c}_{x} as double) as {c}_{x}" for c in CRITERIA for x in ("lo", "mid", "hi"))} from s),
q as (select *, {_SUM["lo"]} as q_lo, {_SUM["mid"]} as q_mid, {_SUM["hi"]} as q_hi, g * 0.68 * (1 + mz) as net,
  g * 525.0 + g * 0.68 * mz * 185.0 + case when year_built < 2008 then g * 140.0 else 0.0 end + case when strip_out then g * 55.0 else 0.0 end + case when asbestos then g * 47.5 else 0.0 end as works from d),
y as (select *, p * 1.06 + works + coalesce(regularising, 0.0) as cost, min_offer * 1.06 + works + coalesce(regularising, 0.0) as offer_cost, case when q_mid >= 75 then 0.09 when q_mid >= 60 then 0.11 else 0.14 end as hurdle from q),
z as (select *, net * 261.0 * 0.82 * 0.58 / nullif(cost, 0) as yoc, net * 380.0 * 0.82 * 0.58 / nullif(cost, 0) as yoc_best, net * 261.0 * 0.82 * 0.58 / nullif(offer_cost, 0) as yoc_offer,
  case when town in ('roma', 'cagliari', 'ancona') then 'PERIMETRO_GEOGRAFICO' end as r1,
  case when category not in ('capannone', 'magazzino', 'opificio', 'laboratorio', 'stabilimento') and (category = 'garage' or not regexp_matches(lower(title), 'capannone|magazzino|deposito')) then 'TIPOLOGIA' end as r2,
  case when g < 950 and g between 5 and 100000 then 'SUPERFICIE' end as r3, case when days_left < 0 then 'ASTA_SCADUTA' when days_left < 20 then 'TEMPO_INSUFFICIENTE' end as r4,
  case when regexp_matches(lower(title), 'quota (di|pari a)? ?[0-9]+/[0-9]+|nuda propriet|diritto di superficie in scadenza') then 'DIRITTO' end as r5,
  case when regexp_matches(lower(title), 'insanabil|vincolo di inedificabilit') then 'VINCOLO' end as r6, case when p / nullif(net, 0) > 2500 then 'PREZZO_MQ' end as r7 from y),
v as (select *, coalesce(r1, r2, r3, r4, r5, r6, r7) as reason, concat_ws(',', r1, r2, r3, r4, r5, r6, r7) as all_reasons,
  concat_ws(',', case when g < 1000 and g >= 950 then 'AL_LIMITE_SOGLIA' end, case when g > 3000 then 'FUORI_TAGLIA_GRANDE' end, case when p < 10000 then 'PREZZO_ANOMALO' end, case when days_left between 20 and 35 then 'URGENTE' end) as flags,
  cast(least(greatest(round(0.70 * q_mid + 0.30 * coalesce(least(greatest(50 + 1000 * (yoc - hurdle), 0), 100), 50) - 0.20 * (q_hi - q_lo) - coalesce(case when g > 3000 then least(15, 5 * ceil((g - 3000) / 1000)) end, 0)), 0), 100) as int) as vote from z),
o as (select *, case when reason is not null and reason not in ('ASTA_SCADUTA', 'TEMPO_INSUFFICIENTE') then 'SCARTA' when reason is not null then 'MONITORA' when q_hi < 45 then 'SCARTA'
   when sqm is null or q_hi - q_lo > 15 or yoc is null or q_lo < 45 then 'DA APPROFONDIRE' when yoc_best < hurdle then 'SCARTA' when yoc < hurdle then 'MONITORA' else 'PROMUOVI' end as outcome from v)"""
