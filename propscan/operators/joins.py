"""Joins on keys, distance and tolerance, all as equi-joins with a residual check."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propscan.functions.parse import haversine_km
from propscan.storage import written


def _width(km: float, strip: Column) -> Column:
    """Width in degrees of the cells of a strip of ``km / 110`` degrees of latitude, by its end near a pole and one degree more."""
    edge = F.greatest(F.abs(strip), F.abs(strip + 1)) * (km / 110.0) + 1
    return F.least(km / (110.0 * F.cos(F.radians(F.least(edge, F.lit(89.5))))), F.lit(180.0))


def radius_join(left: DataFrame, right: DataFrame, km: float, spread: bool = False) -> DataFrame:
    """Pairs within ``km`` (at most 100): both sides need ``lat, lon``; right columns get the prefix ``r_``, and ``km`` is added.

    Points fall into strips ``km`` high, and these into cells; their width follows the latitude, one value for each strip, so that
    a cell is at least ``km`` wide everywhere, and columns of cells go round the meridian of 180 degrees. A left point
    looks in 3 x 3 cells. Rows without coordinates match nothing; latitudes beyond 89 degrees raise. ``spread``: both sides are
    large, so none is sent to all tasks by way of the driver, however small its files make it look.
    """
    if not 0 < km <= 100:
        raise ValueError("km must lie between 0 and 100")
    known = "lat is not null and lon is not null"
    check = lambda d: d.where(known).withColumn("lat", F.when(F.abs("lat") <= 89, F.col("lat")).otherwise(F.raise_error(F.lit("latitude beyond 89 degrees")).cast("double")))
    strip = F.floor(F.col("lat") / (km / 110.0))
    columns = lambda width: F.ceil(F.lit(360.0) / width).cast("long")
    column = lambda lon, width: F.pmod(F.floor((lon + 180) / width).cast("long"), columns(width))
    a = check(left).withColumn("_y", F.explode(F.array(*(strip + i for i in (-1, 0, 1)))))
    width = _width(km, F.col("_y"))
    own = column(F.col("lon"), width)
    around = F.array_distinct(F.array(*(F.pmod(own + i, columns(width)) for i in (-1, 0, 1)), F.when(own == 0, columns(width) - 2).otherwise(own), F.when(own >= columns(width) - 2, F.lit(0).cast("long")).otherwise(own)))
    a = a.withColumn("_x", F.explode(around))
    b = check(right).withColumn("_y", strip)
    b = b.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], "_y", column(F.col("lon"), _width(km, F.col("_y"))).alias("_x"))
    out = a.join(b.hint("merge") if spread else b, ["_y", "_x"]).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")))
    return out.where(F.col("km") <= km).drop("_x", "_y")


def sums_around(points: DataFrame, key: str, value: str, km: float) -> DataFrame:
    """``key, n, sum``: number and sum of ``value`` of all other keys' points within ``km``; keys without any are left out.

    ``points``: ``key, lat, lon`` and a known ``value``. Points of a place are added up before places are joined, and what is a key's own
    is taken off, so work follows the points and the pairs of places, not the pairs of points. Whole values are summed exactly.
    """
    rows = points.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col(value).alias("_v"))
    own = rows.where("lat is not null and lon is not null").groupBy("_key", "lat", "lon").agg(F.count("*").alias("_n"), F.sum("_v").alias("_sum"))
    places = own.groupBy("lat", "lon").agg(F.sum("_n").alias("n"), F.sum("_sum").alias("sum"))
    around = radius_join(places.select("lat", "lon"), places, km, spread=True).groupBy("lat", "lon").agg(F.sum("r_n").alias("n"), F.sum("r_sum").alias("sum"))
    other = own.select("_key", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("_n").alias("_m"), F.col("_sum").alias("_own"))
    near = haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")) <= km
    same = own.join(other.hint("merge"), "_key").where(near).groupBy("_key", "lat", "lon", "_n").agg(F.sum("_m").alias("_m"), F.sum("_own").alias("_own"))
    both = same.join(around.hint("merge"), ["lat", "lon"]).groupBy("_key").agg(F.sum(F.col("_n") * (F.col("n") - F.col("_m"))).alias("n"), F.sum(F.col("_n") * (F.col("sum") - F.col("_own"))).alias("sum"))
    return both.where("n > 0").select(F.col("_key").alias(key), "n", "sum")


def with_town(rows: DataFrame, towns: DataFrame) -> DataFrame:
    """Left join on the town's name, trimmed and in lower case: ``province, town_index, inhabitants`` and the province's mean index.

    ``towns``: ``town, province, town_index, inhabitants``, one row a town; a town named twice has its first row by province.
    """
    name = F.lower(F.trim("town"))
    once = towns.groupBy(name.alias("_town")).agg(F.min_by(F.struct("province", "town_index", "inhabitants"), F.struct("province", "town_index")).alias("t")).select("_town", "t.*")
    mean = once.groupBy("province").agg(F.avg("town_index").alias("province_index"))
    index = once.join(mean, "province", "left")
    kept = [c for c in rows.columns if c not in ("province", "town_index", "inhabitants", "province_index")]
    return rows.select(*kept).join(index, F.lower(F.trim("town")) == F.col("_town"), "left").drop("_town")


def _plain(text: Column) -> Column:
    """Lower-cased words and numbers with single blanks: ``reggio nell emilia``."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def town_of_text(rows: DataFrame, key: str, text: str, towns: DataFrame, max_words: int = 5) -> DataFrame:
    """``key, town, province, confidence`` of the rows whose text names a town of the gazetteer ``towns`` (``town, province``).

    Runs of up to ``max_words`` words are joined with the names, by equality of their words. A name within a longer
    one that was found there doesn't count. Of several, a town whose province code follows in brackets comes first
    (``alta``), then the one with more words, then the last, as texts say zone before town; a single one is ``media``,
    one among others ``bassa``. Rows without a known name give none; of towns of one name the first by province is taken
    unless the code tells. Null texts and names match nothing.
    """
    words = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.upper(text).alias("_text"), F.split(_plain(F.col(text)), " ").alias("_words"))
    at = F.explode(F.expr("sequence(1, size(_words))")).alias("_at")
    runs = words.select("_key", "_text", "_words", at).select("_key", "_text", "_at", F.explode(F.expr(f"sequence(1, least({int(max_words)}, size(_words) - _at + 1))")).alias("_n"), "_words")
    runs = runs.select("_key", "_text", "_at", "_n", F.array_join(F.expr("slice(_words, _at, _n)"), " ").alias("_name"))
    names = towns.where("town is not null").select(_plain(F.col("town")).alias("_name"), "town", "province").where("_name <> ''").distinct()
    coded = F.coalesce(F.contains("_text", F.concat(F.lit("("), F.upper("province"), F.lit(")"))), F.lit(False))
    found = runs.join(names, "_name").withColumn("_coded", coded)
    spans = F.collect_set(F.struct("_at", "_n"))  # of one text
    found = found.join(found.groupBy("_key").agg(spans.alias("_spans")), "_key")
    outer = F.exists("_spans", lambda s: (s["_at"] <= F.col("_at")) & (s["_at"] + s["_n"] >= F.col("_at") + F.col("_n")) & (s["_n"] > F.col("_n")))
    found = found.where(~outer)
    best = found.groupBy("_key", "_coded", "_n", "_at").agg(F.min(F.struct("province", "town")).alias("t"), F.first("_name").alias("_name"))
    best = best.groupBy("_key").agg(F.max_by(F.struct("t.town", "t.province", "_coded"), F.struct(F.col("_coded").cast("int"), "_n", "_at")).alias("b"), F.count_distinct("_name").alias("_names"))
    confidence = F.when(F.col("b._coded"), "alta").when(F.col("_names") == 1, "media").otherwise("bassa")
    return best.select(F.col("_key").alias(key), "b.town", "b.province", confidence.alias("confidence"))


def with_perimeter(listings: DataFrame, targets: DataFrame, excluded: list[str], km: float = 30.0) -> DataFrame:
    """Add ``distance_km`` to the nearest of the ``targets`` (``town, lat, lon``) and ``inside``, which may be unknown.

    ``distance_km``: 0 in a target town, infinite for a known place with no target within ``km``, null where neither tells.
    ``inside``: false in an excluded town (lower-cased names), true in a target town or within ``km`` of one, false beyond, null where the
    distance is unknown, which drops nothing. Targets named twice count once; targets without coordinates count by name only.
    """
    name = lambda c: F.lower(F.trim(c))
    names = targets.where("town is not null").select(name("town").alias("_target")).distinct()
    near = radius_join(targets.select("lat", "lon"), listings.select("listing_id", "lat", "lon"), km)  # the few look around
    near = near.groupBy(F.col("r_listing_id").alias("listing_id")).agg(F.min("km").alias("_km"))
    rows = listings.drop("distance_km", "inside").join(near, "listing_id", "left").join(names, name("town") == F.col("_target"), "left")
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rows = rows.withColumn("distance_km", F.when(F.col("_target").isNotNull(), 0.0).when(placed, F.coalesce("_km", F.lit(float("inf")))))
    inside = F.when(F.coalesce(name("town").isin(*excluded), F.lit(False)), False).otherwise(F.col("distance_km") <= km)
    return rows.withColumn("inside", inside).drop("_km", "_target")


def surrounded(listings: DataFrame, points: DataFrame, competitors_km: float = 5.0, poles_km: float = 2.0) -> DataFrame:
    """Add ``competitor_sqm``, ``junction_km`` and ``retail_poles`` by ``points``: ``k, lat, lon, sqm``; even ``k`` are junctions too,
    multiples of three are retail poles. Listings without coordinates have nulls, those with nothing around have 0 m² and poles."""
    near = radius_join(points.select("k", "lat", "lon", "sqm"), listings.select("listing_id", "lat", "lon"), competitors_km)  # the few look around
    sums = near.groupBy(F.col("r_listing_id").alias("listing_id")).agg(
        F.sum("sqm").alias("_sqm"), F.min(F.when(F.col("k") % 2 == 0, F.col("km"))).alias("junction_km"), F.count_if((F.col("k") % 3 == 0) & (F.col("km") <= poles_km)).cast("int").alias("_poles")
    )
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    out = listings.join(sums, "listing_id", "left")
    return out.withColumns({"competitor_sqm": F.when(placed, F.coalesce("_sqm", F.lit(0.0))), "retail_poles": F.when(placed, F.coalesce("_poles", F.lit(0)))}).drop("_sqm", "_poles")


def reference_table(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """A reference CSV with a header line (towns, competitors, sites, retail poles), and ``line`` of the lines that don't fit the schema."""
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": False, "columnNameOfCorruptRecord": "_line"}
    rows = written(spark.read.schema(f"{schema}, _line string").options(**options).csv(path), "reference")
    return rows.where("_line is null").drop("_line"), rows.where("_line is not null").select(F.col("_line").alias("line"))


def with_snapshot(matches: DataFrame, items: DataFrame) -> DataFrame:
    """The announced snapshot of each match: ``matches`` has ``listing_id, id, date, file``; ``items`` is the table of report elements
    with ``file, id`` and what was announced. Where the element is missing, ``note`` says that no comparison is possible."""
    columns = [c for c in items.columns if c not in ("file", "id")]
    found = items.select("file", "id", F.struct(*columns).alias("snapshot"))
    out = matches.join(found, ["file", "id"], "left")
    text = F.concat(F.lit("segnalata il "), F.col("date").cast("string"), F.lit(" ma il file storico "), "file", F.lit(" è illeggibile: confronto impossibile"))
    return out.select("listing_id", "id", "date", "file", "snapshot", F.when(F.col("snapshot").isNull(), text).alias("note"))


def longer_text(rows: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` with the longer of its text and that of ``other`` with the same key (its longest, where it has several)."""
    best = other.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(column, F.struct(F.length(column), column)).alias("_other"))
    out = rows.join(best, key, "left")
    use = F.col("_other").isNotNull() & (F.length("_other") > F.coalesce(F.length(column), F.lit(0)))
    return out.withColumn(column, F.when(use, F.col("_other")).otherwise(F.col(column))).drop("_other")


def repeated(df: DataFrame, key: str) -> bool:
    """Whether a key has several rows."""
    return not df.groupBy(key).count().where("count > 1").isEmpty()


def tolerance_pairs(df: DataFrame, key: str, keys: list[str], tolerances: dict[str, float], differ: str | None = None, unless: tuple[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """Pairs ``a < b`` of ``key`` that are equal in ``keys``, differ by at most a share of the larger in each column of
    ``tolerances``, and are unequal in ``differ``; nulls match nothing. ``unless``: a column and a test of its two values that drops a pair.

    Each tolerance makes log-wide buckets of twice its width, and a row is looked for in the two buckets that it is near to, so only
    rows near in every tolerance meet. Pairs aren't moved after the join, unless keys repeat: then each pair is given once.
    """
    names = list(tolerances)
    own = unless[0] if unless else None
    rows = df.select(key, *keys, *names, *([differ] if differ else []), *([own] if own else []))
    for t in names:
        rows = rows.where(F.col(t) > 0)
    reach = {t: -math.log(1 - p) * (1 + 1e-9) for t, p in tolerances.items()}
    bucket = lambda t, by=0: F.floor((F.log(F.col(t).cast("double")) + by * reach[t]) / (2 * reach[t]))
    a = rows.withColumns({f"_b{i}": bucket(t) for i, t in enumerate(names)})
    b = rows
    for i, t in enumerate(names):
        b = b.withColumn(f"_b{i}", F.explode(F.array_distinct(F.array(bucket(t, -1), bucket(t, 1)))))
    b = b.withColumnsRenamed({key: "b", **{t: f"r_{t}" for t in names}, **({differ: "_other"} if differ else {}), **({own: "_unless"} if own else {})})
    out = a.join(b.hint("merge"), [*keys, *(f"_b{i}" for i in range(len(names)))]).where(F.col(key) < F.col("b"))  # none of two equal sides goes by way of the driver
    if differ:
        out = out.where(F.col(differ) != F.col("_other"))
    for t, share in tolerances.items():
        out = out.where(F.abs(F.col(t) - F.col(f"r_{t}")) <= share * F.greatest(F.col(t), F.col(f"r_{t}")))
    if unless:
        out = out.where(~unless[1](F.col(own), F.col("_unless")))
    out = out.select(F.col(key).alias("a"), "b")
    return out.distinct() if repeated(rows, key) else out


def tolerance_links(df: DataFrame, key: str, keys: list[str], tolerances: dict[str, float], sides: tuple[str, object, object] | None = None) -> DataFrame:
    """Links ``(a, b)`` with the components of ``tolerance_pairs``, in numbers that follow the rows (loops and repeats aside).

    ``sides``: a column and two of its values; then pairs have one row of each. Cells are as wide as the tolerances, so
    all rows of a cell are pairs: each is linked to the cell's smallest row, or to that of the other side. In the cells
    around, rows look at the least and greatest value only (of one tolerance), or at those of the second for each
    value of the first (of two): who is near some row there is near one of these, and they are near each other's.
    Without sides one link for two cells is kept. Nulls and values that aren't positive match nothing.
    """
    names = list(tolerances)
    if len(names) > 2:
        raise ValueError("one or two tolerances")
    side = F.lit(0) if sides is None else F.when(F.col(sides[0]) == F.lit(sides[1]), 0).when(F.col(sides[0]) == F.lit(sides[2]), 1)
    value = [F.col(t).cast("double").alias(f"_v{i}") for i, t in enumerate(names)]
    rows = df.select(F.col(key).alias("a"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *value, side.alias("_side"))
    rows = rows.where(" and ".join(["_side is not null", *(f"_k{i} is not null" for i in range(len(keys))), *(f"_v{i} > 0" for i in range(len(names)))]))
    cell = [F.floor(F.log(f"_v{i}") / -math.log(1 - p)).alias(f"_c{i}") for i, p in enumerate(tolerances.values())]
    rows = rows.select("*", *cell)
    where, cells = [f"_k{i}" for i in range(len(keys))], [f"_c{i}" for i in range(len(names))]
    heads = rows.groupBy(*where, *cells, "_side").agg(F.min("a").alias("b"))
    other = F.col("_side") if sides is None else 1 - F.col("_side")
    within = rows.withColumn("_side", other).join(heads, [*where, *cells, "_side"]).select("a", "b")
    values = [f"_v{i}" for i in range(len(names))]
    ends = F.struct(values[-1], F.col("a").alias("b"))
    stairs = rows.groupBy(*where, *cells, "_side", *values[:-1]).agg(F.array_distinct(F.array(F.min(ends), F.max(ends))).alias("e")).select(*where, *cells, "_side", *values[:-1], F.explode("e").alias("e"))
    stairs = stairs.select(*where, *cells, "_side", *[F.col(v).alias(f"_w{i}") for i, v in enumerate(values[:-1])], F.col(f"e.{values[-1]}").alias(f"_w{len(names) - 1}"), "e.b")
    look = rows if sides is not None else stairs.select(*where, *cells, "_side", *[F.col(f"_w{i}").alias(v) for i, v in enumerate(values)], F.col("b").alias("a"))
    steps = [s for s in itertools.product((-1, 0, 1), repeat=len(names)) if any(s) and (sides is not None or s > (0,) * len(names))]
    look = look.withColumn("_side", other).withColumnsRenamed({c: f"_own{c}" for c in cells})
    look = look.withColumn("_at", F.explode(F.array(*(F.struct(*((F.col(f"_own_c{i}") + d).alias(f"_c{i}") for i, d in enumerate(s))) for s in steps)))).select("*", "_at.*")
    near = look.join(stairs, [*where, *cells, "_side"])
    for i, share in enumerate(tolerances.values()):
        near = near.where(F.abs(F.col(f"_v{i}") - F.col(f"_w{i}")) <= share * F.greatest(f"_v{i}", f"_w{i}"))
    if sides is None:
        near = near.groupBy(*where, *cells, *(f"_own{c}" for c in cells)).agg(F.min(F.struct("a", "b")).alias("e")).select("e.*")
    return within.union(near.select("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")


def differing_links(df: DataFrame, key: str, keys: list[str], tolerances: dict[str, float], differ: str) -> DataFrame:
    """Links ``(a, b)`` with the components of ``tolerance_pairs`` of rows unequal in ``differ``, whatever values it has.

    Cells and stairs are those of ``tolerance_links``, of two values of ``differ`` each, so every row finds one unlike its own.
    A cell of several values holds together: its rows are linked to its smallest row or to the smallest unlike that, its stairs
    look around for it, and one link to another such cell is kept. In a cell of one value each row looks around itself.
    """
    names = list(tolerances)
    where, cells, values = [f"_k{i}" for i in range(len(keys))], [f"_c{i}" for i in range(len(names))], [f"_v{i}" for i in range(len(names))]
    rows = df.select(F.col(key).alias("a"), *[F.col(k).alias(c) for k, c in zip(keys, where)], *[F.col(t).cast("double").alias(v) for t, v in zip(names, values)], F.col(differ).alias("_side"))
    rows = rows.where(" and ".join(["a is not null and _side is not null", *(f"{c} is not null" for c in where), *(f"{v} > 0" for v in values)]))
    rows = rows.select("*", *[F.floor(F.log(v) / -math.log(1 - p)).alias(c) for v, c, p in zip(values, cells, tolerances.values())])
    at = [*where, *cells]
    first = lambda by, order: F.row_number().over(Window.partitionBy(*by).orderBy(order)) <= 2
    heads = rows.groupBy(*at, "_side").agg(F.min("a").alias("b"))
    mixed = heads.groupBy(*at).agg((F.min("_side") != F.max("_side")).alias("_mixed"))
    heads = heads.withColumn("_first", first(at, F.col("b"))).where("_first").select(*at, F.col("_side").alias("_other"), "b")
    within = rows.join(heads, at).where("_side <> _other").select("a", "b")
    ends, step = F.struct(values[-1], F.col("a").alias("b")), [*at, *values[:-1]]
    stairs = rows.groupBy(*step, "_side").agg(F.min(ends).alias("_least"), F.max(ends).alias("_most"))
    stairs = stairs.withColumns({"_low": first(step, F.col("_least")), "_high": first(step, F.desc("_most"))}).where("_low or _high")
    stairs = stairs.withColumn("e", F.explode(F.array_distinct(F.array(F.when(F.col("_low"), F.col("_least")).otherwise(F.col("_most")), F.when(F.col("_high"), F.col("_most")).otherwise(F.col("_least"))))))
    stairs = stairs.select(*step, F.col(f"e.{values[-1]}").alias(values[-1]), "e.b", "_side").join(mixed, at)
    look = rows.join(mixed, at).where("not _mixed").select(*at, *values, "a", "_side", "_mixed").union(stairs.where("_mixed").select(*at, *values, "b", "_side", "_mixed"))
    look = look.withColumnsRenamed({c: f"_own{c}" for c in (*cells, *values, "_side", "_mixed")})
    around = [s for s in itertools.product((-1, 0, 1), repeat=len(names)) if any(s)]
    look = look.withColumn("_at", F.explode(F.array(*(F.struct(*((F.col(f"_own{c}") + d).alias(c) for c, d in zip(cells, s))) for s in around)))).select("*", "_at.*")
    near = look.join(stairs, at).where("_own_side <> _side")
    for v, share in zip(values, tolerances.values()):
        near = near.where(F.abs(F.col(f"_own{v}") - F.col(v)) <= share * F.greatest(f"_own{v}", v))
    alone = F.when(~(F.col("_own_mixed") & F.col("_mixed")), F.struct("a", "b")).alias("_alone")
    near = near.groupBy(*at, *(f"_own{c}" for c in cells), alone).agg(F.min(F.struct("a", "b")).alias("e")).select("e.*")
    return within.union(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The latest record of each key by ``order``; of equal ones the new."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    latest = Window.partitionBy(key).orderBy(F.desc_nulls_last(order), F.desc("_new"))
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n", "_new")


def unseen(rows: DataFrame, seen: DataFrame, key: str, only: Column | None = None) -> DataFrame:
    """Rows whose key isn't in ``seen`` (restricted to ``only``, such as enriched rows)."""
    return rows.join((seen if only is None else seen.where(only)).select(key), key, "left_anti")


def diff(now: DataFrame, before: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, change`` (new, gone, changed, same) of two snapshots."""
    a, b = now.select(key, F.struct(*columns).alias("_a")), before.select(key, F.struct(*columns).alias("_b"))
    state = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "gone").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, state.alias("change"))


def as_of(rows: DataFrame, log: DataFrame, key: str, at: str, log_at: str, values: list[str]) -> DataFrame:
    """Latest ``log`` values strictly before each row's time: one union and one window, no range join."""
    a = rows.withColumns({"_at": F.col(at), "_side": F.lit(0), **{f"_{v}": F.lit(None) for v in values}})
    b = log.select(F.col(key), F.col(log_at).alias("_at"), F.lit(1).alias("_side"), *[F.col(v).alias(f"_{v}") for v in values], F.lit(True).alias("_has"))
    both = a.withColumn("_has", F.lit(None).cast("boolean")).unionByName(b, allowMissingColumns=True)
    past = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, -1)
    held = F.last(F.when(F.col("_has"), F.struct(*[F.col(f"_{v}").alias(v) for v in values])), ignorenulls=True).over(past)
    out = both.withColumn("_last", held).where("_side = 0")
    return out.select(*rows.columns, *[F.col("_last")[v].alias(f"last_{v}") for v in values])


def imputed(rows: DataFrame, index: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """Left join with ``index``; where a key has no value its group's mean is used, with low confidence.

    Means are sums by group and a join, so a group of any size is no task's work."""
    joined = rows.join(index.select(key, value), key, "left")
    means = joined.groupBy(F.col(group).alias("_group")).agg(F.avg(value).cast("double").alias("_mean"))
    joined = joined.join(means, F.col(group).eqNullSafe(F.col("_group")), "left")
    joined = joined.withColumn("imputed", F.coalesce(F.col(value).cast("double"), F.col("_mean"))).drop("_group", "_mean")
    return joined.withColumn("confidence", F.when(F.col(value).isNotNull(), "alta").when(F.col("imputed").isNotNull(), "bassa"))


def matched_history(listings: DataFrame, registry: DataFrame, this_file: str) -> DataFrame:
    """Newest earlier announcement of each listing: by id, then by alias, then by identity key.

    ``listings``: ``listing_id, alias_ids, identity_key``; ``registry``: ``id, date, file, alias_ids, identity_key``.
    """
    past = registry.where(F.col("file") != this_file)
    names = past.select("id", "date", "file", F.explode(F.array_distinct(F.concat(F.array("id"), F.coalesce("alias_ids", F.array().cast("array<string>"))))).alias("name"))
    own = listings.select("listing_id", F.explode(F.array_distinct(F.concat(F.array("listing_id"), F.coalesce("alias_ids", F.array().cast("array<string>"))))).alias("name"))
    by_name = own.join(names, "name").withColumn("priority", F.when(F.col("listing_id") == F.col("id"), 1).otherwise(2))
    by_key = listings.where("identity_key is not null").join(past.select("id", "date", "file", "identity_key"), "identity_key").withColumn("priority", F.lit(3))
    cols = ["listing_id", "id", "date", "file", "priority"]
    newest = F.max_by(F.struct("id", "date", "file"), F.struct(-F.col("priority"), "date", "file", "id"))
    return by_name.select(*cols).union(by_key.select(*cols)).groupBy("listing_id").agg(newest.alias("m")).select("listing_id", "m.id", "m.date", "m.file")


def annotated(rows: DataFrame, notes: DataFrame, key: str, column: str, fallback: Column) -> DataFrame:
    """A judgement by key where there is one, else the rule's value with low confidence."""
    out = rows.join(notes.select(key, F.col(column).alias("_note")), key, "left")
    return out.withColumns({column: F.coalesce("_note", fallback), "origin": F.when(F.col("_note").isNotNull(), "analisi").otherwise("stima_euristica"), "confidence": F.when(F.col("_note").isNotNull(), "alta").otherwise("bassa")}).drop("_note")
