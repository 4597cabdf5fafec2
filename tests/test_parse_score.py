import datetime as dt
from decimal import Decimal as D

import pytest
from propscan.config import Config
from propscan.functions import parse as P
from propscan.functions import score as S
from propscan.operators import filters as X
from propscan.operators import joins as J
from propscan.operators import windows as W
from propscan.sources import pages, snapshots
from pyspark.sql import functions as F


def one(spark, expr, **values):
    kinds = {str: "string", int: "long", float: "double", dt.date: "date", type(None): "string"}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize(("text", "source", "want"), [("176.000,00", "x", 176000), ("31800.00", "asteflorio", 31800), ("€ 125.250", "caseasta", 125250), ("6.000.000€", "idealista", 6000000), ("€ 20.800,00", "x", 20800), ("895.000", "medianord", 895000), ("prezzo su richiesta", "x", None), (None, "x", None)])
def test_price(spark, text, source, want):
    assert one(spark, P.price(F.col("t"), F.col("s")), t=text, s=source) == (None if want is None else D(want))


@pytest.mark.parametrize(("text", "want"), [("15/09/2026 - 15:30", (15, 15, 30)), ("17/09/2026 h 12:00", (17, 12, 0)), ("22/09/2026, 15:30", (22, 15, 30)), ("2026-09-20T10:00:00", (20, 10, 0)), ("domani", None)])
def test_time(spark, text, want):
    assert one(spark, P.timestamp(F.col("t")), t=text) == (want and dt.datetime(2026, 9, *want))


@pytest.mark.parametrize(("text", "want"), [("oggi", 0), ("ieri", 1), ("2 settimane fa", 14), ("più di 3 mesi fa", 90), ("un anno fa", 365), ("3 ore fa", None)])
def test_relative(spark, text, want):
    assert one(spark, P.relative_days(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("1.250 mq", 1250), ("mq 1250", 1250), ("1250MQ", 1250), ("m² 1.250", 1250), ("233,5 m²", 233.5), ("nulla", None)])
def test_surface(spark, text, want):
    got = one(spark, P.surface(F.col("t"))["value"], t=text)
    assert got == (None if want is None else D(str(want)))


def test_places_and_names(spark):
    assert one(spark, P.town(F.col("t")), t="Toscana > Pisa > San Giuliano Terme") == "San Giuliano Terme"
    assert one(spark, P.province(F.col("t")), t="Gorle (BG) - Via Roma") == "BG" and one(spark, P.town(F.col("t")), t="Gorle (BG) - Via Roma") == "Gorle"
    assert one(spark, P.height(F.col("t")), t="7,1 m") == D("7.10") and one(spark, P.height(F.col("t")), t="650 m") is None
    assert one(spark, P.slug(F.col("t")), t="Forlì — Cesena!") == "forli-cesena" and one(spark, P.procedure(F.col("t")), t="Procedura n.42/2025") == "42/2025"
    assert one(spark, P.italian_amount(F.col("t"), 0), t=144000.0) == "144.000" and one(spark, P.report_name(F.col("t")), t=dt.date(2026, 9, 16)) == "report_2026_09_16.json"


@pytest.mark.parametrize(("sqm", "reason", "flag"), [(1200.0, None, None), (733.0, "SUPERFICIE", None), (970.0, None, "AL_LIMITE_SOGLIA"), (10500.0, None, "FUORI_TAGLIA_GRANDE")])
def test_surface_band(spark, sqm, reason, flag):
    c, today = Config(), F.lit(dt.date(2026, 9, 16))
    assert one(spark, X.surface(F.col("s"), F.lit("alta"), c), s=sqm) == reason
    assert (one(spark, X.flags(F.col("s"), F.lit(50_000), F.lit(None).cast("date"), today, c), s=sqm) or [None])[0] == flag
    assert one(spark, S.oversize_penalty(F.col("s"), c), s=sqm) == (15 if sqm > 5000 else 0)


@pytest.mark.parametrize(("day", "want"), [(17, "TEMPO_INSUFFICIENTE"), (15, "ASTA_SCADUTA")])
def test_auction_time(spark, day, want):
    assert one(spark, X.auction_time(F.col("d"), F.lit(dt.date(2026, 9, 16)), Config()), d=dt.date(2026, 9, day)) == want


def test_share_is_dropped_and_nulls_never(spark):
    assert one(spark, X.tenure(F.col("t")), t="Quota di 2/6") == "DIRITTO"
    null = F.lit(None).cast("string")
    assert one(spark, F.coalesce(X.tenure(null), X.planning(null), X.category(null, null), X.surface(null.cast("double"), null, Config())), t=None) is None


@pytest.mark.parametrize(("price", "vote", "outcome", "config", "want"), [
    (375_000, 50, "PROMUOVI", "x", "MIGLIORATA"), (500_000, 56, "PROMUOVI", "x", "MIGLIORATA"), (500_000, 56, "PROMUOVI", "y", "INVARIATA"),
    (550_000, 50, "PROMUOVI", "x", "PEGGIORATA"), (500_000, 42, "PROMUOVI", "x", "PEGGIORATA"), (475_000, 50, "MONITORA", "x", "PEGGIORATA"), (500_000, 50, "PROMUOVI", "x", "INVARIATA"),
])
def test_comparison(spark, price, vote, outcome, config, want):
    none, day = F.array().cast("array<string>"), F.lit(dt.date(2026, 9, 16))
    was = {"price": F.lit(500_000.0), "vote": F.lit(50), "deadline": day, "run_date": day, "outcome": F.lit("PROMUOVI"), "missing": none, "width": F.lit(0.0), "config": F.lit("x")}
    now = was | {"price": F.col("p"), "vote": F.lit(vote), "outcome": F.lit(outcome), "config": F.lit(config)}
    assert one(spark, S.comparison(now, was, Config())["verdict"], p=float(price)) == want


def test_streak_cut_and_repeat(spark):
    rows = [(1, i, s) for i, s in enumerate([True, False, True, None, True, True, False])]
    got = W.streak_cut(spark.createDataFrame(rows, "g int, i int, s boolean"), ["g"], ["i"], F.col("s"), 3).collect()
    assert sorted(r.i for r in got) == [0, 1, 2, 3, 4, 5]


def test_envelopes(spark, tmp_path):
    (tmp_path / "dataset_caseasta.json").write_text('{"generated_at": "2026-09-16T00:00:00", "total": 1, "listings": {"caseasta_1": {"titolo": "Capannone", "prezzo": "€ 125.250", "indirizzo": "Gorle (BG) - Via", "superficie_mq": "1.250 mq", "scraped_at": "2026-09-15T01:02:03"}}}')
    (tmp_path / "dataset_vgi.json").write_text("")
    (tmp_path / "dataset_x.json").write_text('{"generated_at": null, "total": 0, "listings": {}}')
    rows = snapshots.read_envelopes(spark, str(tmp_path))
    assert rows.where("listing_key is not null").count() == 1 and snapshots.baseline(rows).count() == 1
    r = snapshots.canonical(rows).first()
    assert (r.price, r.sqm, r.town, r.province, r.category) == (D("125250.00"), D("1250.00"), "Gorle", "BG", "capannone")
    assert snapshots.unknown_fields(rows, ["titolo"]).count() == 4 and snapshots.unknown_sources(rows).count() == 0


def test_pages(spark):
    html = '<script type="application/ld+json">{"itemListElement":[{"item":{"url":"/a","name":"n","description":"d"}}]}</script><div class="card x"><a href="/1">One</a><p>€ 5</p></div><div class="card">Two</div><script id="__NEXT_DATA__">{"props":{"pageProps":{"results":[{"realEstate":{"id":1}},{"ad":1}]}}}</script>'
    d = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert [(r.text, r.href) for r in pages.cards(d, "div", "card").orderBy("position").collect()] == [("One | € 5", "/1"), ("Two", None)]
    assert pages.json_ld(d).first().url == "/a" and pages.app_state(d).count() == 1


def test_upsert_and_unseen(spark):
    old, new = spark.createDataFrame([("a", 1), ("b", 5)], "k string, t int"), spark.createDataFrame([("a", 2), ("b", 4), ("c", 1)], "k string, t int")
    assert sorted(map(tuple, J.upsert(old, new, "k", "t").collect())) == [("a", 2), ("b", 5), ("c", 1)]
    assert [r.k for r in J.unseen(new, old, "k").collect()] == ["c"]


def test_texts_and_more_scores(spark):
    from propscan.functions import describe as T

    assert one(spark, T.price_reason(F.col("a"), F.col("b")), a=500000.0, b=375000.0) == "Prezzo 500.000 € → 375.000 € (-25,0 %)"
    assert one(spark, T.vote_reason(F.col("a"), F.lit(61)), a=55) == "Voto 55 → 61"
    assert [m.field for m in one(spark, T.missing_data({"price": F.col("a"), "sqm": F.lit(1)}), a=None)] == ["price"]
    none = F.lit(None)
    for s, top in ((S.visibility_score(F.col("a"), none), 12), (S.basin_score(F.lit(1), none.cast("boolean")), 6), (S.plan_score(none, none, none), 11), (S.structure_score(none, none), 5), (S.transaction_score(F.lit(True), none.cast("boolean"), F.lit(1), none.cast("boolean")), 5)):
        r = one(spark, s, a="Via Statale 1")
        assert 0 <= r.lo <= r.mid <= r.hi <= top and r.lo < r.hi
    d = spark.createDataFrame([("p1", "Via x Milano", "Milano"), ("p1", "Roma", "Milano"), ("p2", "Roma", "Milano")], "page string, address string, city string")
    assert d.where(X.in_searched_city(F.col("address"), F.col("city"))).count() == 1
    assert [tuple(r) for r in X.fallback_pages(d, "address", "city", ["page"]).collect()] == [("p2",)]
    slugs = spark.createDataFrame([("via-roma-3",), ("via-roma-3",), ("romano-1",), (None,)], "slug string")
    assert [r.c for r in slugs.select(X.first_city(F.col("slug"), ["roma", "rom"]).alias("c")).collect()] == ["roma", "roma", None, None]
    assert [r.c for r in slugs.select(X.first_city(F.col("slug"), ["rom", "roma"], whole=False).alias("c")).collect()] == ["rom", "rom", "rom", None]


def test_ranking_past_excluded_rows(spark):
    """Thirty eligible rows, the best five unchanged (and named twice): ten are announced all the same."""
    from propscan.plans.evaluate import announced

    rows = spark.createDataFrame([(f"x_{i:02d}", 90 - i, 0.1, None, "PROMUOVI") for i in range(30)], "listing_id string, vote int, yoc_base double, deadline date, outcome string")
    old = spark.createDataFrame([(f"x_{i:02d}",) for i in (0, 1, 2, 3, 4, 0, 1)] + [(None,), ("gone",)], "listing_id string")
    got = announced(rows, old).orderBy("position").collect()
    assert [(r.listing_id, r.rank, r.skipped, r.note) for r in got] == [(f"x_{i:02d}", i + 1, 5, None) for i in range(5, 15)]
    few = announced(rows.limit(3)).collect()
    assert {r.note for r in few} == {"solo 3 opportunità idonee e con novità questa settimana"} and announced(rows.limit(0)).count() == 0


def test_radius_at_high_latitude_and_the_date_line(spark):
    a = spark.createDataFrame([(1, 80.0, 10.0), (2, 0.0, 179.99), (3, None, 5.0), (4, -88.5, -180.0)], "id int, lat double, lon double")
    b = spark.createDataFrame([(1, 80.0, 10.25), (2, 0.01, -179.99), (4, -88.5, 179.5)], "id int, lat double, lon double")
    assert sorted((r.id, r.r_id) for r in J.radius_join(a, b, 5.0).collect()) == [(1, 1), (2, 2), (4, 4)]
    with pytest.raises(Exception, match="latitude"):
        J.radius_join(a.withColumn("lat", F.lit(89.5)), b, 5.0).collect()


def test_reference_tables(spark, tmp_path):
    (tmp_path / "towns.csv").write_text("town,town_index\nmilano,80.5\npavia,\nbad,x\n")
    got, odd = J.reference_table(spark, str(tmp_path / "towns.csv"), "town string, town_index double")
    assert sorted(map(tuple, got.collect()), key=str) == [("milano", 80.5), ("pavia", None)]
    assert [r.line for r in odd.collect()] == ["bad,x"] and odd.count() == 1


def test_envelope_export(spark, tmp_path):
    import json

    rows = spark.createDataFrame([(f'k"{i}', json.dumps({"v": i})) for i in range(50)] + [('k"1', '{"v":1}'), (None, "{}")], "listing_key string, payload string").repartition(4)
    for some in (rows, rows.limit(0)):
        out = str(tmp_path / f"out{some.count()}")
        snapshots.envelope_lines(some, "2026-09-16T00:00:00").write.text(out)
        text = "".join(p.read_text() for p in sorted((tmp_path / out).glob("part-*")))
        doc = json.loads(text)
        assert doc["total"] == len(doc["listings"]) == some.where("listing_key is not null").select("listing_key").distinct().count()
        assert all(doc["listings"][f'k"{i}'] == {"v": i} for i in range(doc["total"]))


def test_rotation_registry_and_last_good(spark, tmp_path):
    from propscan.plans import publish

    path = str(tmp_path / "w")
    week = lambda day, n: spark.createDataFrame([(f"l{i}", "vgi", day) for i in range(n)], "listing_id string, source string, run_date string")
    for day, n in (("2026-09-02", 3), ("2026-09-09", 4), ("2026-09-09", 2)):
        snapshots.write_partition(week(day, n), path)
    stored = spark.read.parquet(path)
    assert {str(r.run_date): r["count"] for r in stored.groupBy("run_date").count().collect()} == {"2026-09-02": 3, "2026-09-09": 2}
    assert snapshots.previous(stored, "2026-09-09").count() == 3 and snapshots.previous(stored, "2026-09-02").count() == 0
    loads = spark.createDataFrame([("vgi", "2026-09-02", True), ("vgi", "2026-09-09", False)], "source string, run_date string, ok boolean")
    assert snapshots.last_good(week("2026-09-02", 3).union(week("2026-09-09", 2)), loads).count() == 3
    ranked = spark.createDataFrame([("l1", "ASTE", 70), ("l2", "ASTE", 60)], "listing_id string, channel string, vote int")
    for _ in range(2):
        publish.publish(ranked, str(tmp_path / "r"), "2026-09-16", "report_2026_09_16.json")
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_config_hash():
    assert Config().digest() == Config().digest() != Config(slots=9).digest() and len(Config().digest()) == 16


def test_tags_and_capex(spark):
    got = one(spark, P.tagged(F.col("a"), "json", "alta"), a=None)
    assert tuple(got) == (None, None, None) and tuple(one(spark, P.tagged(F.col("a"), "json", "alta"), a="x")) == ("x", "json", "alta")
    c, yes = Config(), F.lit(True)
    plain, full = (one(spark, S.capex(F.col("a"), F.lit(6.0), c, *flags), a=1000.0) for flags in ((), (yes, yes, yes, F.lit(30.0))))
    assert abs(plain - (525_000 + 1000 * 0.68 * 0.8 * 185)) < 1e-6 and abs(full - plain - 1000 * (140 + 55 + 47.5 - 30)) < 1e-6


def test_late_and_mixed_texts(spark):
    assert one(spark, P.relative_days(F.col("t")), t="alloggio aggiornato 3 giorni fa") == 3 and one(spark, P.relative_days(F.col("t")), t="un'ora fa") == 0
    assert one(spark, P.court(F.col("t")), t="x Tribunale di Busto Arsizio in composizione") == "Tribunale di Busto Arsizio"
    assert one(spark, P.slug(F.col("t")), t="Straße ½ ﬁn Łódź Ångström") is not None
    assert one(spark, P.is_blocked(F.col("t")), t=None) is False


def test_order_and_area(spark):
    rows = spark.createDataFrame([("a", 1, 5.0, None), ("b", 3, None, dt.date(2026, 1, 2)), ("c", 2, 9.0, dt.date(2026, 1, 1))], "listing_id string, vote int, price double, deadline date")
    ids = lambda d: [r.listing_id for r in d.collect()]
    assert ids(W.by_choice(rows)) == ["b", "c", "a"] and ids(W.by_choice(rows, "price")) == ["c", "a", "b"] and ids(W.by_choice(rows, "deadline")) == ["c", "b", "a"]
    assert ids(W.by_choice(rows, "vote", listing_id="c")) == ["c"] and ids(W.recent_first(rows, "deadline", "listing_id")) == ["b", "c", "a"]
    inside = lambda province, km: one(spark, X.geography(F.col("p"), F.lit("x"), ["MI"], Config(), F.lit(km).cast("double")), p=province)
    assert inside("MI", None) is None and inside("PV", 20.0) is None and inside(None, 20.0) is None and inside(None, None) is None
    assert inside("PV", 40.0) == inside("PV", None) == "PERIMETRO_GEOGRAFICO"


def test_keys_at_any_depth(spark):
    deep = '{"a":' * 13 + '[1, {"wanted": {"wanted": "x"}}]' + "}" * 13
    d = spark.createDataFrame([(1, deep), (2, '[{"wanted": null}, {"other": 1}]'), (3, None), (4, "no json"), (5, "{")], "page_id long, state string")
    got = sorted((r.page_id, r.path, r.value) for r in pages.found_keys(d, "page_id", "state", "wanted").collect())
    assert got == [(1, [0] * 13 + [1, 0], '{"wanted":"x"}'), (1, [0] * 13 + [1, 0, 0], "x"), (2, [0, 0], None)]
    assert pages.found_keys(d.where("page_id > 2"), "page_id", "state", "wanted").count() == 0


def test_towns_of_texts(spark):
    towns = spark.createDataFrame([("Reggio nell'Emilia", "RE"), ("Emilia", "XX"), ("San Donà di Piave", "VE"), ("Milano", "MI"), ("Rho", "MI"), ("Castro", "BG"), ("Castro", "LE"), ("Roma", "RM"), (None, "ZZ")], "town string, province string")
    texts = {
        1: "Capannone a Reggio nell'Emilia (RE)", 2: "Magazzino a Lambrate, Milano", 3: "SAN DONA' DI PIAVE", 4: "San Donà  di\nPiave", 5: "Opificio in Castro (le) vicino a Milano", 6: "Rho, zona Milano ovest",
        7: "Terreno altrove", 8: None, 9: "", 10: "Milano Milano", 11: "deposito, Castro",
    }
    rows = spark.createDataFrame(list(texts.items()), "k int, title string")
    got = {r.k: (r.town, r.province, r.confidence) for r in J.town_of_text(rows, "k", "title", towns).collect()}
    assert got == {
        1: ("Reggio nell'Emilia", "RE", "alta"), 2: ("Milano", "MI", "media"), 4: ("San Donà di Piave", "VE", "media"), 5: ("Castro", "LE", "alta"), 6: ("Milano", "MI", "bassa"),
        10: ("Milano", "MI", "media"), 11: ("Castro", "BG", "media"),
    }


def test_visibility_is_exact(spark):
    """Points are those of decimal arithmetic, so a width of half the points isn't a last digit more."""
    for address, km, want in (("viale Europa 3", 3.0, (5.4, 8.4, 11.4)), ("via Roma", None, (1.8, 4.8, 7.8)), ("Via Statale 12", 0.5, (9.0, 12.0, 12.0)), (None, 0.5, (4.2, 7.2, 10.2))):
        assert tuple(one(spark, S.visibility_score(F.col("a"), F.lit(km).cast("double")), a=address)) == want
