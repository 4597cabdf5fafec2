from propscan.operators import joins as J
from propscan.plans import publish
from propscan.plans.evaluate import OPTIONAL, evaluated
from pyspark.sql import functions as F


def test_perimeter_knows_what_it_does_not_know(spark):
    rows = [("a", " Bergamo", None, None), ("b", "gorle", 45.70, 9.72), ("c", "far", 40.0, 9.7), ("d", "somewhere", None, None), ("e", None, None, None), ("f", "ROMA", 45.7, 9.7), ("f2", "x", 45.7, None)]
    table = spark.createDataFrame(rows, "listing_id string, town string, lat double, lon double").withColumn("distance_km", F.lit(7))
    targets = spark.createDataFrame([("bergamo", 45.695, 9.67), ("Bergamo ", 45.695, 9.67), ("lodi", None, None), (None, 0.0, 0.0)], "town string, lat double, lon double")
    got = {r.listing_id: (r.distance_km, r.inside) for r in J.with_perimeter(table, targets, ["roma"]).collect()}
    assert len(got) == len(rows) and got["a"] == (0.0, True) and 3 < got["b"][0] < 5 and got["b"][1] is True and got["c"] == (float("inf"), False)
    assert got["d"] == got["e"] == got["f2"] == (None, None) and got["f"][1] is False
    assert J.with_perimeter(table.limit(0), targets, []).count() == 0
    assert {r.inside for r in J.with_perimeter(table, targets.limit(0), []).collect()} == {False, None}


def test_numbers_of_a_report(spark):
    rows = [(f"l{i:02d}", ("ASTE", "IMM_ID")[i % 2], ("PROMUOVI", "SCARTA", "MONITORA")[i % 3], "TIPOLOGIA" if i % 3 == 1 else None, 100 - i) for i in range(30)]
    table = spark.createDataFrame(rows, "listing_id string, channel string, outcome string, reason string, vote int")
    verdict = {"l00": "INVARIATA", "l03": "MIGLIORATA", "l09": "PEGGIORATA", "l27": "INVARIATA", "l01": "INVARIATA"}
    verdicts = spark.createDataFrame(list(verdict.items()), "listing_id string, verdict string")
    for slots in (3, 10):
        ranked = [r for r in rows if r[2] == "PROMUOVI"]
        told = [r for r in ranked if verdict.get(r[0], "MIGLIORATA") == "MIGLIORATA"][:slots]
        last = told[-1][0] if len(told) == slots else "z"
        passed = [verdict[r[0]] for r in ranked if r[0] < last and verdict.get(r[0], "MIGLIORATA") != "MIGLIORATA"]
        want = {
            ("record_letti", None): 33, ("duplicati_uniti", None): 3, ("in_classifica", None): 10, ("posizioni_scorse", None): len(passed), ("scarti_per_motivo", "TIPOLOGIA"): 10,
            **{("escluse_per_storico", v): passed.count(v) for v in ("INVARIATA", "PEGGIORATA")}, **{("per_esito", o): 10 * (o != "DA APPROFONDIRE") for o in publish.OUTCOMES},
            ("segnalate", "totale"): len(told), ("segnalate", "nuove"): len(told) - 1, ("segnalate", "risegnalate"): 1, **{("segnalate", f"da_{c}"): sum(r[1] == c for r in told) for c in publish.CHANNELS},
        }
        top = spark.createDataFrame(told, table.schema)
        got = publish.report_statistics(table.union(table.limit(3)), table, verdicts, top, F.struct(-F.col("vote"), "listing_id"), slots)
        assert {(r.statistic, r.key): r.n for r in got.collect()} == want
    none = publish.report_statistics(table.limit(0), table.limit(0), verdicts, table.limit(0), F.struct(-F.col("vote"), "listing_id"))
    assert {r.n for r in none.collect()} == {0} and none.count() == len(publish._ALWAYS) + 2


def test_a_range_of_fifteen_points_is_promoted(spark):
    """Criteria that are uncertain by exactly 15 points in all; a report's numbers and the run's statistics count it as promoted."""
    facts = {
        "town_index": 29.0, "province_index": 44.0, "competitor_sqm": 18300.0, "inhabitants": 169000.0, "address": "via Roma", "retail_poles": 0, "barrier": True, "height": 5.5, "floor": -1, "bays": 2,
        "yard": True, "gates": True, "certified": True, "permit": "libero", "adjacent": False, "second_bay": False, "phased": False, "auction": True, "free": True, "failed": 1, "custodian": False,
    }
    row = {"listing_id": "x", "category": "capannone", "price": 228508.27, "sqm": 1490.0, "town": "gorle", **facts}
    table = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {OPTIONAL.get(k, 'double' if isinstance(v, float) else 'string')}" for k, v in row.items()))
    table = table.withColumn("deadline", F.lit("2026-11-05").cast("date"))
    got = evaluated(table, "2026-09-16").select("outcome", (F.col("quality.hi") - F.col("quality.lo")).alias("width")).first()
    assert got.width <= 15 and got.outcome == "PROMUOVI"
