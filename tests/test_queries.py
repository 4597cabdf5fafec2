import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from oracle import compare, duck
from propscan.plans.expected import L
from propscan.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLE_SQL[name]) > 0


def components(ids, edges):
    """Smallest id of each id's component."""
    at = {i: i for i in ids}

    def find(i):
        while at[i] != i:
            at[i] = i = at[at[i]]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        at[b] = a
    return {i: find(i) for i in ids}


def test_resolution_and_weekly_chain(spark):
    """Properties against the relation and the lots that SQL gives; the chain's rows by the queries it is made of."""
    folder = "/root/testdata/sf0.001"
    con = duck(folder)
    rows = con.execute(f"{L} select listing_id, lower(trim(court)), procedure, lot from l").fetchall()
    lot = {i: (k, p, v) for i, k, p, v in rows if None not in (k, p, v)}
    edges = [r[:2] for r in con.execute(ORACLE_SQL["property_edges"]).fetchall()]
    found = {r.listing_id: r.property_id for r in QUERIES["resolved_properties"](spark, folder).collect()}
    assert len(found) == len(rows) > len(set(found.values()))
    groups = {}
    for i, p in found.items():
        groups.setdefault(p, []).append(i)
    case = lambda members: {(k, p): v for k, p, v in (lot[i] for i in members if i in lot)}
    apart = lambda members: all(case(members)[lot[i][:2]] == lot[i][2] for i in members if i in lot)
    assert all(apart(g) and min(g) == p for p, g in groups.items())
    within = components(found, [(a, b) for a, b in edges if found[a] == found[b]])
    assert within == found  # a property holds together by the relation's own edges
    whole = {}
    for i, c in components(found, edges).items():
        whole.setdefault(c, []).append(i)
    assert all(len({found[i] for i in g}) == 1 for g in whole.values() if apart(g))  # and nothing but lots parts what is linked
    assert any(not apart(g) for g in whole.values())
    top = QUERIES["weekly_announcements"](spark, folder).collect()
    verdicts = {r.listing_id: r for r in QUERIES["compared_history"](spark, folder).collect()}
    assert 0 < len(top) <= 10 and sorted(r.position for r in top) == list(range(1, len(top) + 1)) and len({r.property_id for r in top}) == len(top)
    for r in top:
        was = verdicts.get(r.listing_id)
        assert r.state == ("RISEGNALATA" if was and was.verdict == "MIGLIORATA" else "NUOVA") and (was is None or was.verdict in (None, "MIGLIORATA"))


def test_properties_over_weeks(spark):
    """A week on, components are those of all listings, and ids are last week's or new names."""
    folder = "/root/testdata/sf0.001"
    full = {r.listing_id: r.property_id for r in QUERIES["resolved_properties"](spark, folder).collect()}
    got = {r.listing_id: r for r in QUERIES["properties_over_weeks"](spark, folder).collect()}
    assert {i: r.component for i, r in got.items()} == full
    ids = {}
    for r in got.values():
        ids.setdefault(r.property_id, set()).add(r.component)
    assert all(len(c) == 1 for c in ids.values()) and len(ids) == len(set(full.values()))
