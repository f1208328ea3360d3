"""Graph operators on golden data and against brute force."""

import itertools
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftwork.operators import gangs, graph, ownership

FLIGHTS = [(1, 2, 201.0), (2, 3, 103.0), (3, 4, 68.0), (1, 5, 125.0), (5, 4, 89.0)]

# (owner, company, per cent)
HOLDINGS = [
    (11237796588023, 11092169553487, 1), (11237796588023, 11237796588022, 10), (11237796588023, 33363626168496, 40),
    (11237796588024, 11092169553487, 99), (11237796588024, 11237796588022, 90), (11237796588025, 10042736081533, 40),
    (11237796588025, 18435136217914, 50), (11237796588025, 18605621136430, 100), (11237796588025, 18796202849810, 100),
    (11237796588025, 10091102063629, 48), (11237796588025, 31066287865416, 12.5), (11237796588025, 37850538356947, 19),
    (11237796588025, 90885542357054, 25), (11237796588026, 10042605335136, 90), (11237796588026, 10042736081533, 10),
    (11237796588026, 10091102063629, 8), (11237796588026, 31552294580523, 100), (11237796588026, 32641186831916, 97),
    (11237796588026, 90885542357054, 8), (11237796588027, 10091102063629, 44), (11237796588028, 10110574881520, 49),
    (11237796588030, 10136132161012, 5), (11237796588037, 34172816335138, 1), (11237796588036, 34172816335138, 1),
    (11237796588039, 37341899374161, 30), (11237796588043, 97167755234103, 25), (11237796588044, 97167755234103, 10),
    (11237796588045, 97167755234103, 20), (11237796588041, 97167755234103, 10), (11237796588046, 97167755234103, 5),
    (11237796588047, 16281443110610, 10), (11237796588047, 30174481594112, 100), (11237796588047, 30442928894541, 90),
    (11237796588047, 84463442500156, 16), (11237796588048, 31225952294810, 85), (11237796588049, 30442928894541, 10),
    (11237796588049, 17300250450618, 20), (11237796588049, 76702671028772, 70), (10091102063629, 10110574881520, 51),
    (10091102063629, 10136132161012, 95), (10091102063629, 27438164923634, 100), (10091102063629, 34172816335138, 98),
    (10091102063629, 37341899374161, 70), (10091102063629, 97167755234103, 10), (97167755234103, 87164635374548, 100),
    (97167755234103, 88724407007321, 30), (30224631551375, 97167755234103, 20), (30442928894541, 34445767320818, 100),
]

CASES = {
    10290291: [10290101, 10290221, 10290921, 10290311],
    10290102: [10290311, 10290111, 10290101, 10290221, 10290921, 12110117],
    12900991: [10920128, 10910129, 12110126, 12110117],
    10920128: [20192101, 10290101],
    93012001: [20192001, 20192301, 20192101],
    12900992: [10290101, 10290221, 10290921, 13019201, 10290311],
}


def edges_table(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long, weight double")


def landmark(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_shortest_path_weighted(spark):
    found = graph.shortest_paths(edges_table(spark, FLIGHTS), landmark(spark, 4), "weight").collect()
    assert {r.id: r.distance for r in found} == {1: 214, 2: 171, 3: 68, 4: 0, 5: 89}


def test_shortest_path_hops(spark):
    found = graph.shortest_paths(edges_table(spark, FLIGHTS), landmark(spark, 4)).collect()
    assert {r.id: r.distance for r in found} == {1: 2, 2: 2, 3: 1, 4: 0, 5: 1}


def test_shortest_path_cycle_and_two_landmarks(spark):
    rows = [(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 3, 5.0), (2, 3, 9.0)]
    found = graph.shortest_paths(edges_table(spark, rows), landmark(spark, 1, 3), "weight").collect()
    assert {(r.id, r.landmark): r.distance for r in found} == {
        (1, 1): 0, (2, 1): 2, (3, 1): 1, (3, 3): 0, (2, 3): 1, (1, 3): 2,
    }


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7), st.integers(0, 9)), min_size=1, max_size=25),
    st.sampled_from([-1, 1_000_000]),
)
def test_shortest_path_like_relaxation(spark, rows, rewrite_below):
    expected = {0: 0.0}
    for _ in range(8):
        for s, d, w in rows:
            if d in expected:
                expected[s] = min(expected.get(s, float("inf")), expected[d] + w)
    table = edges_table(spark, [(s, d, float(w)) for s, d, w in rows])
    found = graph.shortest_paths(table, landmark(spark, 0), "weight", rewrite_below=rewrite_below)
    assert {r.id: r.distance for r in found.collect()} == expected


def test_shortest_path_tail_writes_improvements_only(spark, monkeypatch):
    """A star with a chain behind it: after the star is known, each round improves one row."""
    calls = []
    improved = graph._improved
    monkeypatch.setattr(graph, "_improved", lambda *a: calls.append(1) or improved(*a))
    chain = [(1000 + i + 1, 1000 + i, 2.0) for i in range(24)]
    rows = [(i, 0, 1.0) for i in range(1, 400)] + [(1000, 0, 5.0), *chain]
    found = graph.shortest_paths(edges_table(spark, rows), landmark(spark, 0), "weight", rewrite_below=100)
    distances = {r.id: r.distance for r in found.collect()}
    assert len(distances) == 425 and distances[1024] == 5 + 48 and distances[7] == 1
    assert len(calls) > 20


def test_ownership_golden(spark):
    edges = spark.createDataFrame([(a, b, c / 100) for a, b, c in HOLDINGS], "src long, dst long, rate double")
    shares = ownership.control_shares(edges).collect()
    assert len(shares) == 88
    over = {(r.origin, r.id): round(r.share, 6) for r in shares if r.share > 0.3}
    assert len(over) == 35
    expected = {
        (11237796588025, 10136132161012): 0.95, (10091102063629, 10136132161012): 0.95,
        (11237796588027, 10136132161012): 0.95, (11237796588048, 31225952294810): 0.85,
        (11237796588023, 33363626168496): 0.4, (11237796588025, 10091102063629): 0.48,
        (11237796588027, 10091102063629): 0.44, (11237796588025, 18605621136430): 1.0,
        (11237796588047, 30174481594112): 1.0, (11237796588047, 30442928894541): 0.9,
    }
    assert expected.items() <= over.items()


def test_ownership_round_limit_and_names(spark):
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(12)], "src long, dst long, rate double")
    reached = {r.id for r in ownership.control_shares(chain).where("origin = 0").collect()}
    assert reached == set(range(1, 13))
    with pytest.raises(RuntimeError):
        ownership.control_shares(chain, max_rounds=3)
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "key long, name string")
    shares = ownership.control_shares(chain)
    rows = {(r.origin_name, r.held_name) for r in ownership.controllers(shares, names).collect()}
    assert ("zero", "one") in rows and ("one", None) in rows


def test_resolve_edges(spark):
    ids = spark.createDataFrame([("a", 1), ("b", 2)], "id string, key long")
    edges = spark.createDataFrame([("a", "b", 12.5), ("a", "x", 50.0)], "`from` string, `to` string, rate double")
    assert [tuple(r) for r in ownership.resolve_edges(edges, ids, "PINV", "rate").collect()] == [(1, 2, 0.125, "PINV")]
    assert ownership.unresolved_count(edges, ids).first().unresolved == 1


def links_table(spark, cases):
    return spark.createDataFrame([(c, m) for c, ms in cases.items() for m in ms], "case long, member long")


def brute_triples(cases, least):
    shared = defaultdict(set)
    for case, members in cases.items():
        for triple in itertools.combinations(sorted(set(members)), 3):
            shared[triple].add(case)
    return {t: c for t, c in shared.items() if len(c) >= least}


def brute_members(cases, least):
    found = set()
    for triple, shared in brute_triples(cases, least).items():
        for member in {m for ms in cases.values() for m in ms}:
            own = {c for c in shared if member in cases[c]}
            if len(own) >= least:
                found |= {(member, *triple, c) for c in own}
    return found


def test_gangs_golden(spark):
    rows = gangs.gang_members(links_table(spark, CASES))
    report = gangs.gang_report(rows).collect()
    per_member = defaultdict(list)
    for r in report:
        per_member[r.member].append((r.triple, r.cases))
    assert set(per_member) == {10290101, 10290221, 10290311, 10290921}
    for lines in per_member.values():
        assert len(lines) == 4
        assert {cases for _, cases in lines} == {"10290102,10290291,12900992"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(0, 9), st.sets(st.integers(0, 8), max_size=8), min_size=3, max_size=9),
    st.sampled_from([None, 2, 4, 100]), st.sampled_from([1, 2, 3]),
)
def test_gangs_like_brute_force(spark, cases, light, least):
    """With a low limit for light cases, most of the work is on the side of the large ones."""
    links = links_table(spark, {**cases, 99: [50]})
    triples = gangs.shared_triples(links, least, light).collect()
    expected = {(*t, c) for t, cs in brute_triples(cases, least).items() for c in cs}
    assert {tuple(r) for r in triples} == expected and len(triples) == len(expected)
    members = gangs.gang_members(links, least, light).collect()
    assert {tuple(r) for r in members} == brute_members(cases, least)
    assert len({tuple(r) for r in members}) == len(members)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 12), st.lists(st.integers(0, 9), max_size=9), max_size=12), st.sampled_from([None, 0, 3, 5, 100]),
    st.integers(2, 4),
)
def test_suspects_like_brute_force(spark, cases, light, least):
    links = links_table(spark, cases)
    expected = {(m, c) for t, cs in brute_triples(cases, least).items() for c in cs for m in t}
    found = [tuple(r) for r in gangs.shared_cases(links, least, light).collect()]
    assert set(found) == expected and len(found) == len(expected)


def test_suspects_of_cases_too_large_for_triples(spark):
    """Three cases with 20,000 holders have 10^12 triples; the holders are found as one class."""
    links = spark.range(20_000).select(F.explode(F.array(*map(F.lit, range(3)))).alias("case"), F.col("id").alias("member"))
    links = links.union(spark.createDataFrame([(3, 1), (3, 2), (0, 30_000), (1, 30_000)], "case int, member long"))
    found = gangs.suspects(links)
    assert found.count() == 20_000 and found.where("cases = 3").count() == 20_000


def test_gangs_with_hot_case(spark):
    """One case holds most members; its pairs are never listed, yet triples over it are found."""
    cases = {0: range(400), 1: range(0, 400, 2), 2: [2, 4, 6, 9], 3: [2, 4, 6, 11], 4: [1, 3, 5]}
    found = gangs.shared_triples(links_table(spark, cases), 4, light=32).collect()
    assert {tuple(r) for r in found} == {(2, 4, 6, c) for c in (0, 1, 2, 3)}


@pytest.mark.parametrize("light", [None, 3])
def test_tasks_of_triples_grow_with_their_number(spark, monkeypatch, light):
    """Each task lists and counts about as many triples, whatever the session's number of partitions."""
    monkeypatch.setattr(gangs, "PART_ROWS", 10, raising=False)
    cases = {c: {c, c + 1, c + 2, 70, 71, 72} if c % 2 else {c, 70, 71} for c in range(24)}
    triples = gangs.triple_counts(links_table(spark, cases), light=light)
    expected = {(*t, len(c)) for t, c in brute_triples(cases, 3).items()}
    assert {tuple(r) for r in triples.collect()} == expected
    plan = triples._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(m1\S+ m2\S+ m3\S+ (\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt and min(map(int, dealt)) >= sum(n for *_, n in expected) / 10 > 1
    suspects = gangs.shared_cases(links_table(spark, cases), light=light).collect()
    assert {tuple(r) for r in suspects} == {(m, c) for t, cs in brute_triples(cases, 3).items() for c in cs for m in t}


def test_size_limit_splits_off_the_hot_case(spark):
    """A case with most members is large; a member in most cases does not make its cases large."""
    hot_case = [(m, 1000) for m in range(1000)] + [(m % 1000, 4) for m in range(400)]
    table = spark.createDataFrame(hot_case, "member long, size long")
    assert gangs.size_limit(table) < 1000
    hot_member = [(0, 4) for _ in range(5000)] + [(m, 4) for m in range(15000)]
    assert gangs.size_limit(spark.createDataFrame(hot_member, "member long, size long")) == 4
    found = gangs.shared_triples(links_table(spark, {0: range(400), 1: range(0, 400, 2), 2: [2, 4, 6], 3: [2, 4, 6]}), 4)
    assert {tuple(r) for r in found.collect()} == {(2, 4, 6, c) for c in range(4)}


def test_report_in_parts(spark):
    rows = spark.createDataFrame([(1, 1, 2, 3, c) for c in range(50)], "member long, m1 long, m2 long, m3 long, case long")
    lines = {line.part: line.cases for line in gangs.gang_report(rows, length=20).collect()}
    assert lines == {i: ",".join(map(str, range(20 * i, min(50, 20 * i + 20)))) for i in range(3)}


def test_property_graph(spark):
    people = spark.createDataFrame(
        [(3, "a", "student"), (7, "b", "postdoc"), (5, "c", "prof"), (2, "d", "prof")], "id long, name string, role string"
    )
    edges = spark.createDataFrame(
        [(3, 7, "collab"), (5, 3, "advisor"), (2, 5, "colleague"), (5, 7, "pi"), (5, 0, "missing")],
        "src long, dst long, kind string",
    )
    full = graph.with_default_vertices(people, edges, {"name": "nobody", "role": "unknown"})
    assert full.where("id = 0").first().role == "unknown" and full.count() == 5
    assert edges.where("src > dst").count() == 2
    kept, left = graph.subgraph(full, edges, full["role"] != "unknown")
    assert kept.count() == 4 and left.count() == 4
    assert graph.triplets(full, edges, "name").count() == 5


def test_path_rounds_are_bounded(spark):
    with pytest.raises(RuntimeError):
        graph.shortest_paths(edges_table(spark, FLIGHTS), landmark(spark, 4), max_rounds=1)


def test_shares_do_not_depend_on_the_order_of_addition(spark):
    edges = [(0, i, 0.1) for i in (1, 2, 3)] + [(i, 4, 1.0) for i in (1, 2, 3)] + [(4, 5, 0.4)]
    shares = ownership.control_shares(spark.createDataFrame(edges, "src long, dst long, rate double"))
    found = {r.id: r.share for r in shares.where("origin = 0").collect()}
    assert found[4] == 0.3 and round(found[5], 9) == 0.12


def test_negative_weights_are_refused(spark):
    edges = spark.createDataFrame([(1, 2, -1.0)], "src long, dst long, w double")
    with pytest.raises(ValueError):
        graph.shortest_paths(edges, landmark(spark, 2), weight="w")


def test_shares_at_the_limit_are_not_over_it(spark):
    """0.05 + 0.1 + 0.15 is 0.3, in any order, and does not count as more."""
    edges = [(0, 1, 0.05), (0, 2, 0.1), (0, 3, 0.15), (1, 4, 1.0), (2, 4, 1.0), (3, 4, 1.0), (4, 5, 0.4)]
    for parts in (1, 3, 7):
        table = spark.createDataFrame(edges, "src long, dst long, rate double").repartition(parts)
        found = {r.id: r.share for r in ownership.control_shares(table).where("origin = 0").collect()}
        assert found[4] == 0.3 and found[5] == 0.4 * 0.3


def test_very_small_shares_stay(spark):
    edges = [(0, 1, 0.0012), (1, 2, 1e-10), (0, 3, 1.2e-13), (7, 3, 12.5)]
    found = {(r.origin, r.id): r.share for r in ownership.control_shares(spark.createDataFrame(edges, "src long, dst long, rate double")).collect()}
    assert found[0, 2] == 0.0012 * 1e-10 and found[0, 3] == 1.2e-13 and found[7, 3] == 12.5


def plain_shares(edges):
    """The rules with fractions, round by round, on whole tables."""
    from fractions import Fraction

    ends = {v for s, d, _ in edges for v in (s, d)}
    shares, active = {(v, v): Fraction(1) for v in ends}, list(edges)
    while active:
        sums = defaultdict(Fraction)
        for s, d, rate in active:
            for (i, origin), share in shares.items():
                if i == s and origin != d and share > Fraction("0.001"):
                    sums[d, origin] += Fraction(rate) * (1 if share > Fraction("0.3") else share)
        grown = {i for i, origin in sums if (i, origin) not in shares}
        for key, value in sums.items():
            shares[key] = max(shares.get(key, Fraction(0)), value)
        active = [e for e in edges if e[1] in grown]
    return {(o, i): float(x) for (i, o), x in shares.items() if o != i}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.sampled_from([0.0625, 0.125, 0.25, 0.5, 0.75, 1.0])), min_size=1, max_size=25))
def test_shares_like_whole_rounds(spark, edges):
    """Random graphs with cycles, self-loops and repeated edges, where sums of sixteenths are exact."""
    found = ownership.control_shares(spark.createDataFrame(edges, "src long, dst long, rate double")).collect()
    assert {(r.origin, r.id): r.share for r in found} == plain_shares(edges) and len(found) == len(plain_shares(edges))


def test_shares_without_broadcasts(spark):
    edges = [(i, i + 1, 0.5 + (i % 3) / 8) for i in range(40)] + [(i, i + 2, 0.125) for i in range(39)]
    table = spark.createDataFrame(edges, "src long, dst long, rate double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = {tuple(r) for r in ownership.control_shares(table).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {tuple(r) for r in ownership.control_shares(table).collect()} == want and len(want) > 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
