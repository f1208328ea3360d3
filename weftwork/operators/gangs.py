"""Groups of three members that share several cases, from links (case, member).

All triples of a case with n members are n^3 / 6 rows, so triples are never listed per case as such:

* Cases and members too small to matter go first, then pairs with too few shared cases; a triple is
  only built from surviving pairs of its case.
* This is done inside light cases only. A large case never pairs its members. It is handled from the
  other side: sets of ``min_cases`` large cases that a member has, kept at each step only if three
  members have them. All members of such a set share all of its cases, so every triple among
  them is a result.
* Triples with shared cases of both sorts come from a light one, and their large cases are looked up.
* The size from which a case is large is chosen from the data, so that the pairs listed on both sides
  together are fewest. One case with a third of all links is large; one member in a third of
  all cases is only ever a member of light ones, unless these are large as well.

Pairs and triples are many more than the links they come from, and a task counts the different ones it meets, so they are
dealt by their number over as many partitions as keep ``PART_ROWS`` in each, whatever the session's number of partitions is.

Every triple over the limit is found, whatever the sizes are and wherever the line is drawn.

``suspects`` names the members of such triples and their cases without listing triples of large cases: a set of
``min_cases`` cases that three members have makes all its holders suspects at once. Members with the same large
cases are one class, so a set is listed once for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftwork.operators.aggregate import collect_lists
from weftwork.session import checkpointed

TRIPLE = ["m1", "m2", "m3"]
# Three people in three cases.
MIN_MEMBERS = 3
MIN_CASES = 3
PART_ROWS = 500_000  # pairs or triples that a task lists or counts


def prune_links(links: DataFrame, min_members: int = MIN_MEMBERS, min_cases: int = MIN_CASES) -> DataFrame:
    """Distinct links of cases with enough members, then of members with enough such cases.

    ``size`` is the number of members of the case before members were dropped.
    """
    links = links.select("case", "member").distinct()
    cases = links.groupBy("case").agg(F.count("*").alias("size")).where(F.col("size") >= min_members)
    links = links.join(cases, "case")
    members = links.groupBy("member").agg(F.count("*").alias("n")).where(F.col("n") >= min_cases).select("member")
    return links.join(members, "member", "left_semi").select("case", "member", "size")


def _parts(rows: int) -> int:
    return max(1, -(-rows // PART_ROWS))


def _listed(links: DataFrame, choose: int) -> int:
    """How many sets of ``choose`` members the cases of the links (case, member) have: sums of binomials."""
    n = F.col("n")
    sets = n * (n - 1) / 2 if choose == 2 else n * (n - 1) * (n - 2) / 6
    sizes = links.groupBy("case").agg(F.count("*").alias("n"))
    return int(sizes.agg(F.sum(sets)).first()[0] or 0)


def _light_triples(light: DataFrame, large: DataFrame | None, min_cases: int) -> tuple[DataFrame, int]:
    """(case, m1, m2, m3) of light cases, for triples with two pairs that can reach ``min_cases``; and ``_parts`` of them."""
    parts = _parts(_listed(light, 2))
    dealt = light.repartition(parts, "case")
    a, b = dealt.alias("a"), dealt.alias("b")
    pairs = a.join(b, (F.col("a.case") == F.col("b.case")) & (F.col("a.member") < F.col("b.member"))).select(
        "a.case", F.col("a.member").alias("m1"), F.col("b.member").alias("m2")
    )
    counts = pairs.repartition(parts, "m1", "m2").groupBy("m1", "m2").agg(F.count("*").alias("n"))
    if large is None:
        able = counts.where(F.col("n") >= min_cases)
    else:
        degree = large.groupBy("member").agg(F.count("*").alias("d"))
        able = (
            counts.join(degree.select(F.col("member").alias("m1"), F.col("d").alias("d1")), "m1", "left")
            .join(degree.select(F.col("member").alias("m2"), F.col("d").alias("d2")), "m2", "left")
            .where(F.col("n") + F.coalesce(F.least("d1", "d2"), F.lit(0)) >= min_cases)
            .where((F.col("n") >= min_cases) | (F.col("d1").isNotNull() & F.col("d2").isNotNull()))
        )
    kept = checkpointed(pairs.join(able.select("m1", "m2"), ["m1", "m2"], "left_semi").select("case", "m1", "m2"))
    starts = kept.groupBy("case", "m1").agg(F.count("*").alias("n"))
    parts = _parts(int(starts.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0))
    dealt = kept.repartition(parts, "case", "m1")
    x, y = dealt.alias("x"), dealt.alias("y")
    same = (F.col("x.case") == F.col("y.case")) & (F.col("x.m1") == F.col("y.m1")) & (F.col("x.m2") < F.col("y.m2"))
    return x.join(y, same).select("x.case", "x.m1", "x.m2", F.col("y.m2").alias("m3")), parts


def _frequent(rows: DataFrame, min_cases: int, parts: int) -> DataFrame:
    """The rows (case, m1, m2, m3) of triples with at least ``min_cases`` of them."""
    rows = rows.repartition(parts, *TRIPLE)
    enough = rows.groupBy(*TRIPLE).agg(F.count("*").alias("n")).where(F.col("n") >= min_cases)
    return rows.join(enough.select(*TRIPLE), TRIPLE, "left_semi")


def _large_classes(large: DataFrame) -> DataFrame:
    """(member, class): members with the same large cases are of one class, named after its least member.

    Sets of cases are compared by their number and two 64-bit hashes, as one member may have any number of them.
    """
    print_of = [
        F.count("*").alias("cases"), F.bit_xor(F.xxhash64("case")).alias("mixed"),
        F.bit_xor(F.xxhash64("case", F.lit(1))).alias("mixed_again"),
    ]
    prints = large.groupBy("member").agg(*print_of)
    keys = ["cases", "mixed", "mixed_again"]
    named = prints.groupBy(*keys).agg(F.min("member").alias("class"))
    return prints.join(named, keys).select("member", "class")


def _large_sets(large: DataFrame, classes: DataFrame, min_cases: int) -> tuple[DataFrame, list[str]]:
    """(c1, c2, ..., class) of the sets of ``min_cases`` large cases with three holders; and the names of the cases."""
    weights = classes.groupBy("class").agg(F.count("*").alias("holders"))
    held = large.join(weights, F.col("member") == F.col("class")).select("class", "holders", "case")
    chain = ["c1"]
    sets = held.withColumnRenamed("case", "c1")
    for step in range(2, min_cases + 1):
        following = held.select("class", F.col("case").alias(f"c{step}"))
        sets = sets.join(following, "class").where(f"c{step - 1} < c{step}")
        chain.append(f"c{step}")
        shared = sets.groupBy(*chain).agg(F.sum("holders").alias("n")).where(F.col("n") >= MIN_MEMBERS).select(*chain)
        sets = sets.join(shared, chain, "left_semi")
    return sets.select(*chain, "class"), chain


def _large_only_triples(large: DataFrame, min_cases: int) -> DataFrame:
    """Triples that share ``min_cases`` large cases."""
    classes = checkpointed(_large_classes(large))
    sets, chain = _large_sets(large, classes, min_cases)
    holders = sets.join(classes, "class").drop("class")
    one, two, three = (holders.withColumnRenamed("member", name) for name in TRIPLE)
    return (
        one.join(two, chain).where("m1 < m2").join(three, chain).where("m2 < m3").select(*TRIPLE).distinct()
    )


def _large_cases_of(triples: DataFrame, large: DataFrame) -> DataFrame:
    """(case, m1, m2, m3) for large cases, looked up from the member of the triple with the fewest."""
    degree = large.groupBy("member").agg(F.count("*").alias("d"))
    probe = triples
    for name in TRIPLE:
        probe = probe.join(degree.select(F.col("member").alias(name), F.col("d").alias(f"d_{name}")), name)
    fewest = F.least(*[F.struct(F.col(f"d_{name}").alias("d"), F.col(name).alias("member")) for name in TRIPLE])
    rows = probe.select(*TRIPLE, fewest["member"].alias("member")).join(large, "member").select("case", *TRIPLE)
    for name in TRIPLE:
        rows = rows.join(large.select("case", F.col("member").alias(name)), ["case", name], "left_semi")
    return rows.select("case", *TRIPLE)


def size_limit(sized: DataFrame) -> int:
    """The case size up to which listing member pairs per case costs least, from links (member, size).

    Sizes are put into powers of two, so the costs are a few dozen numbers. Up to a limit the cost is
    a pair per two members of a case; over it, a pair per two large cases of a member.
    """
    level = F.ceil(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("level")
    by_member = sized.select("member", "size", level).groupBy("member", "level").agg(
        F.count("*").alias("n"), F.sum("size").alias("pairs")
    )
    above = Window.partitionBy("member").orderBy(F.desc("level"))
    grown = F.sum("n").over(above)
    # Lowering the limit past a level adds this many pairs of large cases for the member.
    added = by_member.select("level", "pairs", (grown * grown - (grown - F.col("n")) * (grown - F.col("n"))).alias("added"))
    costs = added.groupBy("level").agg(
        F.sum(F.col("pairs").cast("double")).alias("light"), F.sum(F.col("added").cast("double")).alias("large")
    ).orderBy("level").collect()
    best, limit = float("inf"), 1
    for cut in range(len(costs) + 1):
        cost = sum(c.light for c in costs[:cut]) + sum(c.large for c in costs[cut:])
        if cost <= best:
            best, limit = cost, (1 << costs[cut - 1].level if cut else 1)
    return limit


def shared_triples(links: DataFrame, min_cases: int = MIN_CASES, light: int | None = None) -> DataFrame:
    """(m1, m2, m3, case) for all triples m1 < m2 < m3 with at least ``min_cases`` cases in common.

    ``light`` fixes the largest size of a light case; left out, it is chosen by ``size_limit``.
    """
    sized = checkpointed(prune_links(links, MIN_MEMBERS, min_cases))
    if light is None:
        light = size_limit(sized)
    small = sized.where(F.col("size") <= light).select("case", "member")
    large = sized.where(F.col("size") > light).select("case", "member")
    if large.isEmpty():
        rows, parts = _light_triples(small, None, min_cases)
    else:
        found = checkpointed(_light_triples(small, large, min_cases)[0])
        candidates = found.select(*TRIPLE).union(_large_only_triples(large, min_cases)).distinct()
        rows = found.unionByName(_large_cases_of(candidates, large))
        parts = _parts(rows.count())
    return _frequent(rows, min_cases, parts).select(*TRIPLE, "case")


def shared_cases(links: DataFrame, min_cases: int = MIN_CASES, light: int | None = None) -> DataFrame:
    """(member, case): the cases that a member shares with two others who share ``min_cases`` cases with it.

    The same as the distinct members and cases of ``shared_triples``, but no triple of large cases alone is listed.
    """
    sized = checkpointed(prune_links(links, MIN_MEMBERS, min_cases))
    if light is None:
        light = size_limit(sized)
    small = sized.where(F.col("size") <= light).select("case", "member")
    large = sized.where(F.col("size") > light).select("case", "member")
    no_large = large.isEmpty()
    if no_large:
        rows, parts = _light_triples(small, None, min_cases)
    else:
        rows = checkpointed(_light_triples(small, large, min_cases)[0])
        rows = rows.unionByName(_large_cases_of(rows.select(*TRIPLE).distinct(), large))
        parts = _parts(rows.count())
    found = _frequent(rows, min_cases, parts).select(F.explode(F.array(*TRIPLE)).alias("member"), "case")
    if not no_large:
        classes = checkpointed(_large_classes(large))
        sets, chain = _large_sets(large, classes, min_cases)
        of_class = sets.select("class", F.explode(F.array(*chain)).alias("case")).distinct()
        found = found.union(of_class.join(classes, "class").select("member", "case"))
    return found.distinct()


def suspects(links: DataFrame, min_cases: int = MIN_CASES, light: int | None = None) -> DataFrame:
    """(member, cases): members of any triple with ``min_cases`` common cases, and how many cases they share so."""
    return shared_cases(links, min_cases, light).groupBy("member").agg(F.count("*").alias("cases"))


def triple_counts(links: DataFrame, min_cases: int = MIN_CASES, light: int | None = None) -> DataFrame:
    """(m1, m2, m3, n): triples with the number of cases that they share."""
    return shared_triples(links, min_cases, light).groupBy(*TRIPLE).agg(F.count("*").alias("n"))


def gang_members(links: DataFrame, min_cases: int = MIN_CASES, light: int | None = None) -> DataFrame:
    """(member, m1, m2, m3, case): per member the triples found in at least ``min_cases`` of its cases.

    The member need not belong to the triple. If it does not, it makes further such triples with every
    two of the three, which is how it is found without going through all members of the cases.
    """
    shared = checkpointed(shared_triples(links, min_cases, light))
    triples = shared.select(*TRIPLE).distinct()
    inside = shared.select(F.explode(F.array(*TRIPLE)).alias("member"), *TRIPLE, "case")
    sides = [("m1", "m2", "m3"), ("m1", "m3", "m2"), ("m2", "m3", "m1")]
    extended = triples.select(
        F.explode(F.array(*[
            F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(c).alias("member")) for a, b, c in sides
        ])).alias("e")
    ).select("e.*")
    # A triple is extended along its pair with the fewest thirds, and checked along the other two.
    thirds = extended.groupBy("a", "b").agg(F.count("*").alias("d"))
    weighed = triples
    for i, (a, b, _) in enumerate(sides):
        weighed = weighed.join(thirds.select(F.col("a").alias(a), F.col("b").alias(b), F.col("d").alias(f"d{i}")), [a, b])
    fewest = F.least(*[
        F.struct(F.col(f"d{i}").alias("d"), F.col(a).alias("a"), F.col(b).alias("b")) for i, (a, b, _) in enumerate(sides)
    ])
    outside = (
        weighed.select(*TRIPLE, fewest.alias("f")).select(*TRIPLE, "f.a", "f.b")
        .join(extended, ["a", "b"]).where(~F.col("member").isin(*[F.col(m) for m in TRIPLE])).drop("a", "b")
    )
    for a, b, _ in sides:
        pair = extended.select(F.col("a").alias(a), F.col("b").alias(b), "member")
        outside = outside.join(pair, [a, b, "member"], "left_semi")
    present = links.select("case", "member").distinct()
    met = shared.join(outside, TRIPLE).join(present, ["case", "member"], "left_semi")
    enough = (
        met.groupBy("member", *TRIPLE).agg(F.count("*").alias("n")).where(F.col("n") >= min_cases)
    )
    joined_in = met.join(enough.select("member", *TRIPLE), ["member", *TRIPLE], "left_semi")
    return inside.unionByName(joined_in.select("member", *TRIPLE, "case"))


def gang_report(rows: DataFrame, length: int = 1_000) -> DataFrame:
    """Per member and triple the sorted list of cases as text, on lines of ``length`` cases numbered by ``part`` from 0."""
    cases = F.array_join(F.col("collected").cast("array<string>"), ",").alias("cases")
    return collect_lists(rows, ["member", *TRIPLE], "case", length=length).select(
        "member", F.concat_ws(",", *TRIPLE).alias("triple"), "part", cases
    )
