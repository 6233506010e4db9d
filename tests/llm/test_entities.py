import random

import pytest
from pyspark.sql import functions as F

from talkweave.llm.entities import link_names, readings, spread, variant_pairs
from talkweave.llm.graph import components
from talkweave.llm.names import APART, SLIP, WRONG, cost, distance, forms, nearest, read, reductions, slips

ONE = ["Meera Thornquist", "MEERA THORNQUIST", "Thornquist, Meera", "Meera  Thornquist -", "Dr. Meera Thornquist", "meera.thornquist", "MeeraThornquist", "Meera Thornqiust", "Mera Thornquizt", "M. Thornquist", "Meera T.", "Meera Thor…", "thornquistm", "Meera Thornquist (she/her)", "Meera Thornquist's iPad", "Meera K. Thornquist", "Meera Thornquist | Planning", "Thornquist"]
TWO = ["Robert Thornquist", "Bob Thornquist", "Rob Thornquist", "Robbie", "Bob's laptop", "Thornquist Robert"]
ORG = ["Velmoor Heritage Society", "The Velmoor Heritage Society Ltd.", "Heritage Society (Velmoor)", "Velmoor Heritage Soc.", "Velmoor-Heritage-Society", "VHS", "Velmoor Hertiage Society – Room 3", "Heritage Society, Velmoor"]
NOBODY = ["iPhone", "iPhone (2)", "Host", "GUEST", "Meeting Room 2", "Participant 4", "Zoom User", " ", "", "...", "Galaxy Tab", None]
SCHEMA = "m string, n string, entity string, g int"


def linked(spark, names, meeting="m"):
    df = spark.createDataFrame([(meeting, n, "x", 1) for n in names], SCHEMA)
    return {r["n"]: r["entity"] for r in link_names(df, "m", "n").collect()}


def test_spellings_of_two_people_of_one_family_and_an_organisation(spark):
    got = linked(spark, ONE + TWO + ORG + NOBODY + ["Anna Berg"])
    groups = {}
    for n, e in got.items():
        groups.setdefault(e, set()).add(n)
    # the bare surname fits two people and stays alone
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, [set(ONE) - {"Thornquist"}, {"Thornquist"}, set(TWO), set(ORG), {"Anna Berg"}]))


def test_a_shortening_that_fits_several_links_to_none(spark):
    got = linked(spark, ["Edward Vole", "Elizabeth Vole", "E. Vole", "Ted Smart", "Edward Smart", "Theodore Smart"])
    assert len(set(got.values())) == 6


def test_shortenings_without_a_whole_name_link_to_each_other(spark):
    got = linked(spark, ["H. Vandermeer", "h vandermeer", "vandermeerh"])
    assert len(set(got.values())) == 1


def test_meetings_are_apart_and_rows_repeat(spark):
    rows = [("a", "Ann Lee", "x", 1), ("b", "Ann  Lee", "x", 1), ("a", "Ann Lee", "x", 1), (None, "Ann Lee", "x", 1)]
    got = link_names(spark.createDataFrame(rows, SCHEMA), "m", "n")
    assert sorted((r.m, r.n, r.entity) for r in got.collect()) == [("a", "Ann Lee", "Ann Lee"), ("b", "Ann  Lee", "Ann  Lee")]


def test_pairs_and_empty(spark):
    assert link_names(spark.createDataFrame([], SCHEMA), "m", "n").count() == 0
    df = link_names(spark.createDataFrame([("a", x, "", 0) for x in ("Ann Lee", "ann lee", "Lee, Ann")], SCHEMA), "m", "n")
    assert sorted(map(tuple, variant_pairs(df, "m", "n").collect())) == [("a", "Ann Lee", "Lee, Ann"), ("a", "Ann Lee", "ann lee"), ("a", "Lee, Ann", "ann lee")]


def test_very_long_name(spark):
    assert set(linked(spark, ["Ann Lee " + "x" * 400, "word " * 3000])) == {"Ann Lee " + "x" * 400, "word " * 3000}


PEOPLE = ["Peter Hansen / Peter Jensen", "Anna Schmidt / Anna Schmitz", "John Martin / John Merlin", "Laura Becker / Laura Beckett", "David Wilson / David Nelson", "Anna Keller / Anna Kessler", "Carla Bianchi / Carlo Bianchi", "Maria Fischer / Maria Fiedler", "Peter Johansen / Peter Johanson", "Lars Petersen / Lars Pedersen", "Anna Meyer / Anna Meier", "Julia Weber / Julian Weber", "Marta Braun / Maria Braun", "Daniel Roth / Daniela Roth", "Erik Andersen / Erik Anderson"]


def test_like_names_of_different_people_stay_apart(spark):
    rows = [(str(i), n, "x", 1) for i, pair in enumerate(PEOPLE) for n in pair.split(" / ")]
    got = link_names(spark.createDataFrame(rows, SCHEMA), "m", "n").collect()
    assert len(got) == 2 * len(PEOPLE) and all(r["n"] == r["entity"] and r["score"] == 3.0 for r in got)


def test_a_rare_variant_links_to_a_frequent_name_only(spark):
    rows = [("a", "Erik Andersen", "x", 1)] * 20 + [("a", "Erik Anderson", "x", 1)] + [("b", "Erik Andersen", "x", 1)] * 20 + [("b", "Erik Anderson", "x", 1)] * 20
    got = {(r["m"], r["n"]): (r["entity"], r["score"]) for r in link_names(spark.createDataFrame(rows, SCHEMA), "m", "n").collect()}
    assert got["a", "Erik Anderson"][0] == "Erik Andersen" and 0 <= got["a", "Erik Anderson"][1] < 3 and got["b", "Erik Anderson"] == ("Erik Anderson", 3.0)


def test_an_initial_goes_to_the_surname_it_names(spark):
    got = linked(spark, ["Peter Hansen", "Paul Hanson", "P. Hansen", "J. Kessler", "Jon Keller", "P. Hnson"])
    assert got["P. Hansen"] == got["Peter Hansen"] != got["Paul Hanson"] and got["J. Kessler"] != got["Jon Keller"] and len({got["P. Hnson"], got["Peter Hansen"], got["Paul Hanson"]}) == 2


def test_candidates_within_two_errors_always_share_a_near_form():
    rng = random.Random(5)
    true = "Ariadne Pellbrockstone"
    for k in range(300):
        words = true.split()
        for _ in range(2):
            i = rng.randrange(2)
            w, p = words[i], rng.randrange(1, len(words[i]) - 1)
            words[i] = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("aezx") + w[p + 1 :], w[:p] + w[p] + w[p:], w[:p] + w[p + 1] + w[p] + w[p + 2 :]])
        a, b = read(" ".join(words)), read(true)
        if cost(a, b) < APART and distance(a.given, b.given) < 2 and distance(a.last, b.last) < 3 and distance(a.given, b.given) + distance(a.last, b.last) < 3:
            assert forms(a, "m").near & forms(b, "m").near, words
        assert not forms(a, "m").near & forms(b, "n").near
    long = "k" + "abcdefgh" * 12 + "z"
    for other in (long[:50] + long[51:], long[:3] + "q" + long[3:], long[:90] + "b" + long[91:]):
        x, y = read("Ann " + long), read("Ann " + other)
        assert forms(x, "m").near & forms(y, "m").near and cost(x, y) <= WRONG


def test_names_are_read_in_as_many_tasks_as_cores(spark):
    rows = spark.range(400).selectExpr("'m' as g", "concat('Ann Lee', id) as name").groupBy("g", "name").agg(F.count("*").alias("n"))
    sizes = readings(spread(rows, "g", "name")).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == 400


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    expected = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == expected
