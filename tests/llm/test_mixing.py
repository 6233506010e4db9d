import pytest

from talkweave.llm.mixing import mix, rates, reached_shares

DOCS = "doc_id bigint, source string, n bigint, copies string"
TARGETS = "mix_id int, source string, target_share double, max_repeats int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "big", 100 + i % 7, "x") for i in range(6000)] + [(10_000 + i, "small", 50 + i % 5, "x") for i in range(300)] + [(20_000 + i, "unused", 10, "x") for i in range(100)]
    rows += [(30_000, None, 5, "x"), (30_001, "big", 0, "x"), (30_002, "big", None, "x")]
    return spark.createDataFrame(rows, DOCS)


def test_rates_take_the_largest_mix_within_the_caps(spark, docs):
    targets = spark.createDataFrame([(1, "big", 0.8, 1), (1, "small", 0.2, 4), (2, "big", 0.5, 3), (2, "gone", 0.5, 3), (3, "big", 1.0, 2)], TARGETS)
    got = {(r.mix_id, r.source): r.rate for r in rates(docs, "source", "n", targets).collect()}
    small = sum(50 + i % 5 for i in range(300))
    big = sum(100 + i % 7 for i in range(6000))
    assert got[1, "small"] == pytest.approx(4) and got[1, "big"] == pytest.approx(0.8 * 4 * small / 0.2 / big)
    assert got[2, "gone"] == 0 and got[2, "big"] == pytest.approx(3) and got[3, "big"] == pytest.approx(2)


def test_shares_caps_and_whole_copies(spark, docs):
    targets = spark.createDataFrame([(1, "big", 0.9, 2), (1, "small", 0.1, 8)], TARGETS)
    mixed = mix(docs, "doc_id", "source", "n", targets)
    shares = {r.source: r for r in reached_shares(mixed, rates(docs, "source", "n", targets)).collect()}
    assert all(abs(r.actual_share - r.target_share) < 0.01 for r in shares.values())
    for r in shares.values():
        assert r.most_copies <= r.max_repeats
    low, high = min(r.copies for r in mixed.where("source = 'small'").collect()), max(r.copies for r in mixed.where("source = 'small'").collect())
    assert high - low <= 1 and int(shares["small"].rate) == low


def test_same_choice_however_partitioned_and_other_seeds_differ(spark, docs):
    targets = spark.createDataFrame([(1, "big", 0.5, 1), (1, "small", 0.5, 2)], TARGETS)
    one = sorted(map(tuple, mix(docs, "doc_id", "source", "n", targets).collect()))
    two = sorted(map(tuple, mix(docs.repartition(7), "doc_id", "source", "n", targets).collect()))
    other = sorted(map(tuple, mix(docs, "doc_id", "source", "n", targets, seed=1).collect()))
    assert one == two != other


def test_total_and_empty(spark, docs):
    targets = spark.createDataFrame([(1, "big", 1.0, 4)], TARGETS)
    mixed = mix(docs, "doc_id", "source", "n", targets, total_tokens=50_000).selectExpr("sum(copies * n_tokens)").first()[0]
    assert abs(mixed - 50_000) < 5_000
    assert mix(docs.limit(0), "doc_id", "source", "n", targets).count() == 0
    assert mix(docs, "doc_id", "source", "n", targets.limit(0)).count() == 0
