"""Behaviour of the stages on small literal inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from talkweave.functions import ocr
from talkweave.functions import text as X
from talkweave.operators.aggregate import majority_first, one_name_per_key, weighted_share_argmax
from talkweave.operators.blocks import running_count, with_neighbour
from talkweave.operators.cluster import canonical_names, leaders
from talkweave.operators.interval import _in_buckets, asof_backward, best_overlap, overlap_join
from talkweave.operators.sequence import capped_runs, keyframes, next_start, value_keyframes
from talkweave.plans import fusion, naming, speech


def rows(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)


def ms(*spans):
    return [tuple(round(v * 1000) if isinstance(v, float) else v for v in s) for s in spans]


UNITS = "meeting_id string, pos bigint, unit int, start_ms bigint, end_ms bigint, text string, language string"
TURNS = "meeting_id string, pos bigint, start_ms bigint, end_ms bigint, speaker_id string"
EVENTS = "meeting_id string, pos bigint, start_ms bigint, end_ms bigint, display_name string, confidence double"
FRAMES = "meeting_id string, pos bigint, start_ms bigint, end_ms bigint, display_name string, source string, confidence double"


def test_words_to_turns(spark):
    units = spark.createDataFrame(ms(("m", 0, 0, 0.0, 0.4, "a", "fr"), ("m", 0, 1, 0.4, 0.9, "b", "en"), ("m", 0, 2, 0.9, 1.3, "edge", None), ("m", 0, 3, 1.0, 1.0, "zero", "en"), ("m", 0, 4, 9.0, 9.2, "lost", "en")), UNITS)
    turns = spark.createDataFrame(ms(("m", 0, 0.0, 1.0, "Speaker_00"), ("m", 1, 1.0, 2.0, "Speaker_01"), ("m", 2, 20.0, 21.0, "Speaker_02")), TURNS)
    got = rows(speech.utterances(units, turns), "speaker_id", "text", "language")
    assert got == [("Speaker_00", "a b zero", "en"), ("Speaker_01", "edge", None)]
    assert speech.utterances(units, turns.limit(0)).count() == 0


def test_units_take_words_or_the_whole_text(spark):
    schema = "meeting_id string, pos bigint, start double, end double, text string, words array<struct<start:double,end:double,text:string,probability:double>>, language string"
    d = spark.createDataFrame([("m", 0, 0.0, 1.0, "x y", [(0.0, 0.5, "x", 1.0), (0.5, 1.0, "y", 1.0)], "en"), ("m", 1, 1.0, 2.0, "whole", [], "en"), ("m", 2, 2.0, 3.0, "", None, "en")], schema)
    assert rows(speech.units(d), "pos", "unit", "text") == [(0, 0, "x"), (0, 1, "y"), (1, 0, "whole")]


def brute_best(units, turns):
    out = []
    for k, i, s, e in units:
        mine = sorted([t for t in turns if t[0] == k], key=lambda t: (t[2], t[1]))
        best, most = None, 0
        for t in mine:
            o = min(e, t[3]) - max(s, t[2])
            if o > most:
                best, most = t[1], o
        if best is None:
            best = next((t[1] for t in mine if 2 * t[2] <= s + e <= 2 * t[3]), None)
        out.append((k, i, best, most))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_best_overlap_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    span = lambda: (lambda s: (s, s + rng.choice([0, 0, 5, 30, 200])))(rng.randrange(600))
    units = [(rng.choice("ab"), i, *span()) for i in range(150)]
    turns = [(rng.choice("ab"), i, *span()) for i in range(60)]
    got = best_overlap(spark.createDataFrame(units, "k string, i bigint, s bigint, e bigint"), spark.createDataFrame(turns, "k string, t bigint, ts bigint, te bigint"), "k", ["i"], ("s", "e"), "t", ("ts", "te"), width=40)
    assert sorted((r.k, r.i, r.t, r.overlap_ms) for r in got.collect()) == brute_best(units, turns)


@pytest.mark.parametrize("seed", range(2))
def test_scans_over_blocks_equal_plain_ones(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab"), rng.randrange(300), p, rng.randrange(50)) for p in range(200)]
    df = spark.createDataFrame(data, "k string, t bigint, p bigint, v bigint")
    for later in (False, True):
        got = {r.p: r.n and r.n.v for r in with_neighbour(df, ["k"], "t", ["p"], ["v"], "n", later, 20, 3).collect()}
        for k in "ab":
            mine = sorted([d for d in data if d[0] == k], key=lambda d: (d[1], d[2]), reverse=later)
            assert all(got[b[2]] == (a[3] if a else None) for a, b in zip([None, *mine], mine))
    counted = {r.p: r.c for r in running_count(df.withColumn("f", F.col("v") > 20), ["k"], "t", ["p"], "f", "c", 20, 3).collect()}
    right = spark.createDataFrame([(rng.choice("ab"), rng.randrange(300), i) for i in range(80)], "k string, u bigint, i bigint")
    right_rows = [tuple(r) for r in right.collect()]
    active = {r.p: r.a and r.a.i for r in asof_backward(df, right, "k", "t", "u", ["i"], ["i"], "a", 20, 3).collect()}
    for k, t, p, _ in data:
        assert counted[p] == sum(d[3] > 20 for d in data if d[0] == k and (d[1], d[2]) <= (t, p))
        before = [(u, i) for kk, u, i in right_rows if kk == k and u <= t]
        assert active[p] == (max(before)[1] if before else None)


def test_asof_keeps_left_rows_with_nulls(spark):
    left = spark.createDataFrame([("a", None, 1), (None, 5, 2), ("z", 5, 3)], "k string, t bigint, p int")
    right = spark.createDataFrame([("a", 1, 7), (None, 1, 8)], "k string, u bigint, i int")
    assert rows(asof_backward(left, right, "k", "t", "u", ["i"], ["i"]), "p", "active") == [(1, None), (2, None), (3, None)]


@pytest.mark.parametrize("cap,n", [(5, 4), (6, 2), (120, 1)])
def test_capped_runs(spark, cap, n):
    u = [("m", i, "Speaker_00", i * 3000, i * 3000 + 3000, f"t{i}", "en") for i in range(4)]
    d = spark.createDataFrame(u, "meeting_id string, pos bigint, speaker_id string, start_ms bigint, end_ms bigint, text string, language string")
    assert speech.transcript(d, cap * 1000).count() == n


def test_runs_of_other_speakers_long_ones_and_a_long_monologue(spark):
    schema = "meeting_id string, pos bigint, speaker_id string, start_ms bigint, end_ms bigint, text string, language string"
    aba = spark.createDataFrame([("m", 0, "A", 0, 100_000, "x", "fr"), ("m", 1, "B", 100_000, 101_000, "", None), ("m", 2, "A", 101_000, 102_000, "y", "en"), ("m", 3, "A", 102_000, 103_000, None, "en")], schema)
    got = rows(speech.transcript(aba, 10_000), "start_ms", "end_ms", "speaker_id", "text", "language")
    assert got == [(0, 100_000, "A", "x", "fr"), (100_000, 101_000, "B", "", None), (101_000, 103_000, "A", "y", "en")]
    long = spark.createDataFrame([("m", i, "A", i * 10_000, i * 10_000 + 10_000, "w", "en") for i in range(80)], schema)
    spans = [r.end_ms - r.start_ms for r in speech.transcript(long).collect()]
    assert len(spans) > 1 and max(spans) <= 120_000 and sum(spans) == 800_000
    assert capped_runs(long.limit(0), "meeting_id", "start_ms", "pos", "speaker_id", "start_ms", "end_ms", 5).count() == 0


def test_fusion(spark):
    t = spark.createDataFrame([("m", 0, 0, 10_000, "S0", "hi", "en"), ("m", 1, 500, 900, "S1", "yo", None)], "meeting_id string, pos bigint, start_ms bigint, end_ms bigint, speaker_id string, text string, language string")
    f = spark.createDataFrame([("m", 0, 1000, "A", "a\nb"), ("m", 1, 6000, "B", ""), ("m", 2, 6000, "B2", "x")], "meeting_id string, pos bigint, start_ms bigint, title string, raw_text string")
    names = spark.createDataFrame([("m", "S0", "Ana")], "meeting_id string, speaker_id string, name string")
    got = {r.pos: r for r in fusion.timeline(t, f, names).collect()}
    assert got[0].slide.title == "B2" and got[0].slide.ocr_text == ["x"] and got[0].speaker == "Ana" and got[1].slide is None and got[1].speaker == "S1"
    assert {r.speaker for r in fusion.timeline(t, f).collect()} == {"S0", "S1"}


def test_visual_events(spark):
    border, badge = "active_speaker_border", "presentation_badge"
    data = [("m", 0, 0, 1000, "Ana", border, 1.0), ("m", 1, 1000, 2000, "Ana", "layout_heuristic", 1.0), ("m", 2, 2000, 3000, "Ana", border, None), ("m", 3, 3000, None, "Ana", border, 0.5), ("m", 4, 5000, 6000, "Ana", badge, 0.5), ("m", 5, 6000, 7000, "", badge, 0.5)]
    got = rows(naming.visual_events(spark.createDataFrame(data, FRAMES)), "start_ms", "end_ms", "signal", "layout", "confidence", "n_frames")
    assert got == [(0, 1000, border, "gallery_view", 0.822, 1), (2000, 4000, border, "gallery_view", 0.513, 2), (5000, 6000, badge, "shared_screen", 0.512, 1)]
    five = spark.createDataFrame([("m", i, i * 1000, i * 1000 + 1000, "A", border, 1.0) for i in range(5)], FRAMES)
    assert rows(naming.visual_events(five), "confidence", "n_frames") == [(0.955, 5)]


def test_speaker_names(spark):
    turns = spark.createDataFrame(ms(("m", 0, 0.0, 9.0, "S0"), ("m", 1, 9.0, 10.0, "S1"), ("m", 2, 20.0, 30.0, "S2")), TURNS)
    one = spark.createDataFrame([("m", 0, 0, 10_000, "Ana Lima", 0.9)], EVENTS)
    assert rows(naming.speaker_names(turns, one), "speaker_id", "name") == [("S0", "Ana Lima"), ("S1", "Unknown"), ("S2", "Unknown")]
    half = spark.createDataFrame([("m", 0, 0, 9000, "S0"), ("m", 1, 0, 9000, "S1")], TURNS)
    assert {r.name for r in naming.speaker_names(half, one).collect()} == {"Unknown"}
    assert {r.name for r in naming.speaker_names(turns, one.limit(0)).collect()} == {"Unknown"}


def test_one_name_per_speaker_by_weight(spark):
    e = spark.createDataFrame([("m", "A", "S0", 2.7, 1), ("m", "A", "S1", 0.3, 2), ("m", "B", "S0", 1.0, 0), ("m", "C", "S2", 0.0, 5)], "g string, name string, key string, w double, first bigint")
    best = weighted_share_argmax(e, ["g"], "name", "key", "w", "first", 0.6)
    assert rows(one_name_per_key(best, ["g"], "key", "best_weight", "first"), "key", "name") == [("S0", "A")]


def test_clusters():
    assert leaders(["Ana Lima", "Ana Rios", "Ana Lios"], 0.65)["Ana Lios"] in ("Ana Lima", "Ana Rios")
    assert leaders(["Maria Alvarez", "Marla Alvarez", "Bo Chen"], 0.65) == {"Maria Alvarez": "Maria Alvarez", "Marla Alvarez": "Maria Alvarez", "Bo Chen": "Bo Chen"}


@pytest.mark.parametrize("most", [3, 512])
def test_clusters_equal_a_plain_walk_whatever_the_rounds(spark, most):
    from difflib import SequenceMatcher

    rng = random.Random(7)
    base = ["ana lima", "bo chen", "carl otto", "dina fuchs", "eva king", "Ana Rios", "bob king", "İda Öz", ""]
    rows = []
    for i in range(140):
        n = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            n.insert(rng.randrange(len(n) + 1), rng.choice("abcxyz "))
        rows.append((rng.choice("ab"), "".join(n), rng.randrange(1, 50) / 8, i))
    got = {(r.g, r.n): r.canonical for r in canonical_names(spark.createDataFrame(rows, "g string, n string, w double, p bigint"), "g", "n", "w", "p", 0.7, most).collect()}
    for g in "ab":
        totals = {}
        for _, n, w, p in [r for r in rows if r[0] == g]:
            a, b = totals.get(n, (0.0, p))
            totals[n] = (a + w, min(b, p))
        found = []
        for n in sorted(totals, key=lambda n: (-totals[n][0], totals[n][1])):
            scored = [(SequenceMatcher(None, n.casefold(), x.casefold()).ratio(), -k) for k, x in enumerate(found)]
            best = max(scored, default=(-1, 0))
            if best[0] >= 0.7:
                assert got[g, n] == found[-best[1]], n
            else:
                found.append(n)
                assert got[g, n] == n
    assert len(got) == len({(r[0], r[1]) for r in rows})


def test_the_name_with_most_confidence_in_total_leads(spark):
    e = spark.createDataFrame([("m", 0, 0, 1, "Marla Alvarez", 0.6), ("m", 1, 0, 1, "Maria Alvarez", 0.4), ("m", 2, 0, 1, "Maria Alvarez", 0.4), ("m", 3, 0, 1, None, 0.4)], EVENTS)
    assert {r.canonical for r in canonical_names(e, "meeting_id", "display_name", "confidence", "pos").collect()} == {"Maria Alvarez"}


def test_vote(spark):
    d = spark.createDataFrame([("m", "fr", 0), ("m", "en", 1), ("m", "en", 2), ("n", "de", 3), ("n", "it", 1), ("o", None, 0), ("o", "", 1)], "g string, v string, p int")
    assert rows(majority_first(d, ["g"], "v", ["p"], "v2"), "g", "v2") == [("m", "en"), ("n", "it"), ("o", None)]


def test_overlap_join_touching(spark):
    a = spark.createDataFrame([("k", 0, 10)], "k string, s bigint, e bigint")
    b = spark.createDataFrame([("k", 10, 20), ("k", 5, 500)], "k string, s2 bigint, e2 bigint")
    assert overlap_join(a, b, "k", ("s", "e"), ("s2", "e2"), width=7).count() == 1
    assert overlap_join(a, b, "k", ("s", "e"), ("s2", "e2"), touching=True, width=7).count() == 2


def test_overlap_join_equals_brute_force_at_all_lengths_and_copies_little(spark):
    rng = random.Random(9)
    lengths = [0, 1, 50, 2000, 70_000, 3_000_000, 200_000_000, 10**12]
    make = lambda n: [(rng.choice("ab"), i, s, s + rng.choice(lengths)) for i in range(n) for s in [rng.randrange(4_000_000)]]
    left, right = make(120), make(90) + [("a", 500, -(10**11), 10**12)]
    a, b = spark.createDataFrame(left, "k string, i bigint, s bigint, e bigint"), spark.createDataFrame(right, "k string, j bigint, s2 bigint, e2 bigint")
    for touching in (False, True):
        got = sorted((r.i, r.j) for r in overlap_join(a, b, "k", ("s", "e"), ("s2", "e2"), touching).collect())
        meets = lambda x, y: (x[2] <= y[3] and y[2] <= x[3]) if touching else (x[2] < y[3] and y[2] < x[3])
        assert got == sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and meets(x, y))
    copies = _in_buckets(b, "s2", "e2", 60_000, b.select(F.array(*[F.lit(k) for k in range(8)])).limit(1)).groupBy("j").count().agg(F.max("count")).first()[0]
    assert copies <= 16 and overlap_join(a, b.limit(0), "k", ("s", "e"), ("s2", "e2")).count() == 0


PAGE = f"page array<{ocr.LINE}>"


def page(spark, *texts, height=None):
    return spark.createDataFrame([([(t, 0.9, 0.0, float(i), 1.0, float((height or [16] * len(texts))[i])) for i, t in enumerate(texts)],)], PAGE)


def test_title_content_and_layout_name(spark):
    d = page(spark, "Dr. Ana Lima", "Quarter Results", "1. first point", "this line has so many words that it is prose", height=[16, 40, 16, 16])
    r = d.select(ocr.title_index(F.col("page")), ocr.layout_name_index(F.col("page")).alias("n"), ocr.content(F.col("page"), ocr.layout_name_index(F.col("page"))).alias("c")).first()
    assert r[0] == 1 and r.n == 0 and r.c.title == "Quarter Results" and r.c.bullet_points == ["first point"] and len(r.c.paragraphs) == 1 and r.c.raw_text.count("\n") == 3
    none = spark.createDataFrame([([],)], PAGE).select(ocr.content(F.col("page"), F.lit(None).cast("int")).alias("c")).first().c
    assert none.title is None and none.bullet_points == [] and none.raw_text == ""


def test_name_shapes(spark):
    good, bad = ["Ana Lima", "Dr. Ana Lima", "Ana M. Lima", "Ana Lima Rios", "  Ana Lima "], ["ana lima", "Ana", "Ana Lima Rios Diaz Paz", "Q1 Results", "", "ANA LIMA"]
    d = spark.createDataFrame([(x,) for x in good + bad], "t string").select("t", X.is_name_shaped(F.col("t")).alias("y"))
    assert {r.t for r in d.collect() if r.y} == set(good)


def test_prompt_lines_and_ids(spark):
    d = spark.createDataFrame([(["Q1", "Q1", "  ", "Rev", None],), ([],)], "h array<string>")
    assert [r[0] for r in d.select(X.prompt(F.col("h"))).collect()] == ["Q1, Rev", None]
    texts = ["", "a\nb\n", "a\r\nb\rc\x0bd\x1ee f\n\n", "\n"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(X.lines(F.col("t"))).collect()]
    assert got == [t.splitlines() for t in texts]
    r = spark.createDataFrame([(1.85, 6.73)], "s double, e double").select(X.segment_id(F.col("s"), F.col("e")), X.slide_id(F.col("s")), X.round3_exact(F.col("s"))).first()
    assert tuple(r) == ("seg_000185-000673", "slide_000185", 1.85)


FRAME = f"meeting_id string, pos bigint, start_ms bigint, frame_path string, page array<{ocr.LINE}>, fallback array<string>, border_name string, border_confidence double, badge_name string, badge_confidence double, vision_name string"


def test_slides(spark):
    line = lambda t, c=0.9: (t, c, 0.0, 0.0, 1.0, 1.0)
    data = [
        ("m", 0, 0, "f0", [line("Title"), line("Ana Lima")], None, "Bo Chen", 0.8, "Cy Day", 0.7, None),
        ("m", 1, 1000, "f1", [], None, "Bo Chen", 0.8, None, None, None),
        ("m", 2, 2000, "f2", [], None, None, None, None, None, None),
        ("m", 3, 3000, "f3", [line("low", 0.2)], None, None, None, None, None, None),
        ("m", 4, 4000, "f4", [line("low", 0.2)], ["Agenda", "Ana Lima"], None, None, None, None, None),
        ("m", 5, 5000, "f5", [line("low", 0.2)], [], None, None, None, None, None),
        ("m", 6, 6000, "f6", [line("text")], None, None, None, "Cy Day", 0.7, "Di Eco"),
        ("m", 7, 7000, "f7", [line("text")], None, None, None, None, None, "Di Eco"),
    ]
    got = {r.pos: r for r in fusion.slides(spark.createDataFrame(data, FRAME)).collect()}
    assert sorted(got) == [0, 1, 3, 4, 6, 7]
    assert got[0].display_name == "Bo Chen" and got[0].content.bullet_points == ["Ana Lima"] and got[0].end_ms == 1000
    assert got[1].content.raw_text == "" and got[1].ocr_confidence is None and got[1].end_ms == 3000
    assert got[3].content.title == "low"
    assert got[4].display_name_source == "layout_heuristic" and got[4].content.bullet_points == [] and got[4].ocr_confidence == 0.2
    assert got[6].display_name_source == "presentation_badge" and got[7].display_name_source == "gpt4o_vision" and got[7].detection_confidence is None and got[7].end_ms is None


def test_page_lines_boxes_and_crop_name(spark):
    schema = "t array<string>, s array<double>, b array<array<double>>, p array<array<array<double>>>"
    d = spark.createDataFrame([(["a", " ", "b "], [0.9, 0.8, 0.7], [[1.0, 2.0, 4.0, 8.0]], None), (["x", "y"], [0.5], None, [[[0.0, 1.0], [3.0, 1.0], [3.0, 5.0], [0.0, 5.0]]])], schema)
    got = [[tuple(x) for x in r[0]] for r in d.select(ocr.page_lines(*[F.col(c) for c in "tsbp"])).collect()]
    assert got == [[("a", 0.9, 1.0, 2.0, 3.0, 6.0), ("b", 0.7, 0.0, 2.0, 0.0, 1.0)], [("x", 0.5, 0.0, 1.0, 3.0, 4.0)]]
    assert page(spark, "4", "Ana").select(ocr.crop_name(F.col("page"))).first()[0] == "Ana" and page(spark, "4", "12").select(ocr.crop_name(F.col("page"))).first()[0] is None


def test_vision_answers_words_and_geometry(spark):
    d = spark.createDataFrame([(" Ana ",), ("none",), ("42",), ("  ",), (None,)], "t string")
    assert [r[0] for r in d.select(X.vision_answer(F.col("t"))).collect()] == ["Ana", None, None, None, None]
    w = spark.createDataFrame([([(0.0, 0.25, "x", 0.5)], 0.5)], "w array<struct<start:double,end:double,text:string,probability:double>>, o double")
    assert w.select(X.shift_words(F.col("w"), F.col("o"))).first()[0][0].start == 0.5
    assert w.select(X.overlap(F.lit(0), F.lit(5), F.lit(5), F.lit(9))).first()[0] == 0


def test_frames_end_with_the_next_and_keyframes(spark):
    f = spark.createDataFrame([("m", 0, 5), ("m", 1, 0), ("n", 0, 7)], "meeting_id string, pos bigint, start_ms bigint")
    assert rows(next_start(f, "meeting_id", "start_ms", "pos"), "meeting_id", "start_ms", "end_ms") == [("m", 0, 5), ("m", 5, None), ("n", 7, None)]
    flat = lambda v: [v] * 36
    corner = [255 if i % 6 < 2 and i // 6 < 2 else 0 for i in range(36)]
    k = spark.createDataFrame([("m", 0, flat(0)), ("m", 1, flat(10)), ("m", 2, flat(20)), ("m", 3, flat(0)), ("m", 4, corner), ("n", 0, flat(9))], "g string, i int, p array<int>")
    # 20 differs from the last kept (0) by .078; back at 0 it differs from 20; one changed corner counts by region
    assert rows(keyframes(k, "g", "i", "p", 6, 6, 0.06), "g", "i") == [("m", 0), ("m", 2), ("m", 3), ("m", 4), ("n", 0)]


@pytest.mark.parametrize("seed", range(2))
def test_capped_runs_over_blocks_equal_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    data, t = [], 0
    for i in range(260):
        t += rng.choice([0, 1, 3, 8, 40, 300])
        data.append(("m" if i % 3 else "n", t, i, rng.choice("AAAAAAAB"), t, t + rng.choice([0, 2, 9, 30])))
    got = {r.i: (r.island, r.run) for r in capped_runs(spark.createDataFrame(data, "k string, t bigint, i bigint, sp string, s bigint, e bigint"), "k", "t", "i", "sp", "s", "e", 25, block_ms=26).collect()}
    assert len(got) == len(data)
    for k in "mn":
        who, opened, run = None, 0, 0
        for _, _, i, sp, s, e in sorted(x for x in data if x[0] == k):
            if sp != who:
                who, opened, run = sp, s, 0
            elif e - opened > 25:
                opened, run = s, run + 1
            assert got[i][1] == run, i


@pytest.mark.parametrize("seed", range(2))
def test_keyframes_over_blocks_equal_a_plain_fold(spark, seed):
    rng = random.Random(seed)
    data, v = [], 0.0
    for i in range(300):
        v += rng.choice([0, 0, 0, 0.04, -0.03, 0.2]) if not 100 < i < 200 else 0
        data.append((rng.choice("ab"), i * 10, i, v))
    expected = []
    for k in "ab":
        last = None
        for _, _, i, v in [x for x in data if x[0] == k]:
            if last is None or abs(v - last) > 0.1:
                expected.append(i)
                last = v
    df = spark.createDataFrame(data, "k string, t bigint, i bigint, v double")
    assert sorted(r.i for r in value_keyframes(df, "k", "t", "i", "v", 0.1, block_ms=170).collect()) == sorted(expected)
    assert value_keyframes(df.limit(0), "k", "t", "i", "v", 0.1).count() == 0
    picture = df.select("k", "i", F.array_repeat((F.col("v") * 100).cast("int"), 36).alias("p"))
    assert {(r.k, r.i) for r in keyframes(picture, "k", "i", "p", 6, 6, 0.03, block=16).collect()} == {(r.k, r.i) for r in keyframes(picture, "k", "i", "p", 6, 6, 0.03, block=10_000).collect()}


def test_quotes(spark):
    t = spark.createDataFrame([("m", "We met, and talked."), ("m", None)], "meeting_id string, text string")
    q = spark.createDataFrame([("m", 1, "We met and"), ("m", 2, "we met"), ("m", 3, "et, and"), ("m", 4, ""), ("n", 5, "We met")], "meeting_id string, quote_id int, quote string")
    assert rows(fusion.unsupported_quotes(q, t), "quote_id") == [(2,), (3,), (4,), (5,)]


def test_json_round_trip(spark, tmp_path):
    from talkweave.sources import artifacts as A

    folder = tmp_path / "meet one"
    turns = spark.createDataFrame([("x", 1, 1.0, 2.0, "S1"), ("x", 0, 0.0, 1.0, "S0")], "meeting_id string, pos bigint, start double, end double, speaker_id string")
    A.write_artifact(turns, "speaker_turns", str(folder / "speaker_turns.json"))
    assert json.load(open(folder / "speaker_turns.json")) == [{"start": 0.0, "end": 1.0, "speaker_id": "S0"}, {"start": 1.0, "end": 2.0, "speaker_id": "S1"}]
    back = A.read_artifact(spark, "speaker_turns", str(folder / "speaker_turns.json"))
    assert rows(back, "meeting_id", "pos", "speaker_id") == [("meet one", 0, "S0"), ("meet one", 1, "S1")]
    names = spark.createDataFrame([("S0", "Ana")], "speaker_id string, name string")
    A.write_artifact(names, "speaker_names", str(folder / "speaker_name_map.json"))
    assert rows(A.read_artifact(spark, "speaker_names", str(folder / "speaker_name_map.json")), "speaker_id", "name") == [("S0", "Ana")]
    seg = spark.createDataFrame([(0, 0.0, 1.0, "S0", "hi", None)], "pos bigint, start_s double, end_s double, speaker_id string, text string, language string")
    A.write_artifact(seg, "transcript", str(folder / "transcript.json"))
    assert json.load(open(folder / "transcript.json")) == {"segments": [{"start_s": 0.0, "end_s": 1.0, "speaker_id": "S0", "text": "hi", "language": None}]}
    assert rows(A.read_artifact(spark, "transcript", str(folder / "transcript.json")), "pos", "text") == [(0, "hi")]
    assert A.read_artifact(spark, "frames", str(folder / "none.json"), optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        A.read_artifact(spark, "frames", str(folder / "none.json"))
    (folder / "bad.json").write_text('[{"start": 1.0}]')
    with pytest.raises(Exception, match="lacks one of"):
        A.checked(A.read_artifact(spark, "speaker_turns", str(folder / "bad.json")), "speaker_turns").collect()


def test_tables_skip_or_replace_meetings(spark, tmp_path):
    from talkweave.sources import artifacts as A

    path = str(tmp_path / "t")
    make = lambda v, *ms_: spark.createDataFrame([(m, v) for m in ms_], "meeting_id string, v int")
    A.write_table(make(1, "a", "b"), path)
    A.write_table(make(2, "b", "c"), path, overwrite_meetings=False)
    assert rows(spark.read.parquet(path), "meeting_id", "v") == [("a", 1), ("b", 1), ("c", 2)]
    A.write_table(make(3, "b"), path)
    assert rows(spark.read.parquet(path), "meeting_id", "v") == [("a", 1), ("b", 3), ("c", 2)]
