import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.llm import truncation as T

PLACES = ["Norvale", "Pemstead", "Quillmoor", "Darrowby", "Ferncastle"]
TOPICS = ["the old bridge", "the new timetable", "the village green", "the harbour lights"]
LINES = ["Visitors can leave a note about {t} at the desk in {p}", "The council has published a short report about {t}", "Volunteers collected {n} comments about {t} in {p}", "Readers keep asking us about {t}, and nobody objected"]
FOOT = ["Read more Share this page", "Privacy Terms Contact", "Anna Kern, Darrowby", "- Norvale\n- Pemstead", "Tel. 05485 109529", "https://example.org/a/1"]


def prose(rng, n):
    return " ".join(rng.choice(LINES).format(t=rng.choice(TOPICS), p=rng.choice(PLACES), n=rng.randrange(400)) + "." for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(700):
        text = prose(rng, rng.randrange(2, 6))
        kind = rng.choice(["whole", "whole", "foot", "cut", "mark", "scrap"])
        if kind == "foot":
            text += "\n" + rng.choice(FOOT)
        elif kind == "mark":
            text = text[:-1] + rng.choice(["...", "…", " …"]) if rng.random() < 0.5 else text + rng.choice([" ♦", ")", "”", ""])
        elif kind in ("cut", "scrap"):
            last = text[:-1].rfind(". ") + 2
            # not at the end of a word that a sentence may end with
            cut = last + rng.randrange(12, 24)
            text = text[:cut].rstrip() + ("" if kind == "cut" else rng.choice(["…", "...", "</", "�"]))
        rows.append((i, text, rng.choice(["en", "en-GB", "en", None]), kind))
    return rows


SCHEMA = "doc_id bigint, text string, lang string, state string"


def test_cut_texts_of_a_made_corpus(spark, corpus):
    scored = T.score_endings(spark.createDataFrame(corpus, SCHEMA), "doc_id", "text", "lang").collect()
    found = {r.doc_id for r in scored if r.is_cut}
    truth = {r[0] for r in corpus if r[3] in ("cut", "scrap")}
    assert len(found & truth) / len(truth) > 0.95 and len(found & truth) / len(found) > 0.95


def test_odd_rows(spark, corpus):
    rows = corpus[:200] + [(9001, None, None, "x"), (9002, "", "en", "x"), (9003, "…", "en", "x"), (9004, "x" * 300_000, "en", "x"), (None, "Whole sentence here.", "en", "x"), (9005, "\n\n \t", "en", "x"), (9006, corpus[0][1], "en", "x"), (9006, corpus[0][1], "en", "x")]
    got = [(r.doc_id, r.state, r.is_cut) for r in T.score_endings(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "lang").collect()]
    assert len(got) == len(rows)
    by = {i: (s, c) for i, s, c in got}
    assert by[9001] == by[9002] == by[9005] == ("empty", False) and by[None] == ("whole", False)


def test_empty_table_and_rates(spark, corpus):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.score_endings(empty, "doc_id", "text", "lang").count() == 0
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id bigint, source string")
    scored = spark.createDataFrame([(1, True), (2, False), (3, False)], "doc_id bigint, is_cut boolean")
    assert sorted(map(tuple, T.cut_rates(scored, docs, "doc_id", "source").collect()), key=str) == sorted([("a", 2, 1, 0.5), (None, 1, 0, 0.0)], key=str)


@pytest.mark.parametrize(
    "text,state",
    [("It ended.", "whole"), ("It ended.”", "whole"), ("It ended.) ♦", "whole"), ("It ended!", "whole"), ("It end", "open"), ("It end...", "mark"), ("It end …", "mark"), ("It, ", "comma"), ("It end</", "mark"), ("It end&nbs", "mark"), ("", "empty"), ("wordâ€¦", "mark")],
)
def test_states(text, state):
    assert T.ending(text, len(text))[0] == state


def test_listings():
    assert all(T.is_listing(x, "") for x in ["- Norvale", "© 2020 Norvale", "Norvale 12:30", "Tel. 05 / 12", "A | B | C", "https://a.b/c", "Anna Kern, Darrowby", "..."])
    assert not T.is_listing("Visitors can leave a", "") and not T.is_listing("Nach rÃ©union. Il a dit que", "")


def test_counts_equal_a_plain_count():
    texts = ["abc 12. abd\nabc", "abc. 3.5 abc abd! x", "", "A longer text, with more than fifteen characters. And so on"]
    wanted = np.full(T.LEAST_BITS // 8, 255, np.uint8)
    got = {h: (e, n) for h, e, n in T.count_contexts(texts, wanted).itertuples(index=False)}
    expected = {}
    for t in texts:
        z = "".join("0" if c.isdigit() else c for c in t)
        for i in range(len(t) - 1):
            if t[i].isalnum():
                end = t[i + 1] == "\n" or t[i + 1] in ".!?" and not (i + 2 < len(t) and t[i + 2].isalnum())
                for d in T.DEPTHS:
                    if i + 1 >= d:
                        h = int(T.Hasher(T.codes_of(z[i + 1 - d : i + 1])).at(np.array([d - 1]), d)[0])
                        e, n = expected.get(h, (0, 0))
                        expected[h] = (e + end, n + 1)
    assert all(got[h] == v for h, v in expected.items())


def test_copies_of_a_cut_text_do_not_vouch_for_it(spark, corpus):
    lone = "Visitors can leave a note about the old bridge.\nXanthorpe people have been asking about the harbour li"
    copies = [(8000 + i, lone, "en", "cut") for i in range(12)]
    got = {r.doc_id: r.is_cut for r in T.score_endings(spark.createDataFrame(corpus + copies, SCHEMA), "doc_id", "text", "lang").collect()}
    assert all(got[i] for i, *_ in copies)


def test_line_kinds_take_short_lines_from_inside_texts_and_few_texts_count(spark):
    short = [(f"Norvale {i} lies at the sea.\nVolunteer",) for i in range(9)]
    rows = [*short, ("Read more\nThe end",), ("Read more\nThe end",), ("Contact us\nOne.",), ("Volunteers met.\nVolunteers left.\nVolunteers",), (None,), ("",)]
    got = {r.line_key: r.kind for r in T._line_kinds(spark.createDataFrame(rows, "text string"), spark.createDataFrame([("Volunteer",), ("Volunteers",), ("Read more",), ("Contact us",), ("The end",)], "line_key string")).collect()}
    assert "Volunteer" not in got and "The end" not in got and got["Volunteers"] == 0.0
    assert 4 < got["Read more"] == got["Contact us"] <= T.KIND


def test_blanks_and_marks_behind_a_cut_do_not_hide_it(spark, corpus):
    cut = "Visitors can leave a note about the old bridge at the desk. Volunteers collected 12 comments abo"
    odd = [(5000, cut, "en", ""), (5001, cut + " " * 400, "en", ""), (5002, cut + "\n" * 200, "en", ""), (5003, cut + "." * 170, "en", ""), (5004, cut + "-" * 140, "en", "")]
    got = {r.doc_id: (r.state, r.is_cut) for r in T.score_endings(spark.createDataFrame(corpus + odd, SCHEMA), "doc_id", "text", "lang").collect()}
    assert [got[i] for i in range(5000, 5005)] == [("open", True)] * 3 + [("mark", True)] * 2


def test_sampled_sentences_do_not_vouch_for_themselves(spark, corpus):
    # every text has words of its own, so nothing but itself and its copies says how it goes on
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(30)) + ".", "xq", "whole") for i in range(300)]
    cuts = [(9000 + i, " ".join(word() for _ in range(30)), "xq", "cut") for i in range(100)]
    docs = spark.createDataFrame(rows * 3 + cuts, SCHEMA)
    every = T.score_endings(docs, "doc_id", "text", "lang").select("threshold").distinct().collect()
    # with their own ends counted, whole sentences would seem sure to end, and the threshold would lie far higher
    assert len(every) == 1 and every[0].threshold < -4
    assert T.score_endings(docs, "doc_id", "text", "lang", 50).count() == docs.count()


def test_several_rounds_give_the_same(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA)
    score = lambda **k: sorted(tuple(r) for r in T.score_endings(docs, "doc_id", "text", "lang", **k).select("doc_id", "state", F.round("log_odds", 9), "is_cut").collect())
    assert score() == score(most_bits=1 << 14)


def test_the_table_of_contexts_holds_each(spark):
    hashed = T._with_hashes(spark.createDataFrame([("Norvale lies at",), ("so",), ("x",)], "context string"))
    table = T._wanted(hashed.select("h").distinct(), 1 << 22)
    h = np.array([r.h for r in hashed.collect()])
    bit = (h >> 2) & ((1 << 22) - 1)
    assert ((table[bit >> 3] >> (bit & 7)) & 1).all() and np.unpackbits(table).sum() == len(set(bit.tolist())) == 7
    assert {r.group for r in hashed.where("depth = 3").collect()} <= {r.h for r in hashed.where("depth = 0").collect()}


def test_counts_of_texts_all_different_are_smaller_than_the_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvwz") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))
    texts = [" ".join(word() for _ in range(250)) + "." for _ in range(600)]
    ends = T.hash_contexts([t.rstrip(".")[-15:] for t in texts] + [t[200 : 215 + i % 9] for i, t in enumerate(texts)])
    bits = max(T.LEAST_BITS, 1 << (T.PER_CONTEXT * len(ends) - 1).bit_length())
    table = np.zeros(bits, bool)
    table[(ends["h"].to_numpy() >> 2) & (bits - 1)] = True
    counts = T.count_contexts(texts, np.packbits(table, bitorder="little"))
    assert 24 * len(counts) < sum(map(len, texts))
