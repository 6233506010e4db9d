from collections import Counter

import numpy as np
import pytest

from talkweave.llm import language as L
from talkweave.llm.kneser_ney import ALPHABET, CharModels
from talkweave.llm.language_data import LANGUAGES, SEED

EN = "We still have to talk about the library before anything else is decided."
DE = "Wir müssen heute noch über die alte Bücherei sprechen, obwohl das Geld noch fehlt."
FR = "Les services ont écrit une longue réponse sur le budget du port."


def test_kneser_ney_equals_a_plain_recursion():
    words = {"a": Counter({"banana": 3, "ban": 2, "nab": 1, "band": 1}), "b": Counter({"xyz": 1})}
    model = CharModels.train(words, order=3)
    grams = {k: Counter() for k in (1, 2, 3)}
    left: dict = {}
    for w, n in words["a"].items():
        t = f"\x02{w}\x03"
        for i in range(1, len(t)):
            for k in (1, 2, 3):
                if i + 1 >= k:
                    g = t[i + 1 - k : i + 1]
                    if k == 3 or i + 1 == k:
                        grams[k][g] += n
                    else:
                        left.setdefault(g, set()).add(t[i - k : i + 1])
    for g, s in left.items():
        grams[len(g)][g] = len(s)

    def p(c, h):
        k = len(h) + 1
        low = 1 / ALPHABET if k == 1 else p(c, h[1:])
        followers = {g: n for g, n in grams[k].items() if g[:-1] == h}
        if not followers:
            return low
        once, twice = (sum(1 for n in grams[k].values() if n == x) for x in (1, 2))
        d = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
        total = sum(followers.values())
        return max(followers.get(h + c, 0) - d, 0) / total + d * len(followers) / total * low

    for w in ("banana", "nab", "zz", "a"):
        t = f"\x02{w}\x03"
        expected = sum(np.log(p(t[i], t[max(0, i - 2) : i])) for i in range(1, len(t)))
        assert model.log_probabilities([w])[0, 0] == pytest.approx(expected, rel=1e-4)


@pytest.fixture(scope="module")
def model():
    return L.train([])


def test_seed_alone_tells_languages(model):
    found = model.stretches([EN, DE, FR])
    assert found.groupby("row").lang.agg(lambda x: "".join(sorted(set(x)))).tolist() == ["en", "de", "fr"]


def test_mixed_text_and_offsets(model):
    text = f"{EN} {FR.lower()[:-1]} {DE}"
    got = [(text[a:b], lang) for a, b, lang in model.stretches([text])[["first", "last", "lang"]].itertuples(index=False)]
    assert [lang for _, lang in got] == ["en", "fr", "de"] and got[0][0] == EN[:-1]


def test_change_inside_unpunctuated_speech(model):
    text = "we still have to talk about the old library before we go home les enfants ne sont pas à l’école parce qu’ils étaient malades"
    assert list(dict.fromkeys(model.stretches([text]).lang)) == ["en", "fr"]


def test_confidence_and_rejection(model):
    assert model.stretches([EN]).confidence[0] > 0.99
    strange = model.stretches(["qxzj vvkqx wwzzq xqjz qqqxz"])
    assert strange.lang[0] == L.UNKNOWN and strange.confidence[0] == 0


def test_held_out_accuracy_with_a_third_of_labels_wrong():
    sentences = [(lang, s) for lang in LANGUAGES for s in SEED[lang].split(". ")]
    rows = [(lang if i % 3 else "en", s) for i, (lang, s) in enumerate(sentences)]
    model = L.train(rows)
    found = model.stretches([s for _, s in sentences])
    main = found.groupby("row").lang.first()
    assert np.mean([main.get(i) == lang for i, (lang, _) in enumerate(sentences)]) > 0.97


SCHEMA = "meeting_id string, pos bigint, text string, language string, seq string, lang string"
CASES = [
    ("m", 1, EN, "en_GB", "x", "y"),  # right
    ("m", 2, EN, None, "x", "y"),
    ("m", 3, DE, " EN", "x", "y"),
    ("m", 4, f"{EN} {FR}", "en", "x", "y"),
    ("m", 5, "Merci beaucoup. " + EN, "English", "x", "y"),  # a greeting is no language present
    ("m", 6, "OK.", None, "x", "y"),
    ("m", 7, None, None, "x", "y"),
    ("m", 8, " [inaudible] (applause) ... ", "de", "x", "y"),
    ("m", 9, (EN + " ") * 3000, "und", "x", "y"),  # very long
    ("m", 2, EN, None, "x", "y"),  # repeated
    (None, None, DE, "", "x", "y"),
]


def test_cases_over_a_table(spark, model):
    df = spark.createDataFrame(CASES, SCHEMA)
    got = L.wrong_labels(L.detect(df, ["meeting_id", "pos"], "text", "language", model), ["meeting_id", "pos"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("m", 2, "en"), ("m", 3, "de"), ("m", 4, "en"), ("m", 4, "fr"), ("m", 9, "en"), (None, None, "de")], key=repr)


def test_empty_table_and_training_from_the_table(spark):
    keys = ["meeting_id", "pos"]
    assert L.detect(spark.createDataFrame([], SCHEMA), keys, "text", "language").count() == 0
    df = spark.createDataFrame(CASES, SCHEMA)
    rows = {(r.meeting_id, r.pos): r for r in L.relabelled(df, L.detect(df, keys, "text", "language"), keys).collect()}
    assert len(rows) == 10 and set(rows) == {(c[0], c[1]) for c in CASES}
    assert rows["m", 4].languages == ["en", "fr"] and rows["m", 4].lang in ("en", "fr") and rows["m", 4].confidence > 0.9
    assert all((rows["m", i].lang, rows["m", i].confidence, rows["m", i].languages) == ("und", 0.0, []) for i in (7, 8)) and rows[None, None].lang == "de"


def test_label_notations(spark):
    labels = ["en_GB", " EN ", "Deutsch", "fra", "pt-BR", "und", "", None, "ja", "auto", "nl_BE", "русский"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "a string").select(L.label_language("a")).collect()]
    assert got == ["en", "en", "de", "fr", "pt", None, None, None, None, None, "nl", "ru"]


def test_clauses_in_brackets_are_scored_and_remarks_are_not():
    words = lambda t: L.split_words([t]).words
    assert words("Yes (applause) and [very loud laughter] no () (12:30)") == ["yes", "and", "no"]
    assert words("Yes (das ist gut so) no") == ["yes", "das", "ist", "gut", "so", "no"]
    assert words("Yes [c'est la vie ici] no") == ["yes", "c'est", "la", "vie", "ici", "no"]
    assert words("Yes (" + "applause " * 3 + " " * 60 + ") no") == ["yes", "no"]
    assert len(words("(" * 50_000 + "yes")) == 1


def test_a_clause_of_six_words_in_brackets_makes_its_language_present(model):
    six = " ".join(DE.rstrip(".").split()[:6])
    for left, right, clause in (("(", ")", six), ("[", "]", six), ("(", ")", DE), ("[", "]", f"{DE} {DE}")):
        s = model.stretches([f"{EN} {left}{clause}{right} {EN}"])
        assert "de" in set(s[s.words >= L.LEAST_WORDS].lang)
