"""Problem 1: a language and a confidence for each text and for each stretch of a mixed text.

Each language has a character model (kneser_ney). Words are scored under all of them; the language of a stretch is the
one with the lowest cross-entropy per character. Where languages change inside a text is found by the best path over
its words, where a change costs more inside a sentence than after a comma, and least after a full stop. A stretch whose
cross-entropy is higher than nearly all held-out text of its language has no known language ('und'); the confidence is
the language's share of the likelihood, with the temperature at which held-out confidences are most truthful.

The models are trained on a bounded sample of the labelled rows and on a short seed text; rows whose text disagrees
with their label are moved or left out between two rounds of training.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.llm.kneser_ney import CharModels
from talkweave.llm.language_data import LABELS, LANGUAGES, SEED

#: Bound of the training sample: at most so many labelled rows of each language, the first by a hash of their keys.
SAMPLE_ROWS = 1200
#: Cost in nats of a change of language before a word: inside a clause, after a comma, after the end of a sentence.
CHANGE = {"word": 14.0, "clause": 9.0, "sentence": 4.0}
#: Fewest words in a sentence or clause that make a language present.
LEAST_WORDS = 4
#: Share of held-out sentences that rejection may cost.
REJECT = 0.0005
UNKNOWN = "und"

_FEW = rf"(?:[^\p{{L}}()\[\]\n]*+[\p{{L}}\p{{M}}'’]++){{0,{LEAST_WORDS - 1}}}+[^\p{{L}}()\[\]\n]*+"
_TOKEN = regex.compile(rf"\[{_FEW}\]|\({_FEW}\)|[\p{{L}}\p{{M}}]+(?:['’][\p{{L}}\p{{M}}]+)*|\p{{N}}+|[.!?…。]+|[,;:–—()\[\]\n]")
_STRIP = regex.compile(r"\p{Mn}+")


def plain(text: str) -> str:
    """Lower case, straight apostrophes."""
    return text.lower().replace("’", "'")


def no_accents(text: str) -> str:
    return _STRIP.sub("", unicodedata.normalize("NFD", text))


@dataclass
class Words:
    """Words of a batch of texts: ``rows`` the text of each word, ``gap`` 0 inside a clause, 1 after a comma, 2 after a sentence."""

    words: list[str]
    rows: np.ndarray
    gap: np.ndarray
    first: np.ndarray
    last: np.ndarray


def split_words(texts) -> Words:
    """Letters make words, digits make words without letters; fewer than LEAST_WORDS words in brackets are no speech."""
    words, rows, gap, first, last = [], [], [], [], []
    for r, text in enumerate(texts):
        if not isinstance(text, str):
            continue
        state = 2
        for m in _TOKEN.finditer(text):
            t = m.group()
            c = t[0]
            if c.isalnum():
                words.append(plain(t) if c.isalpha() else "")
                rows.append(r)
                gap.append(state)
                first.append(m.start())
                last.append(m.end())
                state = 0
            elif c in ".!?…。":
                state = 2
            elif c == "\n":
                state = 2
            else:
                state = max(state, 1)
    return Words(words, np.array(rows, np.int64), np.array(gap, np.int64), np.array(first, np.int64), np.array(last, np.int64))


@dataclass
class LanguageModel:
    """Character models with the temperature of confidences and the highest cross-entropy accepted per language."""

    chars: CharModels
    temperature: float = 1.0
    ceiling: np.ndarray | None = None

    def score(self, words: list[str]) -> np.ndarray:
        """[words, languages] log probabilities; digits count nothing."""
        kinds = {w: i for i, w in enumerate(dict.fromkeys(words))}
        known = self.chars.log_probabilities(list(kinds))
        if "" in kinds:
            known[kinds[""]] = 0.0
        return known[[kinds[w] for w in words]] if words else np.zeros((0, len(self.chars.classes)))

    def paths(self, w: Words, scores: np.ndarray) -> np.ndarray:
        """The language (as an index) of each word, by the best path through each text; all texts step together."""
        n = len(w.words)
        if not n:
            return np.zeros(0, np.int64)
        cost = np.array([CHANGE["word"], CHANGE["clause"], CHANGE["sentence"]])[w.gap]
        rows, begin = np.unique(w.rows, return_index=True)
        length = np.diff(np.append(begin, n))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        came = np.zeros((n, scores.shape[1]), np.int8)
        here = scores[begin].copy()
        own = np.arange(scores.shape[1], dtype=np.int8)
        final = np.zeros((len(rows), scores.shape[1]))
        for t in range(1, int(length[0]) + 1):
            active = int(np.searchsorted(-length, -t, side="left"))
            final[active : len(here)] = here[active:]
            here = here[:active]
            if not active:
                break
            at = begin[:active] + t
            best = here.argmax(1)
            switched = here[np.arange(active), best][:, None] - cost[at][:, None]
            stay = here >= switched
            came[at] = np.where(stay, own, best[:, None].astype(np.int8))
            here = np.where(stay, here, switched) + scores[at]
        path = np.zeros(n, np.int64)
        now = final.argmax(1)
        for t in range(int(length[0]) - 1, -1, -1):
            active = int(np.searchsorted(-length, -t, side="left"))
            at = begin[:active] + t
            path[at] = now[:active]
            now[:active] = came[at, now[:active]]
        return path

    def stretches(self, texts) -> pd.DataFrame:
        """Stretches of one language inside one sentence: row, first, last (characters), words, lang, confidence, run.

        ``run`` numbers the stretches of a text that follow each other in one language without a break by another.
        """
        w = split_words(texts)
        if not w.words:
            return pd.DataFrame({"row": [], "first": [], "last": [], "words": [], "lang": [], "confidence": [], "run": []})
        scores = self.score(w.words)
        path = self.paths(w, scores)
        new_row = np.append(True, w.rows[1:] != w.rows[:-1])
        new_run = new_row | np.append(True, path[1:] != path[:-1])
        new = new_run | (w.gap == 2)
        begin = np.flatnonzero(new)
        total = np.add.reduceat(scores, begin, axis=0)
        size = np.array([len(x) + 1 if x else 0 for x in w.words])
        chars = np.add.reduceat(size, begin)
        count = np.diff(np.append(begin, len(w.words)))
        lang = path[begin]
        own = total[np.arange(len(begin)), lang]
        entropy = -own / np.maximum(chars, 1)
        share = np.exp((total - total.max(1, keepdims=True)) * self.temperature)
        confidence = share[np.arange(len(begin)), lang] / share.sum(1)
        known = (chars > 0) & (entropy <= (self.ceiling[lang] if self.ceiling is not None else np.inf))
        names = np.array(self.chars.classes, dtype=object)[lang]
        names[~known] = UNKNOWN
        return pd.DataFrame(
            {"row": w.rows[begin], "first": w.first[begin], "last": w.last[np.append(begin[1:], len(w.words)) - 1], "words": count, "lang": names, "confidence": np.where(known, confidence, 0.0), "entropy": entropy, "run": np.cumsum(new_run)[begin]}
        )


def _sentences(text: str) -> list[list[str]]:
    w = split_words([text])
    cuts = [*np.flatnonzero(w.gap == 2), len(w.words)]
    return [[x for x in w.words[a:b] if x] for a, b in zip(cuts, cuts[1:])]


def _count(sentences: dict[str, list[list[str]]]) -> dict[str, Counter]:
    """Words of each language, with and without accents, since speech is also written without them."""
    out = {}
    for lang, parts in sentences.items():
        c: Counter = Counter()
        for s in parts:
            c.update(s)
        for word, n in list(c.items()):
            if (bare := no_accents(word)) != word:
                c[bare] += max(1, n // 4)
        out[lang] = c
    return out


def train(labelled: list[tuple[str, str]], languages=LANGUAGES, rounds: int = 2) -> LanguageModel:
    """Models of (language, text) rows, whose labels may be partly wrong, and of the seed text.

    Every fifth row is held out to set the temperature and the ceilings. The same rows give the same model.
    """
    seed = {lang: [s for s in _sentences(SEED[lang]) if s] for lang in languages}
    rows = [(lang, s) for lang, text in labelled if lang in languages for s in _sentences(text) if len(s) >= LEAST_WORDS]
    fit, held = [x for i, x in enumerate(rows) if i % 5], rows[::5]
    model = LanguageModel(CharModels.train(_count(seed)))
    for _ in range(rounds + 1):
        # A sentence goes to the language that the models so far see in it, unless it is close; then it is left out.
        kept = {lang: list(s) for lang, s in seed.items()}
        for (lang, s), best, margin in zip(fit, *_best(model, [s for _, s in fit])):
            if best == lang or margin > 2.0 * len(s):
                kept[best].append(s)
        model = LanguageModel(CharModels.train(_count(kept)))
    best, _ = _best(model, [s for _, s in held])
    trusted = [(lang, s) for (lang, s), b in zip(held, best) if b == lang]
    model.temperature, model.ceiling = _calibrate(model, trusted or [(lang, s) for lang in languages for s in seed[lang]])
    return model


def _totals(model: LanguageModel, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    flat = [w for s in sentences for w in s]
    scores = model.score(flat)
    begin = np.cumsum([0, *[len(s) for s in sentences]])[:-1]
    return np.add.reduceat(scores, begin, axis=0), np.add.reduceat(np.array([len(w) + 1 for w in flat]), begin)


def _best(model: LanguageModel, sentences: list[list[str]]) -> tuple[list[str], np.ndarray]:
    if not sentences:
        return [], np.zeros(0)
    total, _ = _totals(model, sentences)
    ordered = np.sort(total, axis=1)
    return [model.chars.classes[i] for i in total.argmax(1)], ordered[:, -1] - ordered[:, -2]


def _calibrate(model: LanguageModel, held: list[tuple[str, list[str]]]) -> tuple[float, np.ndarray]:
    """Temperature of least log loss over single words of held-out sentences, and each language's ceiling."""
    total, chars = _totals(model, [s for _, s in held])
    truth = np.array([model.chars.classes.index(lang) for lang, _ in held])
    words = np.array([model.chars.classes.index(lang) for lang, s in held for _ in s])
    scores = model.score([w for _, s in held for w in s])
    best, temperature = np.inf, 1.0
    for t in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0):
        z = (scores - scores.max(1, keepdims=True)) * t
        loss = -(z[np.arange(len(words)), words] - np.log(np.exp(z).sum(1))).mean()
        if loss < best:
            best, temperature = loss, t
    entropy = -total[np.arange(len(truth)), truth] / chars
    overall = np.quantile(entropy, 1 - REJECT)
    ceiling = np.array([max(overall, np.quantile(entropy[truth == j], 1 - REJECT)) if (truth == j).any() else overall for j in range(len(model.chars.classes))])
    return temperature, ceiling + 1.0


def label_language(col):
    """The ISO 639-1 code that a label names, in whatever notation; null for null, blank, placeholders and others."""
    names = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    bare = F.lower(F.regexp_replace(F.col(col), r"(?U)^\s+|\s+$", ""))
    return F.coalesce(names[bare], names[F.regexp_extract(bare, r"^(\p{L}+)[-_]", 1)])


def sample_labelled(rows: DataFrame, keys: list[str], text: str, label: str, per_language: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """The bounded training sample: ``per_language`` rows of each language, those with the smallest key hashes.

    The top rows are taken within salted parts first, so no language is sorted as a whole.
    """
    known = rows.select(label_language(label).alias("lang"), F.col(text).alias("text"), F.xxhash64(*keys).alias("h")).where("lang is not null and text is not null")
    inside = Window.partitionBy("lang", F.pmod("h", F.lit(64))).orderBy("h", "text")
    overall = Window.partitionBy("lang").orderBy("h", "text")
    top = known.withColumn("k", F.row_number().over(inside)).where(F.col("k") <= per_language).withColumn("k", F.row_number().over(overall)).where(F.col("k") <= per_language)
    return [(r["lang"], r["text"]) for r in sorted(top.select("lang", "h", "text").collect(), key=lambda r: (r["lang"], r["h"], r["text"]))]


def detect(rows: DataFrame, keys: list[str], text: str, label: str | None = None, model: LanguageModel | None = None) -> DataFrame:
    """Stretches with language and confidence: keys, label language, seq, first, last, n_words, lang, confidence.

    ``first`` and ``last`` are character offsets; a stretch lies in one sentence. Null, empty and wordless texts give
    no rows; repeated rows give repeated stretches; other columns are ignored. ``lang`` is 'und' where rejected.
    """
    if model is None:
        model = train(sample_labelled(rows, keys, text, label))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = [*keys, "label_lang"]
    source = rows.select(*keys, (label_language(label) if label else F.lit(None).cast("string")).alias("label_lang"), F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*columns).schema) + ", seq int, first int, last int, n_words int, lang string, confidence double"

    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 2000):
                part = batch.iloc[a : a + 2000]
                s = shared.value.stretches(part["_text"].tolist())
                if not len(s):
                    continue
                out = part[columns].iloc[s["row"].astype(int)].reset_index(drop=True)
                out["seq"] = s.groupby("row").cumcount().to_numpy()
                out["first"], out["last"], out["n_words"] = s["first"].to_numpy(), s["last"].to_numpy(), s["words"].to_numpy()
                out["lang"], out["confidence"] = s["lang"].to_numpy(), s["confidence"].to_numpy().astype(float)
                yield out

    return source.mapInPandas(run, schema)


def relabelled(rows: DataFrame, stretches: DataFrame, keys: list[str], least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per record of ``rows``: main language by words, its mean confidence and all languages present.

    Records without words (null, blank, marks or remarks only) have language 'und' with confidence 0 and none present.
    """
    there = (F.col("n_words") >= least_words) & (F.col("lang") != UNKNOWN)
    per = stretches.groupBy(*keys, "lang").agg(F.sum("n_words").alias("n"), (F.sum(F.col("confidence") * F.col("n_words")) / F.sum("n_words")).alias("c"), F.max(there).alias("there"))
    every = rows.select(*keys, F.lit(UNKNOWN).alias("lang"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("c"), F.lit(False).alias("there")).distinct()
    main = per.unionByName(every).groupBy(*keys).agg(F.max(F.struct("n", "c", "lang")).alias("m"), F.array_sort(F.collect_set(F.when(F.col("there"), F.col("lang")))).alias("languages"))
    return main.select(*keys, F.col("m.lang").alias("lang"), F.col("m.c").alias("confidence"), "languages")


def wrong_labels(stretches: DataFrame, keys: list[str], least_words: int = LEAST_WORDS) -> DataFrame:
    """(keys, lang) for each language present in a record that holds several, or whose label does not name the one it holds."""
    there = stretches.where((F.col("n_words") >= least_words) & (F.col("lang") != UNKNOWN))
    per = there.groupBy(*keys).agg(F.collect_set("lang").alias("found"), F.collect_set("label_lang").alias("labels"))
    case = (F.size("found") > 1) | (F.size("labels") == 0) | ~F.array_contains("labels", F.element_at("found", 1))
    return per.where(case).select(*keys, F.explode("found").alias("lang"))
