"""Problem 8: texts cut off by a field limit or a broken transfer.

A backward character model tells how likely a text may end where it does: for the characters before the end, read
backwards to several depths, it holds how often the whole corpus goes on there and how often a sentence or a line ends.
The log-odds of ending against going on, interpolated from the shallow to the deep contexts, are held against a
threshold for the language, fitted on sentences that are known to be whole and on the same sentences cut at random.

Counts are taken over every position of every text. Only contexts that some text ends in, or that a sample of whole
sentences holds, are counted: a bit table with eight bits for each of them tells which those may be. It is broadcast up
to MOST_BITS; contexts beyond it are counted in further rounds, each with a table of its own. The counts are joined to
the contexts by hash.
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.runtime import cut as checkpoint

#: Depths of contexts in characters.
DEPTHS = (2, 4, 6, 8, 11, 15)
#: Weight of the shallower context against the counts of a deeper one.
WEIGHT = 3.0
#: Bits of the table of wanted contexts for each of them, at least (512 KB) and at most (128 MB) in one round, and in one
#: part of the table.
PER_CONTEXT, LEAST_BITS, MOST_BITS, PART_BITS = 8, 1 << 22, 1 << 30, 1 << 20
#: Contexts of at most so many characters are those of many texts; their joins are salted.
SHALLOW = 4
#: Copies of the smaller side of a salted join.
SALTS = 8
#: Weight of all languages together in the threshold of one, in sentences.
PRIOR = 300
#: Characters of the end of a text in which its last words and marks are looked for; contexts are far shorter.
TAIL = 160
#: What a comma at the end, and a size at which texts pile up, take off the log-odds of ending.
COMMA, AT_LIMIT = 4.0, 8.0
#: Characters of a line's beginning by which kinds of lines are told apart.
LINE_KEY = 10
#: What a kind of lines adds to the log-odds of ending at most, and how many texts of either sort are assumed of every kind.
KIND, KIND_PRIOR = 8.0, 0.01

_END = re.compile(r"[.!?][\"'”’»)\]]*$")
_BULLET = re.compile(r"^\s*(?:[-•*·–►]|\d+[.)])\s")
_FOOT = re.compile(r"(?<!Ã)©|\(c\)|[�?]\s*(?:19|20)\d\d\s|\bcopyright\b|https?:|www\.|@|\b(?:tel|fax|phone|tél|tlf)\b\.?", re.I)
_CLOCK = re.compile(r"\d{1,2}[:.h]\d{2}\s*$|\d{1,2}\.\d{1,2}\.\d{4}\s*$")
_MOJIBAKE = re.compile(r"(?:â€.{0,2}|â[^\w\s]{1,2}|Ã|Â)+$")
_MARKUP = re.compile(r"<[^<>]{0,40}$|&#?\w{0,8};?$|\\u?[0-9a-fA-F]{0,4}$")
_DIGIT = re.compile(r"\d")
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def ending(tail: str | None, size: int) -> tuple[str, str]:
    """(state, context) of the end of a text.

    State 'empty', 'whole' (closes with a sentence's mark, whatever follows it), 'mark' (an ellipsis or another mark or
    scrap stands after the last word), 'comma' (a mark that more must follow), or 'open' (a letter or digit ends it). The context is what stands before the
    mark, digits as 0. ``tail`` is the end of the text, ``size`` the length of the text.
    """
    text = (tail or "").rstrip()
    if not text:
        return "empty", ""
    bare = _MARKUP.sub("", _MOJIBAKE.sub("", text)).rstrip() or text
    body = re.sub(r"[\W_]+$", "", bare)
    mark = text[len(body) :]
    if not body:
        return "empty" if not re.search(r"\w", text) and size <= TAIL else "mark", ""
    context = _DIGIT.sub("0", body[-max(DEPTHS) :])
    if not re.match(r"\s*(?:\.{2,}|…)", mark) and re.match(r"[^\w\s]*[.!?]", re.sub(r"\.{2,}|…", "", mark)):
        return "whole", context
    if re.match(r"\s*[,;:(]", mark):
        return "comma", context
    return ("mark" if mark else "open"), context


def around_last_word(text: str) -> str:
    """The TAIL characters up to the last letter or digit of a text, and as many of the marks behind it."""
    if len(text) <= TAIL:
        return text
    end = len(text)
    while end and not text[end - 1].isalnum():
        end -= 1
    return text[-TAIL:] if len(text) - end <= TAIL - 40 else text[max(0, end - TAIL) : end + TAIL]


def is_listing(line: str, before: str) -> bool:
    """Lines that are no prose: bullets, footers, links, telephone numbers, menus, times, signatures and what is among them."""
    line, before = line.strip(), before.strip()
    if re.search(r"[^\W\d_]{3}[.!?] \w", line) and not _FOOT.search(line):
        return False
    if _BULLET.match(line) or _FOOT.search(line) or _CLOCK.search(line) or line.count("|") + line.count("·") + line.count(" > ") + line.count(" / ") >= 1:
        return True
    words = re.findall(r"[^\W\d_]+", line)
    if not words or ("," in line and len(words) <= 5 and all(w[0].isupper() for w in words)):
        return True
    return len(words) <= 2 and bool(_BULLET.match(before) or _CLOCK.search(before) or _FOOT.search(before))


_DIGITS = np.arange(0x110000, dtype=np.uint32)
_DIGITS[48:58] = 48
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
#: Characters of text hashed at a time.
SLICE = 500_000


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Hasher:
    """Hashes of the last characters before positions of a text, at any depth, from one running sum.

    The sum of codes times powers of an odd number, modulo 2**64, gives a window's polynomial by a subtraction; the
    power of its place is divided out by the inverse, so equal windows hash alike wherever they stand. Of the two lowest
    bits the first is left free, the second is set for windows of at most SHALLOW characters.
    """

    def __init__(self, codes: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * _powers(_P, len(codes)))])
        self.back = _powers(_INVERSE, len(codes))

    def at(self, positions: np.ndarray, depth: int) -> np.ndarray:
        """Hashes of the ``depth`` characters up to and including each position, which must have as many before it."""
        begin = positions + 1 - depth
        with np.errstate(over="ignore"):
            h = (self.sums[positions + 1] - self.sums[begin]) * self.back[begin] + np.uint64(depth)
            h ^= h >> np.uint64(32)
            h *= _P
            h ^= h >> np.uint64(29)
        return (h & ~np.uint64(3) | np.uint64(2 * (depth <= SHALLOW))).view(np.int64)


def codes_of(text: str) -> np.ndarray:
    """Code points with all digits alike."""
    return _DIGITS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)


def hash_contexts(contexts) -> pd.DataFrame:
    """(context, depth, h, group) of the last characters of each context at each depth that it has; depth is an index.

    ``group`` is the hash at the first depth, which all that end alike share.
    """
    contexts = list(contexts)
    if not contexts:
        return pd.DataFrame({"context": [], "depth": [], "h": [], "group": []}).astype({"context": object, "depth": np.int32, "h": np.int64, "group": np.int64})
    sizes = np.array([len(c) for c in contexts])
    hasher, last = Hasher(codes_of("".join(contexts))), np.cumsum(sizes) - 1
    parts, group = [], np.zeros(len(contexts), np.int64)
    for i, d in enumerate(DEPTHS):
        long = np.flatnonzero(sizes >= d)
        h = hasher.at(last[long], d)
        if not i:
            group[long] = h
        parts.append(pd.DataFrame({"context": np.array(contexts, dtype=object)[long], "depth": np.full(len(long), i, np.int32), "h": h, "group": group[long]}))
    return pd.concat(parts, ignore_index=True)


def round_of(group: np.ndarray, rounds: int) -> np.ndarray:
    """The round in which contexts that end alike are counted."""
    return (group >> 20) % rounds


def count_contexts(texts, wanted: np.ndarray, rounds: int = 1, here: int = 0) -> pd.DataFrame:
    """(h, ends, n) over all positions of the texts whose contexts may be wanted, of those counted in round ``here``.

    A position counts if a letter or digit stands there and something follows; it ends if a full stop, exclamation or
    question mark follows that is not inside a number or name, or a line break. Whoever holds a deep context holds its
    shallower ones, so only positions that were wanted at one depth are looked at in the next. The lowest bit of a hash
    carries whether the position ends while hashes are sorted.
    """
    joined = "\x00".join([" " * max(DEPTHS), *texts, ""])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    hasher = Hasher(codes_of(joined))
    after = np.append(raw[1:], np.uint32(0))
    beyond = np.append(after[1:], np.uint32(0))
    ends = (((after == 46) | (after == 33) | (after == 63)) & ~_LETTERS[beyond] & (beyond != 46)) | (after == 10)
    position = np.flatnonzero(_LETTERS[raw] & (after != 0) & (after != 0x2026) & ~((after == 46) & (beyond == 46)))
    found, bits = [], 8 * len(wanted)
    for d in DEPTHS:
        h = hasher.at(position, d)
        if rounds > 1 and d == DEPTHS[0]:
            mine = round_of(h, rounds) == here
            position, h = position[mine], h[mine]
        bit = (h >> 2) & (bits - 1)
        hit = (wanted[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        position, h = position[hit], h[hit]
        found.append(h | ends[position])
    keys = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys)))
    return _summed(keys[first] & ~1, n * (keys[first] & 1), n)


def _summed(h: np.ndarray, ends: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    keys, inverse = np.unique(h, return_inverse=True)
    return pd.DataFrame({"h": keys, "ends": np.bincount(inverse, ends, len(keys)).astype(np.int64), "n": np.bincount(inverse, n, len(keys)).astype(np.int64)})


def _letters() -> np.ndarray:
    """Which of the code points below 0x30000 are letters or digits; all above count as none."""
    table = np.zeros(0x110000, dtype=bool)
    table[:0x30000] = [chr(c).isalnum() for c in range(0x30000)]
    return table


_LETTERS = _letters()


def cut_inside(tail: str, key: int) -> str | None:
    """The tail of a whole text, cut inside its last sentence at a place chosen by ``key``; null if that is too short."""
    body = re.sub(r"[\W_]+$", "", tail)
    begin = max(body.rfind(". "), body.rfind("\n"), body.rfind("! "), body.rfind("? ")) + 2
    if len(body) - begin < 20:
        return None
    return body[: begin + 8 + key % (len(body) - begin - 12)]


def _whole_and_cut(batches):
    """For each whole sentence its context, and the context that it has when cut inside."""
    for b in batches:
        out = []
        for lang, context, tail, copies in b[["lang", "context", "tail", "copies"]].itertuples(index=False):
            if cut := cut_inside(tail, zlib.crc32(tail.encode("utf-8", "replace"))):
                out += [(lang, context, True, copies), (lang, ending(cut, len(cut))[1], False, copies)]
        yield pd.DataFrame(out, columns=["lang", "context", "truly", "copies"])


def _wanted(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bit table of distinct hashes, made in parts."""
    size = min(PART_BITS, bits)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        bit = (pdf["h"].to_numpy() >> 2) & (bits - 1)
        flags = np.zeros(size, bool)
        flags[bit & (size - 1)] = True
        return pd.DataFrame({"part": [int(bit[0]) // size], "flags": [np.packbits(flags, bitorder="little").tobytes()]})

    which = F.expr(f"shiftright(shiftright(h, 2) & {bits - 1}L, {size.bit_length() - 1})")
    table = np.zeros(bits // 8, dtype=np.uint8)
    for r in hashes.groupBy(which).applyInPandas(part, "part int, flags binary").collect():
        table[r["part"] * (size // 8) : (r["part"] + 1) * (size // 8)] = np.frombuffer(r["flags"], np.uint8)
    return table


def _salted_left(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """A left join on a key that a third of all rows on the left may have, but only one row on the right."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    spread = right.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_s", salt).join(spread, [key, "_s"], "left").drop("_s")


def declared_language(col: str):
    """The first two letters from a to z of a declared language, or 'xx': at most 677 values."""
    code = F.lower(F.regexp_extract(F.coalesce(F.col(col), F.lit("")), r"^\s*([A-Za-z]{2})", 1))
    return F.when(code == "", "xx").otherwise(code)


def score_endings(docs: DataFrame, doc_id: str, text: str, lang: str, sample_texts: int | None = None, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per document: id, state, log_odds of ending (null for those that are whole, empty or listings), threshold, is_cut.

    A document is cut if its last line is no listing and the log-odds fall below its language's threshold; lines inside
    texts that begin alike and end without a sentence's mark raise them. Null and empty texts are 'empty' and not cut.
    Repeated texts do not vouch for each other: an end counts once however many copies of the text there are, and not for
    itself, and last lines tell nothing of a kind of lines. Thresholds are fitted on all whole sentences, or on at most
    ``sample_texts`` of each language; their own occurrences, copies included, are taken off the counts as well. Contexts that do not fit a
    table of ``most_bits`` are counted in several rounds over the texts, with the same result. Ids should be unique; repeated rows give repeated results. Other columns are
    ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("id"), declared_language(lang).alias("lang"), F.col(text).alias("text"))
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    last = F.substring_index(trimmed, "\n", -1)
    tail = F.right(trimmed, F.lit(TAIL))
    tail = F.when(tail.rlike(r"(?Us)^.{40}.*\w"), tail).otherwise(trimmed)  # few texts end in so many marks
    ends = d.select("id", "lang", F.length("text").alias("size"), tail.alias("tail"), F.left(last, F.lit(LINE_KEY)).alias("line_key"))

    def look(batches):
        for b in batches:
            out = []
            for id_, lang_, size, tail, key in b.itertuples(index=False):
                tail = around_last_word(tail or "")
                state, context = ending(tail, size or 0)
                lines = tail.rstrip().split("\n")
                if len(lines) == 1 and (size or 0) > TAIL:
                    lines = [re.sub(r"^[\W_]+", "", lines[0])]  # the tail may begin inside a word or at a dash
                listing = is_listing(lines[-1], lines[-2] if len(lines) > 1 else "")
                key = None if re.search(r"[^\W\d_]{3}[.!?] \w", lines[-1]) else key  # a line of several sentences is prose
                out.append((id_, lang_, size, state, context, tail, listing, key and _DIGIT.sub("0", key)))
            yield pd.DataFrame(out, columns=["id", "lang", "size", "state", "context", "tail", "listing", "line_key"])

    kind = ends.schema["id"].dataType.simpleString()
    seen = checkpoint(ends.mapInPandas(look, f"id {kind}, lang string, size int, state string, context string, tail string, listing boolean, line_key string"))

    open_ends = seen.where(_may_be_cut()).select("context", "lang").distinct()
    known = seen.where("state = 'whole' and not listing").groupBy("context", "tail").agg(F.count("*").alias("copies"), F.collect_set("lang").alias("langs")).select(F.explode("langs").alias("lang"), "context", "tail", "copies")
    if sample_texts is not None:
        within = Window.partitionBy("lang", F.pmod(F.xxhash64("context"), F.lit(32))).orderBy(F.xxhash64("context"), "context", "tail")
        overall = Window.partitionBy("lang").orderBy(F.xxhash64("context"), "context", "tail")
        known = known.withColumn("k", F.row_number().over(within)).where(F.col("k") <= sample_texts).withColumn("k", F.row_number().over(overall)).where(F.col("k") <= sample_texts)
    sample = checkpoint(known.select("lang", "context", "tail", "copies").mapInPandas(_whole_and_cut, "lang string, context string, truly boolean, copies bigint"))

    asked = open_ends.select("context").unionByName(sample.select("context")).distinct()
    hashed = checkpoint(_with_hashes(asked))
    hashes = hashed.select("h", "group").distinct()
    size = hashes.count()
    bits = min(most_bits, max(LEAST_BITS, 1 << (PER_CONTEXT * size - 1).bit_length()))
    rounds = max(1, -(-PER_CONTEXT * size // bits))

    def counted(here: int) -> DataFrame:
        mine = hashes if rounds == 1 else hashes.where(F.expr(f"pmod(shiftright(group, 20), {rounds}L) = {here}"))
        wanted = spark.sparkContext.broadcast(_wanted(mine.select("h").distinct(), bits))

        def count(batches):
            held, n = [], 0
            for b in batches:
                part, chars = [], 0
                for t in [*b["text"], None]:
                    if t:
                        part.append(t)
                        chars += len(t)
                    if part and (chars > SLICE or t is None):
                        held.append(count_contexts(part, wanted.value, rounds, here))
                        n += len(held[-1])
                        part, chars = [], 0
                if n > 1_000_000:
                    held = [_added(held)]
                    if len(held[0]) > 500_000:  # adding up no longer helps
                        yield held.pop()
                    n = sum(map(len, held))
            if held:
                yield _added(held)

        found = d.select("text").mapInPandas(count, "h bigint, ends bigint, n bigint")
        return found if rounds == 1 else checkpoint(found.groupBy("h").agg(F.sum("ends").alias("ends"), F.sum("n").alias("n")))

    inside = reduce(DataFrame.unionByName, [counted(r) for r in range(rounds)])
    # Ends of texts without a closing mark; those of copies, alike to 80 characters, count once.
    tails = seen.where("state in ('open', 'mark')").select("context", F.right("tail", F.lit(80)).alias("tail")).distinct().groupBy("context").agg(F.count("*").alias("times"))
    outside = _with_hashes(tails.select("context")).join(tails, "context").select("h", F.col("times").alias("ends"), F.col("times").alias("n"))
    counts = inside.unionByName(outside).groupBy("h").agg(F.sum("ends").alias("ends"), F.sum("n").alias("n"))
    # A shallow context may be that of a third of all texts: those few, marked by their second bit, are salted.
    shallow = F.col("h").bitwiseAND(2) == 2
    spread = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.when(shallow, SALTS - 1).otherwise(0))))
    met = hashed.withColumn("s", F.when(shallow, F.pmod(F.xxhash64("context"), F.lit(SALTS))).otherwise(0).cast("int")).join(spread, ["h", "s"], "left")
    per = checkpoint(met.groupBy("context").agg(F.array_sort(F.collect_list(F.struct("depth", F.coalesce("ends", F.lit(0)).alias("ends"), F.coalesce("n", F.lit(0)).alias("n")))).alias("x")))
    own = F.when(F.col("own"), 1).otherwise(0)
    odds = per.join(tails.select("context", F.lit(True).alias("own")), "context", "left").select("context", _log_odds(own, own).alias("log_odds"))

    limits = checkpoint(_thresholds(sample.join(per, "context").select("lang", "truly", _log_odds(F.when(F.col("truly"), F.col("copies")).otherwise(0), F.col("copies")).alias("log_odds"))))
    # Only ends that may be cut are judged. Keys of theirs may be those of a third of all rows, and many have no kind.
    judged = seen.where(_may_be_cut()).select("id", "lang", "size", "state", "context", "line_key")
    kinds = _line_kinds(d, judged.select("line_key").where("line_key is not null").distinct())
    judged = _salted_left(judged.where("line_key is not null"), kinds, "line_key", "id").unionByName(judged.where("line_key is null").withColumn("kind", F.lit(None).cast("double")))
    judged = _salted_left(_salted_left(judged, odds, "context", "id"), _field_limits(seen), "size", "id").join(F.broadcast(limits), "lang", "left")
    threshold = F.coalesce("threshold", F.lit(limits.where("lang = ''").first()["threshold"]))
    odds_there = F.col("log_odds") - F.when(F.col("state") == "comma", COMMA).otherwise(0.0) - F.when(F.col("at_limit") & (F.col("state") != "mark"), AT_LIMIT).otherwise(0.0) + F.coalesce("kind", F.lit(0.0))
    judged = judged.select("id", "state", odds_there.alias("log_odds"), threshold.alias("threshold"), F.coalesce(odds_there < threshold, F.lit(False)).alias("is_cut"))
    others = seen.where(~_may_be_cut()).join(F.broadcast(limits), "lang", "left").select("id", "state", F.lit(None).cast("double").alias("log_odds"), threshold.alias("threshold"), F.lit(False).alias("is_cut"))
    return judged.unionByName(others).withColumnRenamed("id", doc_id)


def _may_be_cut():
    return F.col("state").isin("open", "mark", "comma") & ~F.col("listing")


def _added(held: list[pd.DataFrame]) -> pd.DataFrame:
    x = pd.concat(held)
    return _summed(x["h"].to_numpy(), x["ends"].to_numpy(), x["n"].to_numpy())


def _field_limits(seen: DataFrame) -> DataFrame:
    """Sizes at which texts pile up: at least five texts, and ten times as many as at the sizes around."""
    sizes = seen.where("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    near = sizes.select(F.explode(F.sequence(F.col("size") - 20, F.col("size") + 20)).alias("size"), F.col("n").alias("m")).groupBy("size").agg((F.sum("m") / 41).alias("around"))
    return sizes.where("n >= 5").join(near, "size").where("n >= 10 * (around - n / 41)").select("size", F.lit(True).alias("at_limit"))


def _with_hashes(contexts: DataFrame) -> DataFrame:
    """(context, depth, h, group) for distinct contexts."""
    return contexts.mapInPandas(lambda batches: (hash_contexts(b["context"]) for b in batches), "context string, depth int, h bigint, group bigint")


def _log_odds(own_ends, own_n):
    """Log-odds of ending by the counts ``x`` of a context, from the shallow to the deep, without its own."""
    p = F.aggregate(F.col("x"), F.lit(0.05), lambda acc, y: (F.greatest(y["ends"] - own_ends, F.lit(0)) + WEIGHT * acc) / (F.greatest(y["n"] - own_n, F.lit(0)) + WEIGHT))
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return F.ln(p / (1 - p))


def _thresholds(scored: DataFrame) -> DataFrame:
    """Per language the log-odds with the fewest errors on the sample, where to call a whole sentence cut counts twice.

    Of thresholds alike to a hundredth the middle; '' holds that of all languages, used for those without a sample.
    """
    grid = F.explode(F.array(*[F.lit(x / 4) for x in range(-24, 9)])).alias("threshold")
    both = scored.select("lang", "truly", "log_odds").unionByName(scored.select(F.lit("").alias("lang"), "truly", "log_odds"))
    wrong = both.select("lang", "truly", "log_odds", grid).groupBy("lang", "threshold").agg(
        F.avg(F.when(F.col("truly"), (F.col("log_odds") < F.col("threshold")).cast("int"))).alias("lost"), F.avg(F.when(~F.col("truly"), (F.col("log_odds") >= F.col("threshold")).cast("int"))).alias("missed"), F.count(F.when(F.col("truly"), 1)).alias("n")
    )
    # Few sentences say little, so each language's errors are mixed with those of all, which weigh as PRIOR sentences.
    cost = 2 * F.coalesce("lost", F.lit(0.0)) + F.coalesce("missed", F.lit(0.0))
    overall = wrong.where("lang = ''").select("threshold", cost.alias("all_cost"))
    mixed = wrong.withColumn("own_cost", cost).join(overall, "threshold").withColumn("cost", (F.col("n") * F.col("own_cost") + PRIOR * F.col("all_cost")) / (F.col("n") + PRIOR))
    least = F.min(F.round("cost", 2)).over(Window.partitionBy("lang"))
    best = mixed.withColumn("least", least).where(F.round("cost", 2) == F.col("least")).groupBy("lang").agg(F.avg("threshold").alias("threshold"))
    default = scored.sparkSession.createDataFrame([("", -1.0)], "lang string, threshold double")
    return best.unionByName(default.join(best.where("lang = ''").select("lang"), "lang", "left_anti"))


def _line_kinds(d: DataFrame, keys: DataFrame) -> DataFrame:
    """What lines with one beginning, one of ``keys``, add to the log-odds of ending: the log of how many end without a sentence's mark to one with it.

    Lines inside texts are complete; last lines may be cut, so they are left out. Each text, however many copies of it
    there are, counts once for a kind, by the share of its lines of that kind that end as sentences do. One text of a kind says nearly as much as many, as lines
    that begin alike mostly end alike. A last line shorter than a beginning is of a kind only if such lines stand inside texts.
    """
    lines = F.split(F.rtrim("text", F.lit(_BLANKS)), "\n")
    inside = d.select(F.xxhash64("text").alias("t"), F.explode(F.slice(lines, F.lit(1), F.size(lines) - 1)).alias("line"))
    keyed = inside.select("t", F.regexp_replace(F.left("line", F.lit(LINE_KEY)), r"\d", "0").alias("line_key"), F.right(F.rtrim("line"), F.lit(1)).isin(".", "!", "?").cast("int").alias("closed"))
    kinds = keyed.join(keys, "line_key", "left_semi").groupBy("line_key", "t").agg(F.avg("closed").alias("closed")).groupBy("line_key").agg(F.sum("closed").alias("closed"), F.count("*").alias("texts"))
    lean = F.ln((F.col("texts") - F.col("closed") + KIND_PRIOR) / (F.col("closed") + KIND_PRIOR))
    return kinds.select("line_key", F.least(F.greatest(lean, F.lit(0.0)), F.lit(KIND)).alias("kind"))


def cut_rates(scored: DataFrame, docs: DataFrame, doc_id: str, source: str) -> DataFrame:
    """(source, n_rows, n_cut, cut_share) over all rows of each source; a null source is a source of its own."""
    return docs.select(doc_id, F.col(source).alias("source")).join(scored.select(doc_id, "is_cut"), doc_id).groupBy("source").agg(F.count("*").alias("n_rows"), F.sum(F.col("is_cut").cast("bigint")).alias("n_cut"), F.avg(F.col("is_cut").cast("double")).alias("cut_share"))
