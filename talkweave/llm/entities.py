"""Problem 2: linking the variant spellings of one person or organisation within a meeting.

Names are read by rules (names.py); names of a meeting that are read alike form one reading, whose weight is the number
of their rows. Readings are rewritten into forms, forms are exploded and equi-joined, and every link is scored by how
rare the rewriting is:

- Readings that share a near form are candidates. What errors it takes to turn one into the other is told from both
  readings themselves. The rarer one links to the weightiest it may be a variant of, if the score allows it: one usual
  slip always does, two need a long name or that the variant is rarer than the other, a wrong letter that is no usual
  slip needs that it is much rarer.
- A shortened spelling is linked if a single entity of the meeting offers what it asks for, the surname being verified
  likewise; where nobody offers it, those who ask for exactly the same are linked with each other.

A form leaves out at most two letters of a reading, and readings are distinct, so the readings that share one are
bounded by letters and not by rows. Each reading links to one other only; components of these links are the entities.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.llm.graph import components
from talkweave.llm.names import APART, LEVELS, SLIP, Reading, cost, forms, read, word_cost
from talkweave.llm.runs import double_pointers
from talkweave.runtime import cut

#: Score of a reading that needs no error, and the most that rarity adds.
SURE, MOST_RARITY = 3.0, 4.0
#: A name is long from how many letters, how many more add 1 to the score, and how much they add at most.
LONG_FROM, PER_LETTERS, MOST_LONG = 8, 3.0, 2.5
_READING = ["shape", "given", "last"]


def readings(names: DataFrame) -> DataFrame:
    """Add how each name is read to distinct (g, name, n) rows; names that mean nobody are left out."""

    def run(batches):
        for batch in batches:
            found = [read(name) for name in batch["name"]]
            kept = batch[[r is not None for r in found]].reset_index(drop=True)
            r = [x for x in found if x]
            yield kept.assign(shape=[x.shape for x in r], given=[x.given for x in r], last=[x.last for x in r], cut=[x.cut for x in r], typed=[x.typed for x in r])

    kind = names.schema["g"].dataType.simpleString()
    return names.mapInPandas(run, f"g {kind}, name string, n bigint, shape string, given string, last string, cut boolean, typed string")


def _with_forms(nodes: DataFrame) -> DataFrame:
    """Add the forms of each reading."""

    def run(batches):
        for b in batches:
            made = [forms(Reading(s, g, w, c), str(m), list(t)) for m, s, g, w, c, t in zip(b["g"], b["shape"], b["given"], b["last"], b["cut"], b["typed"])]
            asks = [[{"level": lv, "form": f, "word": w, "exact": x} for lv, f, w, x in sorted(m.asks)] for m in made]
            yield b.drop(columns=["cut", "typed"]).assign(near=[sorted(m.near) for m in made], offers=[sorted(m.offers) for m in made], asks=asks)

    schema = T.StructType([f for f in nodes.schema if f.name not in ("cut", "typed")])
    for f in ("near array<bigint>", "offers array<bigint>", "asks array<struct<level:int,form:bigint,word:string,exact:boolean>>"):
        schema.add(T._parse_datatype_string(f).fields[0])
    return nodes.mapInPandas(run, schema)


def score(c, letters, rarity):
    """Log-odds of a variant: what its errors cost, how long the name is, and how much rarer (in powers of two) it is."""
    return SURE - c + F.least(F.greatest((letters - LONG_FROM) / PER_LETTERS, F.lit(0.0)), F.lit(MOST_LONG)) + F.least(rarity, F.lit(MOST_RARITY))


def _rarer(heavy, light):
    return F.log2((1 + heavy) / (1 + light))


@F.pandas_udf(T.IntegerType())
def _cost(sa: pd.Series, ga: pd.Series, la: pd.Series, sb: pd.Series, gb: pd.Series, lb: pd.Series) -> pd.Series:
    return pd.Series([cost(Reading(*x[:3]), Reading(*x[3:])) for x in zip(sa, ga, la, sb, gb, lb)], dtype="int32")


@F.pandas_udf(T.IntegerType())
def _word_cost(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([word_cost(x, y) for x, y in zip(a, b)], dtype="int32")


def spread(d: DataFrame, *keys: str) -> DataFrame:
    """The rows in twice as many tasks as there are cores: names are few bytes but costly to read.

    A salt of its own keeps the exchange from being merged with the one before or coalesced by size.
    """
    return d.repartition(2 * d.sparkSession.sparkContext.defaultParallelism, F.xxhash64(*keys, F.lit("names")))


def _variants(nodes: DataFrame) -> DataFrame:
    """(id, parent, score): every reading with the one it is a variant of, itself if none."""
    shared = nodes.select("id", F.explode("near").alias("form")).groupBy("form").agg(F.collect_list("id").alias("ids")).where(F.size("ids") > 1)
    pairs = shared.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b")).where("a < b").distinct()
    side = lambda x: nodes.select(F.col("id").alias(x), F.struct("n", *_READING).alias(f"_{x}"))
    met = spread(pairs.join(side("a"), "a").join(side("b"), "b"), "a", "b")
    # Where only the given names differ it also tells how rare each of them is in all meetings.
    known = nodes.where("shape = 'person'").groupBy("given").agg(F.sum("n").alias("all"))
    for x in "ab":
        met = met.join(known.select(F.col("given").alias(f"_g{x}"), F.col("all").alias(f"_all_{x}")), F.col(f"_{x}.given") == F.col(f"_g{x}"), "left")
    met = met.withColumn("c", _cost(*[F.col(f"_{x}.{f}") for x in "ab" for f in _READING])).where(F.col("c") < APART)
    a_heavy = F.col("_a.n") > F.col("_b.n")
    a_heavy = a_heavy | ((F.col("_a.n") == F.col("_b.n")) & (F.struct(*[F.col(f"_a.{f}") for f in _READING]) < F.struct(*[F.col(f"_b.{f}") for f in _READING])))
    heavy, light = F.when(a_heavy, F.col("_a")).otherwise(F.col("_b")), F.when(a_heavy, F.col("_b")).otherwise(F.col("_a"))
    everywhere = F.when((F.col("_a.last") == F.col("_b.last")) & (F.col("_a.given") != F.col("_b.given")), _rarer(F.when(a_heavy, F.col("_all_a")).otherwise(F.col("_all_b")), F.when(a_heavy, F.col("_all_b")).otherwise(F.col("_all_a"))))
    scored = score(F.col("c"), F.length(heavy["given"]) + F.length(heavy["last"]), F.greatest(_rarer(heavy["n"], light["n"]), everywhere))
    met = met.select(F.when(a_heavy, F.col("b")).otherwise(F.col("a")).alias("id"), F.when(a_heavy, F.col("a")).otherwise(F.col("b")).alias("to"), heavy.alias("h"), scored.alias("score"))
    best = met.where("score >= 0").groupBy("id").agg(F.max(F.struct("score", "h.n", "h.last", "h.given", "to")).alias("best"))
    return nodes.select("id").join(best, "id", "left").select("id", F.coalesce("best.to", "id").alias("parent"), F.coalesce("best.score", F.lit(SURE)).alias("score"))


def _attach(asks: DataFrame, offers: DataFrame) -> DataFrame:
    """(a, b) edges between entities at one level: from one that asks to the one that offers, if that is the only other.

    ``asks`` has id (an entity), form, word, exact; ``offers`` has of (an entity), form, last.
    """
    # Two extremes tell one from several. Of the surnames offered under a form those nearest to what was asked for count.
    rarity = offers.groupBy("form", "last").agg(F.min("of").alias("low"), F.max("of").alias("high"))
    met = spread(asks.join(rarity, "form").where("not (low = high and low = id)"), "id", "form").withColumn("c", F.when(F.col("last").isNull(), 0).otherwise(_word_cost("word", F.coalesce("last", F.lit("")))))
    answers = met.where(F.col("c") <= SLIP).groupBy("id", "c").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    nearest = answers.groupBy("id").agg(F.min(F.struct("c", "low", "high")).alias("x"))
    return nearest.select(F.col("id").alias("a"), F.when(F.col("x.low") == F.col("x.high"), F.col("x.low")).alias("b"))


def _together(asks: DataFrame, answered: DataFrame) -> DataFrame:
    """Edges among those who ask for exactly the same while nobody offers anything they ask for."""
    rest = asks.where("exact").join(answered.select(F.col("a").alias("id")), "id", "left_anti")
    w = Window.partitionBy("form").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    return rest.select(F.col("id").alias("a"), F.first("id").over(w).alias("b")).where("a <> b").distinct()


def link_names(rows: DataFrame, group: str, name: str) -> DataFrame:
    """(group, name, entity, kind, score): the entity of every distinct spelling in each group (meeting).

    ``entity`` is the smallest spelling of its component, ``kind`` person or organisation, ``score`` the log-odds of
    the link of the spelling's reading to another one (3 where it needs none). Spellings are kept exactly as stored.
    Null and blank names, devices without an owner, rooms and roles mean nobody and are left out, as are rows with a
    null group. Repeated rows add to a spelling's weight; other columns are ignored, whatever their names; no rows give
    no rows.
    """
    names = rows.select(F.col(group).alias("g"), F.col(name).alias("name")).where("g is not null and name is not null").groupBy("g", "name").agg(F.count("*").alias("n"))
    read_names = cut(readings(spread(names, "g", "name")))
    nodes = read_names.groupBy("g", *_READING).agg(F.sum("n").alias("n"), F.max("cut").alias("cut"), F.collect_set("typed").alias("typed"))
    # Whole names come before shortened ones, so that nearly all components are found in one round.
    shortened = F.when(F.col("shape").isin("person", "organisation"), 0).otherwise(1 << 62)
    nodes = cut(_with_forms(spread(nodes, "g", "last", "given")).withColumn("id", F.monotonically_increasing_id() + shortened))
    parents = cut(_variants(nodes))
    entity = double_pointers(parents).select("id", "root")

    asked = cut(nodes.select("id", F.explode("asks").alias("x")).select("id", "x.*"))
    wanted = asked.select("form").distinct()
    verified = F.col("form").bitwiseAND(1) == 1
    offered = nodes.select("id", "last", F.explode("offers").alias("form")).select("id", "form", F.when(verified, F.col("last")).alias("last"))
    offered = cut(offered.join(wanted, "form", "left_semi"))
    for level, which in enumerate(LEVELS):
        at = asked.where(F.col("level") == level).join(entity, "id").select(F.col("root").alias("id"), "form", "word", "exact").distinct()
        found = cut(_attach(at, offered.join(entity, "id").select(F.col("root").alias("of"), "form", "last")))
        edges = found.where("b is not null and a <> b")
        if which in ("ask", "late"):  # any whole name may be a cut one; that nobody offers it says nothing
            edges = edges.unionByName(_together(at, found))
        moved = components(edges).select(F.col("id").alias("root"), F.col("root").alias("_new"))
        entity = cut(entity.join(moved, "root", "left").select("id", F.coalesce("_new", "root").alias("root")))

    placed = nodes.join(entity, "id").join(parents.select("id", "score"), "id").select("g", *_READING, "root", "score")
    out = read_names.select("g", "name", *_READING).join(placed, ["g", *_READING])
    smallest = out.groupBy("root").agg(F.min("name").alias("entity"))
    kind = F.when(F.col("shape").isin("organisation", "kinds", "acronym"), "organisation").otherwise("person")
    return out.join(smallest, "root").select(F.col("g").alias(group), F.col("name").alias(name), "entity", kind.alias("kind"), "score")


def variant_pairs(linked: DataFrame, group: str, name: str) -> DataFrame:
    """All pairs of different spellings of one entity: (group, name_a, name_b), name_a < name_b."""
    a = linked.select(group, "entity", F.col(name).alias("name_a"))
    b = linked.select(group, "entity", F.col(name).alias("name_b"))
    return a.join(b, [group, "entity"]).where("name_a < name_b").select(group, "name_a", "name_b")
