"""Greedy clustering of noisy names around leaders."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.runtime import cut

#: Names of a group that may become leaders in one round, and parts that a group's names are compared in.
ROUND, PARTS = 512, 16


class Alike:
    """The matching-block ratio of names to a list of others, compared only where their letters allow it to reach a bound."""

    def __init__(self, folded: list[str], least: float):
        self.folded, self.least = [], least
        self.counts = np.zeros((0, 128), np.int16)
        self.sizes = np.zeros(0, np.int64)
        for f in folded:
            self.add(f)

    @staticmethod
    def _letters(name: str) -> np.ndarray:
        codes = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), np.uint32) % 128
        return np.bincount(codes, minlength=128).astype(np.int16)

    def add(self, folded: str) -> None:
        self.folded.append(folded)
        self.counts = np.vstack([self.counts, self._letters(folded)])
        self.sizes = np.append(self.sizes, len(folded))

    def best(self, folded: str, most: int | None = None) -> tuple[int, float] | None:
        """Index and ratio of the most similar of the first ``most`` names, the first of equally similar ones, if it
        reaches the bound. A ratio is never above that of the letters both have, whose codes may share a place."""
        n = len(self.folded) if most is None else most
        if not n:
            return None
        shared = np.minimum(self.counts[:n], self._letters(folded)).sum(axis=1)
        total = self.sizes[:n] + len(folded)
        bound = np.where(total > 0, 2.0 * shared / np.maximum(total, 1), 1.0)
        found = None
        for i in np.argsort(-bound, kind="stable"):
            if bound[i] < self.least or (found and bound[i] < found[1]):
                break
            ratio = SequenceMatcher(None, folded, self.folded[i]).ratio()
            if ratio >= self.least and (found is None or ratio > found[1] or (ratio == found[1] and i < found[0])):
                found = int(i), ratio
        return found


def leaders(names: list[str], threshold: float) -> dict[str, str]:
    """Each name with its leader: names come in order of weight, each joins the most similar leader so far, the first
    of equally similar ones, if their matching-block ratio without case is at least ``threshold``; else it leads."""
    known, first, out = Alike([], threshold), [], {}
    for name in names:
        found = known.best(name.casefold())
        if found is None:
            known.add(name.casefold())
            first.append(name)
        out[name] = first[found[0]] if found else name
    return out


def canonical_names(events: DataFrame, group: str, name: str, weight: str, order: str, threshold: float = 0.65, most: int = ROUND) -> DataFrame:
    """(group, name, canonical): every distinct name with its leader.

    Names are ordered by their total weight, then by first appearance. Null names and groups are left out; repeated rows
    count again. In each round the first ``most`` names of a group that are like no leader yet are walked in order, which
    tells the next leaders; all names of the group are then compared with those that come before them, in parallel.
    A name that is like a leader before it never leads, so the rounds give what one walk over all names would.
    """
    totals = events.where(F.col(name).isNotNull() & F.col(group).isNotNull()).groupBy(F.col(group).alias("g"), F.col(name).alias("n")).agg((-F.sum(F.coalesce(weight, F.lit(0.0)))).alias("w"), F.min(order).alias("f"))
    kind, place = events.schema[group].dataType.simpleString(), ["w", "f", "n"]
    state = cut(totals.select("g", *place, F.lit(None).cast("string").alias("leader"), F.lit(0.0).alias("ratio")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)

    def next_leaders(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("k")
        found = leaders(ordered["n"].tolist(), threshold)
        return ordered[[found[n] == n for n in ordered["n"]]][["g", *place]]

    def compare(batches):
        """Leaders and names come in order, a leader before its own name."""
        here, known, names = None, None, []
        for b in batches:
            out = []
            for g, part, w, f, n, is_name, leader, ratio in b[["g", "part", *place, "is_name", "leader", "ratio"]].itertuples(index=False, name=None):
                if (g, part) != here:
                    here, known, names = (g, part), Alike([], threshold), []
                if not is_name:
                    known.add(n.casefold())
                    names.append(n)
                elif names and names[-1] == n:
                    out.append((g, w, f, n, n, 2.0))
                else:
                    found = known.best(n.casefold()) if ratio < 2.0 else None
                    out.append((g, w, f, n, names[found[0]], found[1]) if found and found[1] > ratio else (g, w, f, n, leader, ratio))
            yield pd.DataFrame(out, columns=["g", *place, "leader", "ratio"])

    while True:
        first = Window.partitionBy("g").orderBy(*place)
        todo = state.where("leader is null").select("g", *place, F.row_number().over(first).alias("k")).where(F.col("k") <= most)
        made = cut(todo.groupBy("g").applyInPandas(next_leaders, f"g {kind}, {', '.join(f'{c} {state.schema[c].dataType.simpleString()}' for c in place)}"))
        if made.isEmpty():
            break
        # each group is spread over parts, each of which gets the leaders of the round
        names = state.withColumn("part", F.pmod(F.xxhash64("n"), F.lit(PARTS)).cast("int")).withColumn("is_name", F.lit(1))
        copies = made.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).withColumn("is_name", F.lit(0)).withColumn("leader", F.col("n")).withColumn("ratio", F.lit(0.0))
        both = names.unionByName(copies).repartition("g", "part").sortWithinPartitions("g", "part", *place, "is_name")
        state = cut(both.mapInPandas(compare, schema))
    return state.select(F.col("g").alias(group), F.col("n").alias(name), F.col("leader").alias("canonical"))
