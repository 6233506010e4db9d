"""Problem 7: choosing records so that each source gives its target share of all tokens.

Tokens are added up per source; from them, the target shares and the caps follows how often each source is repeated:
the largest mix is taken in which no source exceeds its cap. Each record is then emitted as often as the whole part of
its source's rate, and once more with the fraction's probability, drawn from a hash of seed, mix and record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Mixes and sources of so many rows are broadcast; beyond it they are joined by shuffle.
BROADCAST_TARGETS = 100_000


def rates(docs: DataFrame, source: str, size: str, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(mix_id, source, target_share, max_repeats, source_tokens, rate) for each row of the targets.

    ``targets`` has mix_id, source, target_share, max_repeats. The rate is share x total / tokens of the source, where
    the total is the largest at which no rate exceeds its cap, and at most ``total_tokens``. A source without tokens, or
    with a share of null, 0 or less, gets rate 0 and bounds nothing.
    """
    tokens = docs.where(F.col(source).isNotNull() & (F.col(size) > 0)).groupBy(F.col(source).alias("source")).agg(F.sum(F.col(size).cast("bigint")).alias("source_tokens"))
    t = targets.select("mix_id", "source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).join(tokens, "source", "left")
    usable = (F.col("target_share") > 0) & (F.col("source_tokens") > 0)
    bound = F.min(F.when(usable, F.col("max_repeats") * F.col("source_tokens") / F.col("target_share"))).over(Window.partitionBy("mix_id"))
    total = bound if total_tokens is None else F.least(bound, F.lit(float(total_tokens)))
    rate = F.when(usable, F.least(F.col("target_share") * total / F.col("source_tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return t.select("mix_id", "source", "target_share", "max_repeats", F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"), rate.alias("rate"))


def mix(docs: DataFrame, doc_id: str, source: str, size: str, targets: DataFrame, seed: int = 0, total_tokens: int | None = None) -> DataFrame:
    """(mix_id, doc_id, source, n_tokens, copies) for every record that a mix takes at least once.

    A record is copied at most ``max_repeats`` times. Records of a null source, of a source that a mix does not name, or
    without tokens (null, 0 or less) are in no mix. The same seed gives the same choice, however the data are
    partitioned; repeated rows of one id are drawn alike. Targets must not name a source twice in a mix. No rows or no
    targets give no rows.
    """
    plan = rates(docs, source, size, targets, total_tokens).where("rate > 0").select("mix_id", F.col("source").alias("_source"), "rate")
    if targets.count() <= BROADCAST_TARGETS:
        plan = F.broadcast(plan)
    d = docs.where(F.col(size) > 0).select(F.col(doc_id).alias("_id"), F.col(source).alias("_source"), F.col(size).cast("bigint").alias("n_tokens")).join(plan, "_source")
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("mix_id").cast("string"), F.col("_id").cast("string")), 11) / float(1 << 53)
    copies = F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("bigint")
    return d.select("mix_id", F.col("_id").alias(doc_id), F.col("_source").alias("source"), "n_tokens", copies.cast("int").alias("copies")).where("copies > 0")


def reached_shares(mixed: DataFrame, planned: DataFrame) -> DataFrame:
    """What every source of every mix came to: planned rate and share, records, copies, tokens and the share reached."""
    got = mixed.groupBy("mix_id", "source").agg(F.count("*").alias("n_records"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("mix_tokens"), F.max("copies").alias("most_copies"))
    both = planned.join(got, ["mix_id", "source"], "left").na.fill(0, ["n_records", "n_copies", "mix_tokens", "most_copies"])
    share = F.col("mix_tokens") / F.sum("mix_tokens").over(Window.partitionBy("mix_id"))
    return both.select("mix_id", "source", "target_share", "max_repeats", "source_tokens", "rate", "n_records", "n_copies", "most_copies", "mix_tokens", F.when(F.sum("mix_tokens").over(Window.partitionBy("mix_id")) > 0, share).otherwise(0.0).alias("actual_share"))
