"""Queries of problems 6 and 7. Sizes are in tokens, which SQL cannot count; the ``_by_characters`` queries run the same
operators on sizes in characters, so that SQL can check what must hold for any sizes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from talkweave.llm.mixing import mix, rates, reached_shares
from talkweave.llm.packing import pack_all, usage
from talkweave.llm.tokens import token_counts
from talkweave.runtime import cut, table


def _sizes(spark, folder, *columns):
    return token_counts(table(spark, folder, "documents").select("doc_id", *columns, "text"), "text")


def _capacities(spark, folder):
    return {r["pack_id"]: r["capacity_tokens"] for r in table(spark, folder, "pack_sizes").collect()}


def p6_containers(spark, folder):
    """Every part of every document with its container, for each capacity."""
    packed = pack_all(_sizes(spark, folder), "doc_id", "n_tokens", _capacities(spark, folder))
    return packed.select("pack_id", "doc_id", "part", "start", "n_tokens", "container", "offset")


def p6_usage(spark, folder):
    """Containers and unused space for each capacity."""
    return usage(p6_containers(spark, folder), _capacities(spark, folder))


def _mixed(spark, folder):
    sizes = cut(_sizes(spark, folder, "source"))
    targets = table(spark, folder, "mix_targets")
    return mix(sizes, "doc_id", "source", "n_tokens", targets), rates(sizes, "source", "n_tokens", targets)


def p7_copies(spark, folder):
    """Documents chosen for each mix with the number of their copies."""
    return _mixed(spark, folder)[0]


def p7_shares(spark, folder):
    """Target and actual share of every source in every mix."""
    return reached_shares(*_mixed(spark, folder))


def _characters(spark, folder, *columns):
    return table(spark, folder, "documents").select("doc_id", *columns, F.coalesce(F.length("text"), F.lit(0)).alias("n_tokens"))


def p6_by_characters(spark, folder):
    """Per capacity: documents, parts, characters placed, containers filled beyond it, parts that overlap another."""
    capacities = _capacities(spark, folder)
    packed = pack_all(_characters(spark, folder), "doc_id", "n_tokens", capacities)
    w = Window.partitionBy("pack_id", "container").orderBy("offset", "n_tokens")
    end = F.col("offset") + F.col("n_tokens")
    capacity = F.create_map(*[F.lit(x) for k, v in sorted(capacities.items()) for x in (k, v)])[F.col("pack_id")]
    d = packed.withColumn("overlaps", F.coalesce(F.lag(end).over(w) > F.col("offset"), F.lit(False))).withColumn("beyond", end > capacity)
    per = d.groupBy("pack_id", "doc_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("size"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("overlaps", "beyond")])
    return per.groupBy("pack_id").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_parts"), F.sum("size").alias("n_characters"), F.sum("beyond").alias("n_beyond"), F.sum("overlaps").alias("n_overlaps"))


def p7_by_characters(spark, folder):
    """Per source of a mix: its characters, rate, and records copied less or more often than the rate allows."""
    sizes = cut(_characters(spark, folder, "source"))
    targets = table(spark, folder, "mix_targets")
    plan = rates(sizes, "source", "n_tokens", targets)
    copies = mix(sizes, "doc_id", "source", "n_tokens", targets).groupBy("mix_id", "source").agg(F.sum("copies").alias("n_copies"), F.min("copies").alias("least"), F.max("copies").alias("most"), F.count("*").alias("n"))
    records = sizes.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n_records"))
    d = plan.join(copies, ["mix_id", "source"], "left").join(records, "source", "left")
    whole = F.floor("rate")
    wrong = (F.coalesce("least", whole) < whole) | (F.coalesce("most", whole) > F.ceil("rate")) | ((whole > 0) & (F.col("n") < F.col("n_records")))
    return d.select("mix_id", "source", "source_tokens", F.round("rate", 6).alias("rate"), F.coalesce(wrong, F.lit(False)).cast("bigint").alias("n_wrong"))


QUERIES = {"p6_containers": p6_containers, "p6_usage": p6_usage, "p7_copies": p7_copies, "p7_shares": p7_shares, "p6_by_characters": p6_by_characters, "p7_by_characters": p7_by_characters}
SQL = {
    "p6_by_characters": """
select pack_id, count(*) n_docs, cast(sum(greatest(1, (n + capacity_tokens - 1) // capacity_tokens)) as bigint) n_parts, cast(sum(n) as bigint) n_characters, cast(0 as bigint) n_beyond, cast(0 as bigint) n_overlaps
from pack_sizes, (select coalesce(length(text), 0) n from documents) group by pack_id""",
    "p7_by_characters": """
with t as (select mix_id, m.source, target_share, max_repeats, coalesce(tokens, 0) tokens from mix_targets m left join (select source, sum(length(text)) tokens from documents where length(text) > 0 group by 1) d on d.source = m.source),
b as (select *, min(case when target_share > 0 and tokens > 0 then max_repeats * tokens / target_share end) over (partition by mix_id) total from t)
select mix_id, source, cast(tokens as bigint) source_tokens, round(case when target_share > 0 and tokens > 0 then least(target_share * total / tokens, max_repeats::double) else 0.0 end, 6) rate, cast(0 as bigint) n_wrong from b""",
}
