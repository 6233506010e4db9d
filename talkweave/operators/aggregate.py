"""Aggregations with an order: text in order, the vote won by whom came first, evidence shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_concat(text: Column, order: list[Column], separator: str = " ") -> Column:
    """Aggregate: the texts of a group joined in order; null texts are skipped."""
    parts = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(*order, text.alias("_text")))))
    return F.array_join(F.transform(parts, lambda x: x["_text"]), separator)


def majority_first(rows: DataFrame, by: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """(by, name): the most frequent non-empty value of each group; of equally frequent ones the first encountered.

    Groups without a value get null. Counts are pre-aggregated before the shuffle.
    """
    votes = rows.groupBy(*by, value).agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_first"))
    voted = F.col(value).isNotNull() & (F.col(value) != "")
    w = Window.partitionBy(*by).orderBy(F.when(voted, 0).otherwise(1), F.col("_n").desc(), "_first")
    return votes.withColumn("_k", F.row_number().over(w)).where("_k = 1").select(*by, F.when(voted, F.col(value)).alias(name))


def weighted_share_argmax(evidence: DataFrame, group: list[str], name: str, key: str, weight: str, first: str, least_share: float) -> DataFrame:
    """For each name the key with the largest weight, if it has at least ``least_share`` of the name's total.

    Of equal weights the one with the smallest ``first`` wins. Names whose total is not positive are left out. Returns
    group, name, key, best_weight, share, first.
    """
    total = F.sum(weight).over(Window.partitionBy(*group, name))
    best = F.row_number().over(Window.partitionBy(*group, name).orderBy(F.col(weight).desc(), first))
    ranked = evidence.withColumn("_total", total).withColumn("_k", best).where("_k = 1 and _total > 0")
    return ranked.withColumn("share", F.col(weight) / F.col("_total")).where(F.col("share") >= least_share).select(*group, name, key, F.col(weight).alias("best_weight"), "share", first)


def one_name_per_key(resolved: DataFrame, group: list[str], key: str, weight: str, first: str) -> DataFrame:
    """Of several names that resolve to one key the one with the largest weight, then the smallest ``first``."""
    w = Window.partitionBy(*group, key).orderBy(F.col(weight).desc(), first)
    return resolved.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
