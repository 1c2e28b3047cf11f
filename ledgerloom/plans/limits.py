"""Whitelist changes between two limit refreshes, and publication."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.numbers import change_direction
from ledgerloom.operators.dedupe import pick_per_key

# Product terms in days that carry a limit.
TERMS = (1, 7, 21)


def whitelist_changes(old: DataFrame, new: DataFrame, model_version: str | None = None) -> DataFrame:
    """Every shop of either list with what has to happen to it.

    action: insert (unknown shop, leading zeros aside), update (something
    changed), unchanged, zeroise (no longer in the new list). Columns say how
    each limit and the blacklist flag changed.
    """
    key = lambda c: text.strip_decimal_suffix(F.col(c))
    limits = [f"limit_{t}" for t in TERMS]
    before = pick_per_key(old.withColumn("store_number", key("store_number")), ["store_number"], ["blacklist_flag", *limits])
    before = before.select(F.col("store_number").alias("_old"), *[F.col(c).alias(f"old_{c}") for c in ("blacklist_flag", *limits)])
    fresh = new.filter(F.col("model_version") == model_version) if model_version else new
    after = fresh.select(key("store_number").alias("_new"), "model_version",
                         *[F.col(c).alias(f"new_{c}") for c in ("blacklist_flag", *limits)])
    after = pick_per_key(after, ["_new"], ["model_version", *[f"new_{c}" for c in ("blacklist_flag", *limits)]])
    before, after = before.filter("_old is not null"), after.filter("_new is not null")
    pair = before.join(after, F.col("_old") == F.col("_new"), "full")
    bare = old.select(text.strip_leading_zeros(F.col("store_number")).alias("_bare")).filter("_bare is not null").distinct()
    pair = pair.join(bare.withColumn("_seen", F.lit(True)), text.strip_leading_zeros(F.col("_new")) == F.col("_bare"), "left")
    pair = pair.withColumns({
        "blacklist_flag_change": change_direction(F.col("old_blacklist_flag"), F.col("new_blacklist_flag"), "whitelist", "blacklist"),
        **{f"{c}_change": change_direction(F.col(f"old_{c}"), F.col(f"new_{c}"), "negative", "positive") for c in limits}})
    changed = F.coalesce(*[F.col(f"{c}_change") for c in ("blacklist_flag", *limits)]).isNotNull()
    action = (
        F.when(F.col("_new").isNull(), "zeroise")
        .when(F.col("_old").isNotNull(), F.when(changed, "update").otherwise("unchanged"))
        .when(F.col("_seen").isNull() & ~F.lower("_new").contains("none"), "insert")
        .otherwise("skip"))
    bit = lambda c: F.when(c, 1).otherwise(0)
    flags = {}
    for c in limits:
        change = F.col(f"{c}_change")
        flags[f"has_{c}"] = bit(F.col(f"new_{c}") > 0)
        flags[f"has_{c}_change"] = bit(change.isNotNull())
        flags[f"has_positive_{c}_change"] = bit(change == "positive")
        flags[f"has_negative_{c}_change"] = bit(change == "negative")
    return pair.withColumn("action", action).filter("action <> 'skip'").withColumns(flags).withColumn(
        "store_number", F.coalesce("_new", "_old")).drop("_old", "_new", "_bare", "_seen")


def push_summary(changes: DataFrame) -> DataFrame:
    return changes.filter("model_version is not null").groupBy("model_version").agg(
        F.count_if(F.col("action") == "insert").alias("total_inserts"),
        F.count_if(F.col("action") == "update").alias("total_updates"))


def publishable(results: DataFrame, limits: dict, qualified: str, columns: list, unqualified: float = 0.0) -> DataFrame:
    """Columns to publish; clients who do not qualify get 0 (or −1) as limit."""
    return results.select(*columns, *[
        F.when(F.col(qualified), F.col(src)).otherwise(F.lit(unqualified)).alias(dst) for dst, src in limits.items()])
