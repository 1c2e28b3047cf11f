"""Grouped measures. All of them merge rows before the shuffle."""
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.numbers import positive_part


def monthly(df: DataFrame, day: str, **measures: Column) -> DataFrame:
    """Measures per year and month; rows without a date are left out."""
    return df.filter(F.col(day).isNotNull()).groupBy(
        F.year(day).alias("year"), F.month(day).alias("month")).agg(*[c.alias(n) for n, c in measures.items()])


def hourly(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"),
                      F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("total_count"), F.sum(amount).alias("total_sum"))


def period_sums(df: DataFrame, key: str, period: Column, value: str) -> DataFrame:
    return df.groupBy(key, period.alias("_period")).agg(F.sum(value).alias("_sum"))


def period_then_mean(df: DataFrame, key: str, period: Column, value: str, name: str) -> DataFrame:
    """Sum per key and period, then the mean of those sums per key."""
    return period_sums(df, key, period, value).groupBy(key).agg(F.avg("_sum").alias(name))


def conflicting_keys(df: DataFrame, keys: list, value: str) -> DataFrame:
    """Keys that carry more than one distinct value."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias("n_values")).filter("n_values > 1")


def failure_breakdown(attempts: DataFrame, day: str, kind: str, status: str, reason: str, key: str) -> DataFrame:
    """Per day the successes, and per kind and reason the failures that were
    never made good by a later success of the same key."""
    success, failure = F.col(status) == 200, F.col(status) == 400
    totals = attempts.filter(success).groupBy(F.col(day).alias("day")).agg(
        F.count_if(F.col(kind) == "repayment").alias("successful_repayments"),
        F.count_if(F.col(kind) == "disbursement").alias("successful_disbursements"))
    settled = attempts.filter(success).select(F.col(key).alias("_settled")).distinct()
    failed = attempts.filter(failure).join(settled, F.col(key) == F.col("_settled"), "left_anti").groupBy(
        F.col(day).alias("failed_day"), F.col(kind).alias("failure_kind"), F.col(reason).alias("failure_reason")).agg(
        F.count(reason).alias("failed"))
    return totals.join(failed, totals["day"] == failed["failed_day"], "left").drop("failed_day")


def signed_differences(df: DataFrame, pairs: dict) -> DataFrame:
    """For each name (theirs, ours): what is missing and what is too much."""
    out = df
    for name, (theirs, ours) in pairs.items():
        gap = F.col(theirs) - F.col(ours)
        out = out.withColumns({f"missing_{name}": positive_part(gap), f"over_{name}": positive_part(-gap)})
    return out


def share(condition: Column) -> Column:
    """Part of the rows that meet the condition."""
    return F.count_if(condition) / F.count(F.lit(1))


def distinct_counts(df: DataFrame, keys: list, measures: dict) -> DataFrame:
    """Exact distinct counts of several whole-number ids, for few groups: name → column. Null ids do not count.

    Each measure reads its own column and marks ids as bits, 32,768 to a bucket:
    a task sends at most 4 KB for a group and bucket, whatever the rows, where a
    plain distinct count sends every distinct id of every measure. A group that
    has most rows is spread over its buckets. For ids that lie close together
    (numbers given in order, days); scattered ones have a bucket each.
    """
    parts = []
    for name, column in measures.items():
        ids = df.select(*keys, F.col(column).cast("long").alias("_id"))
        bits = ids.groupBy(*keys, F.bitmap_bucket_number("_id").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))
        parts.append(bits.select(*keys, *[(F.bitmap_count("_bits") if n == name else F.lit(0).cast("long")).alias(n) for n in measures]))
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])
