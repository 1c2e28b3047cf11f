"""Joins the plain join types do not cover."""
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.slices import Slices


def null_safe(left: list, right: list) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, value: str, by: list | None = None,
              strict: bool = True, slices: int | None = None) -> DataFrame:
    """For each left row the ``value`` of the latest right row before it.

    strict=True takes right rows with an earlier time only, otherwise an equal
    time counts too. Of several right rows at one time the largest value counts.

    Left and right rows travel once, onto one time line, cut into slices by the
    left times' own ranges; a left row takes the last value before it in its
    slice, or else what the slices before carry over. Rows of a time that most
    rows have are dealt over several slices: right rows of that time stand in
    the last of them (strict) or the first. Left rows without a time or a key
    have slices of their own. With ``by`` each key has one slice unless
    ``slices`` is given (their number), for keys that hold very many rows.
    """
    by = by or []
    complete = lambda df, *columns: df.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*by, *columns)]))
    value_type, row_type = right.schema[value].dataType, left.select(F.struct("*").alias("_row")).schema["_row"].dataType
    sliced = not by or slices is not None
    at = Slices(complete(left, left_on), left_on, slices) if sliced else None
    on = at.on if sliced else lambda df: df
    chance = F.xxhash64(*left.columns)
    usable = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*by, left_on)])
    place = F.when(usable, at.dealt(left_on, chance) if sliced else F.lit(0)).otherwise(-1 - F.pmod(chance, F.lit(1024)).cast("int"))
    travelling = on(left).select(*[F.col(k).alias(f"_k_{k}") for k in by], F.col(left_on).alias("_t"), place.alias("_slice"),
                             F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(value_type).alias("_v"), F.struct(*left.columns).alias("_row"))
    marks = complete(right, right_on, value).groupBy(*[F.col(k).alias(f"_k_{k}") for k in by], F.col(right_on).alias("_t")).agg(F.max(value).alias("_v"))
    marks = on(marks).withColumn("_slice", F.lit(0) if not sliced else at.up_to("_t") if strict else at.below("_t"))
    keys = [f"_k_{k}" for k in by]
    line = travelling.unionByName(marks.select(*keys, "_t", "_slice", F.lit(1 if strict else 0).alias("_side"), "_v", F.lit(None).cast(row_type).alias("_row")))
    # One column is the key of the window and of the carry-over, so the rows are shuffled once for the two.
    line = line.withColumn("_group", F.struct(*keys, "_slice"))
    before = Window.partitionBy("_group").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_found", F.last("_v", ignorenulls=True).over(before)).filter("_row is not null")
    if sliced and not by:
        # The last value of each slice, then for every slice the last of those before it: one row.
        ends = marks.groupBy("_slice").agg(F.max_by("_v", "_t").alias("_v")).agg(F.array_sort(F.collect_list(F.struct("_slice", "_v"))).alias("ends"))
        carry = ends.select(F.transform(F.sequence(F.lit(0), F.lit(at.n)), lambda s: F.try_element_at(
            F.filter("ends", lambda e: e["_slice"] < s), F.lit(-1))["_v"]).alias("carry")).scalar()
        found = found.withColumn("_found", F.coalesce("_found", F.when(F.col("_slice") >= 0, F.get(carry, F.col("_slice")))))
    elif sliced:
        # What each key's slices end with, and for every slice that has rows the last value of those before it.
        inner = [F.col(f"_group.{k}") for k in keys]
        ends = line.filter("_slice >= 0").groupBy("_group").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_end"))
        earlier = Window.partitionBy(*inner).orderBy("_group._slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("_group", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
        found = found.join(ends, "_group", "left").withColumn("_found", F.coalesce("_found", "_carry"))
    return found.select("_row.*", F.col("_found").alias(value))


def day_spine(spark, first, last, name: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias(name))


def spine_join(spine: DataFrame, daily: DataFrame, day: str, fill: float = 0) -> DataFrame:
    """Every day of the spine with the measures of that day, or zeros."""
    measures = [c for c in daily.columns if c != day]
    return spine.join(daily, day, "left").select(
        day, *[F.coalesce(F.col(m), F.lit(fill).cast(daily.schema[m].dataType)).alias(m) for m in measures])


def reconcile(left: DataFrame, right: DataFrame, keys: list, measures: list, names=("core", "warehouse"),
              how: str = "inner") -> DataFrame:
    """Both sides' measures and their signed difference, per key.

    The inner form drops keys found on one side only; how="full" keeps them
    with zeros on the missing side.
    """
    a, b = names
    l = left.select(*keys, *[F.col(m).alias(f"{m}_{a}") for m in measures])
    r = right.select(*keys, *[F.col(m).alias(f"{m}_{b}") for m in measures])
    out = l.join(r, keys, how)
    for m in measures:
        x, y = F.coalesce(F.col(f"{m}_{a}"), F.lit(0)), F.coalesce(F.col(f"{m}_{b}"), F.lit(0))
        out = out.withColumns({f"{m}_{a}": x, f"{m}_{b}": y}).withColumn(
            f"diff_{m}", F.col(f"{m}_{a}") - F.col(f"{m}_{b}"))
    return out


def presence_matrix(sources: dict, key: str) -> DataFrame:
    """Per key one flag and one row count per source.

    One union and one aggregate: counts are merged before the shuffle, so a key
    with very many rows costs no more than any other.
    """
    names = list(sources)
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(F.col(key), *[F.lit(1 if n == name else 0).alias(n) for n in names]) for name, df in sources.items()],
    )
    out = stacked.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(n).alias(f"n_{n}") for n in names])
    return out.select(key, *[(F.col(f"n_{n}") > 0).alias(f"in_{n}") for n in names], *[f"n_{n}" for n in names])


def missing_from(df: DataFrame, *others: tuple) -> DataFrame:
    """Rows whose key is in none of the other frames; each of ``others`` is
    (frame, own column, other column). Nulls in the other frame are ignored."""
    for other, mine, theirs in others:
        keys = other.select(F.col(theirs).alias("_other")).filter("_other is not null").distinct()
        df = df.join(keys, F.col(mine) == F.col("_other"), "left_anti")
    return df


def rule_agreement(by_rule: DataFrame, by_other_rule: DataFrame, key: str, answer: str) -> DataFrame:
    """Where two independent rules answer the same question: do they agree?

    One row per key that both rules answer: it agrees when any answer is given
    by both. Answers are merged per key and value, never paired with each other.
    """
    a = by_rule.select(key, answer, F.lit(True).alias("_a"), F.lit(False).alias("_b"))
    b = by_other_rule.select(key, answer, F.lit(False).alias("_a"), F.lit(True).alias("_b")).filter(F.col(answer).isNotNull())
    each = a.unionByName(b).filter(F.col(key).isNotNull()).groupBy(key, answer).agg(
        F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))
    return each.groupBy(key).agg(
        F.bool_or("_a").alias("_has_a"), F.bool_or("_b").alias("_has_b"),
        F.min(F.when(F.col("_a"), F.col(answer))).alias(f"{answer}_a"), F.min(F.when(F.col("_b"), F.col(answer))).alias(f"{answer}_b"),
        F.bool_or(F.col("_a") & F.col("_b")).alias("agrees")).filter("_has_a and _has_b").drop("_has_a", "_has_b")
